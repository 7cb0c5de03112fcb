"""Language of words in code-switched text, and of documents, by a linear-chain conditional random field."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import append_columns, chosen, fold, sample_share, table

SLOTS = 1 << 16
WORDS_KEPT = 500_000
LONGEST = 24
CELLS = 1_000_000
UNKNOWN = "und"


def core(word: str) -> str:
    """Lower-case word without what surrounds its letters; empty if it has none."""
    word = word.lower()
    if word.isalpha():
        return word
    at = [i for i, c in enumerate(word) if c.isalpha()]
    return word[at[0] : at[-1] + 1] if at else ""


def pieces(plain: str) -> list[str]:
    """A word between marks of its ends, or the successive pieces of a long one; none of an empty one.

    Pieces share two characters, so that every trigram of the word is in one of them.
    """
    edged = f"^{plain}$"
    if not plain or len(plain) <= LONGEST:
        return [edged] if plain else []
    return [edged[i : i + LONGEST + 2] for i in range(0, len(edged) - 2, LONGEST)]


def words_of(text: bytes | None) -> list[str | tuple[str]]:
    """Words of a text between white space of any kind; a long one as its pieces, each in a tuple."""
    words = (text or b"").decode("utf-8", "replace").lower().split()
    if not words or max(map(len, words)) <= LONGEST:
        return words
    return [x for w in words for x in ([w] if len(w) <= LONGEST else [(p,) for p in pieces(core(w))])]


class Slots(dict):
    """Slot of a feature, by hash; features are few against words, so each is hashed once."""

    def __missing__(self, name: str) -> int:
        if len(self) > WORDS_KEPT:
            self.clear()
        self[name] = slot = zlib.crc32(name.encode("utf-8", "replace")) % SLOTS
        return slot


SLOT_OF = Slots()


def word_features(piece: str, lexicon: frozenset[str]) -> list[int]:
    """Slots of a piece's trigrams, of prefixes and suffixes at a word's ends, and of the piece if the lexicon has it."""
    names = {piece[i : i + 3] for i in range(len(piece) - 2)}
    if piece[0] == "^":
        names |= {piece[:2], piece[:4]}
    if piece[-1] == "$":
        names |= {piece[-2:], piece[-4:]}
    slots = [SLOT_OF[n] for n in names]
    if piece in lexicon:
        slots.append(SLOT_OF[f"word {piece[1:-1]}"])
    return slots


@dataclass
class Chain:
    """Labels, emission weights by slot, transition scores and start scores."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    lexicon: frozenset[str]

    def emissions(self, words: list[str]) -> np.ndarray:
        """Exponentiated scores of words, the best label of each at one."""
        slots = [word_features(w, self.lexicon) for w in words]
        first = np.cumsum([0] + [len(x) for x in slots[:-1]])
        score = np.add.reduceat(self.weights[[f for x in slots for f in x]], first, axis=0)
        return np.exp(np.maximum(score - score.max(axis=1, keepdims=True), -30))


def marginals(potential: list[np.ndarray] | np.ndarray, moves: np.ndarray, start: np.ndarray, active: np.ndarray):
    """Forward-backward over sequences side by side, longest first.

    potential[t] holds the exponentiated emissions of the ``active[t]`` sequences that reach
    step t. Gives the label marginals of each step in the same layout, and the forward and
    backward passes, both scaled to sum to one.
    """
    forward, backward, steps = [], [None] * len(active), len(active)
    now = potential[0] * start
    for t in range(steps):
        if t:
            now = (now[: active[t]] @ moves) * potential[t]
        now = now / now.sum(axis=1, keepdims=True)
        forward.append(now)
    ahead = np.ones_like(forward[-1])
    for t in range(steps - 1, -1, -1):
        if t < steps - 1:
            ahead = (ahead * potential[t + 1]) @ moves.T
            ahead = ahead / ahead.sum(axis=1, keepdims=True)
            if active[t] > len(ahead):
                ahead = np.vstack([ahead, np.ones((active[t] - len(ahead), ahead.shape[1]), ahead.dtype)])
        backward[t] = ahead
    both = [f * b for f, b in zip(forward, backward, strict=True)]
    return [g / g.sum(axis=1, keepdims=True) for g in both], forward, backward


class Emissions(dict):
    """Row of a word's emissions; row 0 is for words without a letter. New words wait for ``settle``."""

    def __init__(self, model: Chain):
        super().__init__()
        self.model, self.cores, self.waiting = model, {"": 0}, []
        self.rows = np.ones((1, len(model.labels)), dtype=np.float32)

    def __missing__(self, word: str | tuple[str]) -> int:
        piece = word[0] if isinstance(word, tuple) else "".join(pieces(core(word)))
        at = self.cores.get(piece)
        if at is None:
            at = self.cores[piece] = len(self.rows) + len(self.waiting)
            self.waiting.append(piece)
        self[word] = at
        return at

    def settle(self) -> None:
        if self.waiting:
            self.rows = np.vstack([self.rows, self.model.emissions(self.waiting).astype(np.float32)])
            self.waiting = []

    def reset(self) -> None:
        self.clear()
        self.cores, self.waiting, self.rows = {"": 0}, [], self.rows[:1]


def label_documents(texts: list, table_: Emissions) -> tuple[list[str], list[float], list[int]]:
    """Language, mean marginal of it, and number of words of each text, pieces of long ones counted each."""
    model = table_.model
    if len(table_) > WORDS_KEPT:
        table_.reset()
    words = []
    for text in texts:
        rows = np.array(list(map(table_.__getitem__, words_of(text))), dtype=np.int32)
        words.append(rows[rows > 0])
    table_.settle()
    lengths = np.array([len(w) for w in words])
    order = np.argsort(-lengths, kind="stable")
    moves, start = np.exp(model.moves).astype(np.float32), np.exp(model.start).astype(np.float32)
    total = np.zeros((len(texts), len(model.labels)))
    at, end = 0, int((lengths > 0).sum())
    while at < end:
        size = min(max(1, CELLS // int(lengths[order[at]])), end - at)
        group = order[at : at + size]
        steps = lengths[group]
        padded = np.zeros((steps[0], size), dtype=np.int32)
        for i, d in enumerate(group):
            padded[: steps[i], i] = words[d]
        active = np.searchsorted(-steps, -np.arange(steps[0]), side="left")
        potential = [table_.rows[padded[t, : active[t]]] for t in range(steps[0])]
        for share in marginals(potential, moves, start, active)[0]:
            total[group[: len(share)]] += share
        at += size
    share = total / np.maximum(lengths, 1)[:, None]
    best = share.argmax(axis=1)
    known = lengths > 0
    names = [model.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
    return names, np.where(known, share.max(axis=1), 0.0).clip(0, 1).tolist(), lengths.tolist()


def fit(windows: list[tuple[str, list[str]]], lexicon_size: int = 2000, rounds: int = 60, seed: int = 11) -> Chain:
    """Maximum likelihood with a small penalty, from windows of words of one language each.

    Every second sequence is spliced from two windows, so that transitions between languages
    are learned from switches as well as from runs. ``lexicon_size`` is the number of most
    frequent words of a language whose own weight is learned.
    """
    rng = np.random.default_rng(seed)
    labels = sorted({lang for lang, _ in windows})
    number = {lang: i for i, lang in enumerate(labels)}
    counts: dict[str, Counter] = {lang: Counter() for lang in labels}
    for lang, words in windows:
        counts[lang].update(words)
    lexicon = frozenset(w for c in counts.values() for w, _ in c.most_common(lexicon_size))
    vocabulary: dict[str, int] = {}
    sequences = []
    for i, (lang, words) in enumerate(windows):
        pairs = [(vocabulary.setdefault(w, len(vocabulary)), number[lang]) for w in words]
        if i % 2:
            other, more = windows[rng.integers(0, len(windows))]
            cut = int(rng.integers(1, len(words) + 1))
            pairs = pairs[:cut] + [(vocabulary.setdefault(w, len(vocabulary)), number[other]) for w in more[cut:]]
        sequences.append(pairs)
    sequences.sort(key=len, reverse=True)
    steps = np.array([len(s) for s in sequences])
    active = np.searchsorted(-steps, -np.arange(steps[0]), side="left")
    ids = [np.array([s[t][0] for s in sequences[: active[t]]]) for t in range(steps[0])]
    gold = [np.array([s[t][1] for s in sequences[: active[t]]]) for t in range(steps[0])]
    slots = [word_features(w, lexicon) for w in vocabulary]
    flat = np.array([f for s in slots for f in s])
    owner = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    first = np.r_[0, np.cumsum([len(s) for s in slots])[:-1]]
    all_ids, n, tokens = np.concatenate(ids), len(labels), int(steps.sum())
    truth = np.eye(n)[np.concatenate(gold)]
    seen_moves = sum(np.eye(n)[a[: len(b)]].T @ np.eye(n)[b] for a, b in zip(gold, gold[1:], strict=False)) + np.zeros((n, n))
    parts = [np.zeros((SLOTS, n)), np.zeros((n, n)), np.zeros(n)]
    adam = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    for turn in range(1, rounds + 1):
        weights, moves, start = parts
        score = np.add.reduceat(weights[flat], first, axis=0)
        rows = np.exp(score - score.max(axis=1, keepdims=True))
        step_up = np.exp(moves)
        share, forward, backward = marginals([rows[i] for i in ids], step_up, np.exp(start), active)
        off = np.concatenate(share) - truth
        by_word = np.stack([np.bincount(all_ids, off[:, c], len(vocabulary)) for c in range(n)], axis=1)
        by_slot = np.stack([np.bincount(flat, by_word[owner, c], SLOTS) for c in range(n)], axis=1)
        expected = np.zeros((n, n))
        for t in range(1, len(ids)):
            joint = forward[t - 1][: active[t], :, None] * step_up * (rows[ids[t]] * backward[t])[:, None, :]
            expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        slopes = [by_slot / tokens + 1e-6 * weights, (expected - seen_moves) / tokens + 1e-6 * moves]
        slopes.append((share[0] - truth[: len(share[0])]).sum(axis=0) / tokens + 1e-6 * start)
        for i, (p, g) in enumerate(zip(parts, slopes, strict=True)):
            m, v = adam[i] = (0.9 * adam[i][0] + 0.1 * g, 0.99 * adam[i][1] + 0.01 * g * g)
            parts[i] = p - 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return Chain(labels, parts[0].astype(np.float32), parts[1], parts[2], lexicon)


def train(
    docs: DataFrame,
    folds: int = 4,
    held_fold: int = 2,
    per_language: int = 800,
    windows: int = 3,
    window: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Chain | None:
    """Model from about ``per_language`` documents a language of the training folds.

    From each of them come up to ``windows`` runs of ``window`` words, evenly spread over the whole
    text: that is all that the driver gets. Rows without language or letters teach nothing.
    """
    known = docs.filter((fold(id_col, folds) != held_fold) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang_col).count().collect()}
    if not counts:
        return None
    share = F.coalesce(*[F.when(F.col(lang_col) == k, sample_share(n, per_language)) for k, n in counts.items()])
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.filter(draw < share).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def make(texts: Iterator[list]) -> Iterator[list]:
        for batch in texts:
            out = []
            for text in batch:
                words = [p for w in words_of(text) for p in (w if isinstance(w, tuple) else pieces(core(w)))]
                starts = sorted({int(i * max(0, len(words) - window) / max(1, windows - 1)) for i in range(windows)})
                out.append([words[s : s + window] for s in starts if words[s : s + window]])
            yield [out]

    got = append_columns(picked, "text", make, {"runs": "array<array<string>>"}).select("id", "lang", "runs").toArrow()
    rows = sorted(got.to_pylist(), key=lambda r: (r["id"] is None, r["id"], r["lang"]))
    runs = [(r["lang"], run) for r in rows for run in r["runs"]]
    return fit(runs) if runs else None


def with_language(docs: DataFrame, model: Chain | None, lang: str, score: str, text_col: str = "text") -> DataFrame:
    """All columns, the predicted language of every whole text and the mean marginal of its words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: Iterator[list]) -> Iterator[list]:
        held = Emissions(shared.value) if shared.value else None
        for batch in texts:
            if held is None:
                yield [[UNKNOWN] * len(batch), [0.0] * len(batch)]
            else:
                yield label_documents(batch, held)[:2]

    return append_columns(docs, text_col, make, {lang: "string", score: "double"})


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of the documents.

    A null text, or one without a letter, is ``und`` with score 0, as is every text when there is
    nothing to learn from. Repeated rows get the same answer; null ids are in the training
    folds; an empty table gives no rows.
    """
    labelled = with_language(docs.select("doc_id", "text"), train(docs), "lang_pred", "score")
    return labelled.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_crf_language(spark: SparkSession, folder: str) -> DataFrame:
    return languages(table(spark, folder, "documents"))

"""Language model by logistic mixing of hashed-context bit predictors, and a unigram base.

A text is a run of words, each followed by a space byte, and one more space byte as its
end. Every byte is coded in eight binary steps. Each step is predicted from counts in six
hashed contexts (place in the word, the last one to four and six bytes) and from the exact
counts of the word's whole prefix, over all training words; a gate picks the weights that mix
them in the logistic domain, and an adaptive map refines the result. Contexts start anew at every word, so all occurrences of a word have one
probability, which is computed once per distinct word of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import Steps, fold, numbered_words, some_rows, table

SIZES = (12, 16, 19, 20, 21, 21)
BLOCK = 1 << 12
PREFIX = len(SIZES)
GATING = 3
HEAD_WORDS = 20_000
GROUP = 1_000_000
CHUNK = 100_000
COUNTED = 16 << 20
LOOKED_UP = 4 << 20
SUMMED = 1 << 16
CLASS_PRIOR = 0.1
LEARNED, COMMON, FORGET, CALM = 60_000, 1000, 0.8, 20.0
N_GATES, BINS, EDGE = 32, 49, 12.0
LOW_GATES, PREFIX_GATES = np.digitize(np.arange(33), (1, 4, 32)) * 8, np.digitize(np.arange(513), (1, 2, 4, 8, 16, 64, 512))
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def chunks(words: list[bytes], counts: np.ndarray, size: int = CHUNK) -> Iterator[tuple[list[bytes], np.ndarray]]:
    ends = np.cumsum([len(w) + 1 for w in words])
    at = 0
    while at < len(words):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield words[at:end], counts[at:end]
        at = end


@dataclass
class Layout:
    """Bytes of words with their end, the first place of each word, and the contexts' hashes."""

    data: np.ndarray
    first: np.ndarray
    length: np.ndarray
    hashes: list[np.ndarray]

    @classmethod
    def of(cls, words: list[bytes]) -> Layout:
        data = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8).astype(np.int64)
        length = np.array([len(w) + 1 for w in words])
        first = np.cumsum(length) - length
        place = np.arange(len(data)) - np.repeat(first, length)
        last = np.zeros(len(data), dtype=np.uint64)
        contexts = [np.minimum(place, 15).astype(np.uint64)]
        for back in range(1, 7):
            byte = np.zeros(len(data), dtype=np.uint64)
            byte[back:] = data[:-back]
            byte[place < back] = 0
            last = last | (byte << np.uint64(8 * (back - 1)))
            if back != 5:
                contexts.append(last)
        with np.errstate(over="ignore"):
            hashes = [(c + np.uint64(j + 1)) * MIX[1] for j, c in enumerate(contexts)]
        return cls(data, first, length, hashes)

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """The places to predict, and for each place of all words its number among them.

        A prediction follows from the word's bytes so far. Where those are the first bytes of the word
        before as well, the place is that word's; of sorted words most places are.
        """
        shared = np.zeros(len(self.first), dtype=np.int64)
        later, depth = np.arange(1, len(self.first)), 0
        while len(later):
            later = later[np.minimum(self.length[later], self.length[later - 1]) > depth]
            later = later[self.data[self.first[later] + depth] == self.data[self.first[later - 1] + depth]]
            depth += 1
            shared[later] = depth
        inside = np.arange(len(self.data)) - np.repeat(self.first, self.length)
        own = inside >= np.repeat(shared, self.length)
        number = np.cumsum(own) - 1
        later, depth = np.flatnonzero(shared), 0
        while len(later):
            opens = np.r_[True, np.diff(later) > 1]
            source = (later[opens] - 1)[np.cumsum(opens) - 1]
            number[self.first[later] + depth] = number[self.first[source] + depth]
            depth += 1
            later = later[shared[later] > depth]
        return np.flatnonzero(own), number

    def at(self, places: np.ndarray) -> Layout:
        """Bytes and hashes of some places only; the words keep their places among all."""
        return Layout(self.data[places], self.first, self.length, [h[places] for h in self.hashes])

    def step(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The bits of step ``k`` and the number that the bits before it make."""
        node = (1 << k) | (self.data >> (8 - k))
        return (self.data >> (7 - k)) & 1, node.astype(np.uint64) * MIX[2]

    def slot(self, j: int, node: np.ndarray) -> np.ndarray:
        mixed = (self.hashes[j] ^ node) * MIX[3]
        return (mixed >> np.uint64(64 - SIZES[j])).view(np.int64)


def stretched(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + 0.05) / (n0 + 0.05)), -EDGE, EDGE).astype(np.float32)


def gate_of(low: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Which weights mix: how often the last three bytes and the whole prefix were seen."""
    return LOW_GATES.take(low.astype(np.int64), mode="clip") + PREFIX_GATES.take(prefix.astype(np.int64), mode="clip")


def squash(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -20, 20)))


def refine_cell(k: int, z: np.ndarray) -> np.ndarray:
    scaled = (np.clip(z, -EDGE, EDGE) + EDGE) * ((BINS - 1) / (2 * EDGE))
    return k * BINS + np.rint(scaled).astype(np.int64)


def by_spelling(words: list[bytes]) -> np.ndarray:
    return np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)


def count_tables(words: list[bytes], counts: np.ndarray, size: int, tables: list[np.ndarray]) -> None:
    """Add the bits of words, as often as they occur, in runs of about ``size`` bytes."""
    for some, often in chunks(words, counts, size):
        layout = Layout.of(some)
        weight = np.repeat(often, layout.length).astype(np.int64)
        for k in range(8):
            bit, node = layout.step(k)
            for j in range(len(SIZES)):
                np.add.at(tables[j], layout.slot(j, node) * 2 + bit, weight)


@dataclass
class Prefixes:
    """How often the first bits of each string occur in all of them, for 1 to all of its bits."""

    counts: np.ndarray
    first: np.ndarray
    length: np.ndarray
    total: int

    @classmethod
    def of(cls, strings: list[bytes], weight: np.ndarray) -> Prefixes:
        """``strings`` are sorted and none begins with another; ``weight`` is how often each occurs.

        Strings with the same first bits are neighbours, so a count is the sum of a run. Runs change
        only at depths at which two neighbours part.
        """
        length = np.array([len(x) for x in strings], dtype=np.int64)
        first = np.cumsum(length) - length
        data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        counts = np.repeat(weight, 8 * length)
        shared = np.zeros(max(0, len(strings) - 1), dtype=np.int64)
        pairs, place = np.arange(len(shared)), 0
        while len(pairs):
            differ = data[first[pairs] + place] ^ data[first[pairs + 1] + place]
            shared[pairs] = 8 * place + 8 - np.frexp(differ.astype(float))[1]
            pairs, place = pairs[differ == 0], place + 1
        start = np.r_[0, shared][: len(strings)]
        reach = np.maximum(start, np.r_[shared, 0][: len(strings)])
        at, above = np.arange(len(strings)), 0
        for level in np.unique(shared):
            at = at[reach[at] >= level]
            edges = start[at] <= above
            edges[:1] = True
            run = np.add.reduceat(weight[at], np.nonzero(edges)[0])[np.cumsum(edges) - 1]
            for depth in range(above, level):
                counts[8 * first[at] + depth] = run
            above = level
        return cls(counts, first, length, int(weight.sum()))

    def continue_from(self, heads: Prefixes, number: np.ndarray) -> None:
        """Take the counts of the first bits from ``heads``: string i begins with head ``number[i]``."""
        bits = 8 * heads.length[number]
        inside = np.arange(bits.sum()) - np.repeat(np.cumsum(bits) - bits, bits)
        self.counts[np.repeat(8 * self.first, bits) + inside] = heads.counts[np.repeat(8 * heads.first[number], bits) + inside]
        self.total = heads.total

    def rows(self, which: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """By byte of the strings ``which``: the count before its first bit and after each of its bits.

        With ``places``, only of these bytes.
        """
        length = self.length[which]
        begin = np.cumsum(length) - length
        places = np.arange(length.sum()) if places is None else places
        place = np.repeat(self.first[which] - begin, length)[places] + places
        counts = self.counts.reshape(-1, 8)
        out = np.empty((len(places), 9), dtype=self.counts.dtype, order="F")
        out[:, 1:] = counts[place]
        out[:, 0] = counts[place - 1, 7]
        out[np.repeat(begin, length)[places] == places, 0] = self.total
        return out


def pair_of(rows: np.ndarray, k: int, bit: np.ndarray) -> np.ndarray:
    """Counts of a zero and of a one after a prefix, side by side."""
    own = rows[:, k + 1]
    other = rows[:, k] - own
    return np.column_stack([np.where(bit == 1, other, own), np.where(bit == 1, own, other)])


class Mixer:
    """Mixing weights by step and gate, learned online by Newton steps on the coding cost."""

    def __init__(self):
        inputs = len(SIZES) + 2
        self.weights = np.full((8, N_GATES, inputs), 0.05)
        self.weights[:, :, -1], self.weights[:, :, PREFIX] = 0, 0.7
        self.curvature = np.zeros((8, N_GATES, inputs, inputs)) + np.eye(inputs) * CALM

    def step(self, k: int, gate: np.ndarray, inputs: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Mixed predictions, in the logistic domain, before the step that these places cause."""
        order = np.argsort(gate.astype(np.uint8), kind="stable")
        edges = np.searchsorted(gate[order], np.arange(N_GATES + 1))
        z = np.empty(len(gate))
        for g in np.nonzero(np.diff(edges))[0]:
            at = order[edges[g] : edges[g + 1]]
            x, often = inputs[at], weight[at]
            z[at] = mixed = x @ self.weights[k, g]
            p = squash(mixed)
            slope = x.T @ ((p - bit[at]) * often)
            steep = x.T @ (x * (np.maximum(p * (1 - p), 1e-4) * often)[:, None])
            kept = self.curvature[k, g]
            kept *= FORGET
            kept += steep + (1 - FORGET) * CALM * np.eye(len(kept))
            self.weights[k, g] -= np.linalg.solve(kept, slope)
        return z


def learn_mixing(
    words: list[bytes], counts: np.ndarray, prefixes: Prefixes, which: np.ndarray,
    common: tuple[list[bytes], np.ndarray, np.ndarray], share: float,
    tables: list[np.ndarray], mixer: Mixer, cells: np.ndarray,
) -> None:
    """Update mixing weights online, and count outcomes for the adaptive map.

    Every chunk of words comes with the corpus's most ``common`` words, each at the chunk's share
    of its occurrences: ``share`` is their number per occurrence of another word. A chunk is thus
    like a stretch of the corpus. Each word is predicted as if one of its occurrences had
    not been counted, so that the weights suit words that are new or rare. The counts of a word's
    prefixes are those of ``prefixes`` at its number in ``which``.
    """
    pairs, at = [t.view(np.int64) for t in tables], 0
    for some, often in chunks(words, counts, LEARNED):
        rows = np.vstack([prefixes.rows(which[at : at + len(some)]), common[2]])
        at += len(some)
        both_kinds = some + common[0]
        order = by_spelling(both_kinds)
        layout = Layout.of([both_kinds[i] for i in order])
        places, number = layout.places()
        part = np.concatenate([often.astype(float), common[1] * (share * often.sum())])[order]
        weight = np.bincount(number, np.repeat(part, layout.length), len(places))
        unsorted = np.empty_like(layout.first)
        unsorted[order] = layout.length
        begin = (np.cumsum(unsorted) - unsorted)[order]
        rows = np.asfortranarray(rows[np.repeat(begin - layout.first, layout.length)[places] + places])
        layout = layout.at(places)
        even = np.arange(len(places)) * 2
        for k in range(8):
            bit, node = layout.step(k)
            inputs, seen = np.ones((len(bit), len(SIZES) + 2), dtype=np.float32), {}
            own_count = even + bit
            for j in range(len(SIZES) + 1):
                both = pair_of(rows, k, bit).ravel() if j == PREFIX else pairs[j][layout.slot(j, node)].view(np.int32)
                both = both.astype(np.float32)
                both[own_count] -= 1
                np.maximum(both, 0, out=both)
                if j in (GATING, PREFIX):
                    seen[j] = both[0::2] + both[1::2]
                logs = np.log(both + np.float32(0.05))
                inputs[:, j] = np.clip(logs[1::2] - logs[0::2], -EDGE, EDGE)
            z = mixer.step(k, gate_of(*seen.values()), inputs, bit, weight)
            cell = refine_cell(k, z)
            cells[0] += np.bincount(cell, weight * bit, cells.shape[1])
            cells[1] += np.bincount(cell, weight, cells.shape[1])


@dataclass
class Model:
    """Stretched predictions and counts by slot, mixing weights, and the adaptive map."""

    tables: list[np.ndarray]
    weights: np.ndarray
    refined: np.ndarray

    def prepared(self) -> Ready:
        return Ready(
            [stretched(t[0::2].astype(np.float32), t[1::2].astype(np.float32)) for t in self.tables],
            np.minimum(self.tables[GATING][0::2].astype(np.int64) + self.tables[GATING][1::2], 1000).astype(np.int16),
            self.weights,
            self.refined,
        )


@dataclass
class Ready:
    inputs: list[np.ndarray]
    seen: np.ndarray
    weights: np.ndarray
    refined: np.ndarray

    def log10(self, words: list[bytes], prefixes: Prefixes | None = None) -> np.ndarray:
        """log10 probability of each word with the space after it; without counts all prefixes are new."""
        out = [np.zeros(0)]
        for some, which in chunks(words, np.arange(len(words))):
            whole = Layout.of(some)
            places, number = whole.places()
            layout = whole.at(places)
            rows = prefixes.rows(which, places) if prefixes else np.zeros((len(places), 9), dtype=np.int64)
            chance = np.ones(len(places))
            for k in range(8):
                bit, node = layout.step(k)
                slots = [layout.slot(j, node) for j in range(len(SIZES))]
                gate = gate_of(self.seen.take(slots[GATING]), rows[:, k])
                weights = self.weights[k].T.copy()
                both = pair_of(rows, k, bit).astype(np.float32)
                z = weights[-1].take(gate) + weights[PREFIX].take(gate) * stretched(both[:, 0], both[:, 1])
                for j, slot in enumerate(slots):
                    z += weights[j].take(gate) * self.inputs[j].take(slot)
                p = np.clip((squash(z) + self.refined[refine_cell(k, z)]) / 2, 1e-6, 1 - 1e-6)
                chance *= np.where(bit == 1, p, 1 - p)
            out.append(np.add.reduceat(np.log10(chance)[number], whole.first))
        return np.concatenate(out)


def classes(docs: DataFrame, class_col: str | None, most: int) -> Column:
    """Number of a row's class: the ``most`` - 1 values with most rows, then one number for all others."""
    if class_col is None or class_col not in docs.columns or most < 2:
        return F.lit(0)
    rows = docs.groupBy(class_col).count().orderBy(F.desc("count"), F.asc_nulls_last(class_col)).limit(most - 1).collect()
    number = F.lit(len(rows))
    for i, row in enumerate(rows):
        number = F.when(F.col(class_col).eqNullSafe(F.lit(row[0])), i).otherwise(number)
    return number


def count_words(docs: DataFrame, kinds: int) -> DataFrame:
    """(word, by_class, trained, total): how often each token occurs; the empty word ends a text.

    ``docs`` is (text, kind) with the number of a training text's class, or -1 if the text is held
    out. A task counts some ``COUNTED`` bytes at a time and hands on the counts of each, which the
    aggregate combines further before the shuffle.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches, "text", COUNTED):
            words, word, text = numbered_words(batch.column("text"))
            kind = batch.column("kind").to_numpy()
            counts = np.bincount(word * (kinds + 1) + kind[text] + 1, minlength=len(words) * (kinds + 1))
            some = np.flatnonzero(counts)
            ends = np.bincount(kind + 1, minlength=kinds + 1)
            names = pa.concat_arrays([words.take(pa.array(some // (kinds + 1))), pa.array([b""] * (kinds + 1), pa.binary())])
            n = pa.array(np.concatenate([counts[some], ends]), pa.int64())
            of = pa.array(np.concatenate([some % (kinds + 1) - 1, np.arange(kinds + 1) - 1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([names, n, of], names=["word", "n", "kind"]).filter(pc.greater(n, 0))

    partial = docs.mapInArrow(apply, "word binary, n long, kind int")
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == z, F.col("n"))), F.lit(0)).alias(f"c{z}") for z in range(kinds)]
    whole = partial.groupBy("word").agg(*sums, F.sum("n").alias("total"))
    each = [F.col(f"c{z}") for z in range(kinds)]
    return whole.select("word", F.array(*each).alias("by_class"), sum(each[1:], each[0]).alias("trained"), "total")


def _trained(words: DataFrame, tasks: int) -> DataFrame:
    return words.filter("trained > 0").select("word", "trained").coalesce(tasks)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column("word").to_pylist(), batch.column("trained").to_numpy()


@dataclass
class Heads:
    """First bytes of words, none the beginning of another, with the counts of their prefixes.

    ``crowded`` are the beginnings that too many words have: a word's head is its shortest
    beginning, its end included, that is not among them. ``strings`` are all heads in order.
    """

    crowded: list[bytes]
    strings: list[bytes]
    prefixes: Prefixes

    def column(self) -> Column:
        whole, deepest = F.concat("word", F.lit(b" ")), max(map(len, self.crowded), default=0)
        head = F.substring(whole, 1, deepest + 1)
        for size in range(deepest, 0, -1):
            start = F.substring(whole, 1, size)
            longer = [F.lit(x) for x in self.crowded if len(x) == size]
            head = F.when(start.isin(longer), head).otherwise(start) if longer else start
        return head

    def of(self, words: list[bytes]) -> set[bytes]:
        crowded = set(self.crowded)
        return {next(x[:n] for n in range(1, len(x) + 1) if x[:n] not in crowded) for x in (w + b" " for w in words)}


def count_heads(words: DataFrame) -> Heads:
    """Heads that at most ``HEAD_WORDS`` words have; there are at most 256 to a crowded beginning.

    A beginning of too many words is lengthened by one byte at a time, so words of one site or
    one stem, however many, are split into groups of bounded size.
    """
    whole, crowded, strings, counts, now = F.concat("word", F.lit(b" ")), [], [], [], [b""]
    size = 0
    while now:
        size += 1
        some = words if size == 1 else words.filter(F.substring(whole, 1, size - 1).isin([F.lit(x) for x in now]))
        start = F.substring(whole, 1, size).alias("head")
        got = some.groupBy(start).agg(F.count(F.lit(1)).alias("n"), F.sum("trained").alias("trained")).collect()
        now = sorted(bytes(r.head) for r in got if r.n > HEAD_WORDS)
        crowded += now
        strings += [bytes(r.head) for r in got if r.n <= HEAD_WORDS]
        counts += [r.trained for r in got if r.n <= HEAD_WORDS]
    order = sorted(range(len(strings)), key=strings.__getitem__)
    strings = [strings[i] for i in order]
    return Heads(crowded, strings, Prefixes.of(strings, np.array([counts[i] for i in order], dtype=np.int64)))


def by_head(words: DataFrame, heads: Broadcast, tasks: int) -> DataFrame:
    """Words with the same head one after the other in one task, in the order of a hash of these."""
    dealt = words.withColumn("head", heads.value.column()).withColumn("order", F.xxhash64("head"))
    return dealt.repartition(tasks, "head").sortWithinPartitions("order", "head").drop("order").coalesce(tasks)


def with_prefixes(
    batches: Iterator[pa.RecordBatch], heads: Heads
) -> Iterator[tuple[pa.Table, list[bytes], Prefixes]]:
    """Rows of ``by_head`` in groups of all words with the same head, with their prefixes' counts.

    A group has about ``GROUP`` bytes, or the words of one head if those have more.
    """
    number = {x: i for i, x in enumerate(heads.strings)}
    held: list[pa.RecordBatch] = []

    def group(rows: pa.Table) -> tuple[pa.Table, list[bytes], Prefixes]:
        strings = [w + b" " for w in rows.column("word").to_pylist()]
        order = sorted(range(len(strings)), key=strings.__getitem__)
        rows, strings = rows.take(pa.array(order)), [strings[i] for i in order]
        prefixes = Prefixes.of(strings, rows.column("trained").to_numpy())
        names = rows.column("head").to_pylist()
        prefixes.continue_from(heads.prefixes, np.array([number[x] for x in names]))
        return rows, [x[:-1] for x in strings], prefixes

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.column("word").nbytes for b in held) < GROUP:
            continue
        rows = pa.Table.from_batches(held)
        names = rows.column("head").to_pylist()
        cut = len(names) - 1
        while cut and names[cut - 1] == names[-1]:
            cut -= 1
        if cut:
            yield group(rows.slice(0, cut))
            held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield group(pa.Table.from_batches(held))


def in_32_bits(counts: np.ndarray) -> np.ndarray:
    """Counts of zeros and ones side by side; where one is too large both are halved until it is not."""
    pairs = counts.reshape(-1, 2)
    bits = np.frexp(pairs.max(axis=1).astype(float))[1]
    small = pairs >> np.maximum(0, bits - 30)[:, None]
    return np.maximum(small, pairs > 0).astype(np.int32).ravel()


def build_tables(words: DataFrame, tasks: int) -> list[np.ndarray]:
    """Counts by context, slot and bit, summed over all words. Their size is fixed by ``SIZES``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(2 << b, dtype=np.int64) for b in SIZES]
        for some, often in _batches(batches):
            count_tables(some, often, CHUNK, tables)
        for j, counts in enumerate(tables):
            for block, part in enumerate(np.split(counts, max(1, len(counts) // BLOCK))):
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([j]), pa.array([block]), pa.array([part.tobytes()])], names=["j", "block", "counts"]
                    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def row() -> pa.RecordBatch:
            counts = in_32_bits(total)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]]), pa.array([key[1]]), pa.array([counts.tobytes()])], names=["j", "block", "counts"]
            )

        for batch in batches:
            for j, block, counts in zip(*[batch.column(n).to_pylist() for n in ("j", "block", "counts")], strict=True):
                part = np.frombuffer(counts, dtype=np.int64)
                if (j, block) == key:
                    total = total + part
                else:
                    if key:
                        yield row()
                    key, total = (j, block), part
        if key:
            yield row()

    kind = "j long, block long, counts binary"
    parts = _trained(words, tasks).mapInArrow(count, kind)
    # Rows of a block arrive one after the other and are added as they come.
    added = parts.repartition("j", "block").sortWithinPartitions("j", "block").mapInArrow(add, kind)
    # Stored first: rows fetched one part after the other would also be made one part after the other.
    steps = Steps(words.sparkSession)
    added = steps.keep(added, "tables")
    tables = [np.zeros(2 << b, dtype=np.int32) for b in SIZES]
    for row in added.toLocalIterator():
        at = row.block * BLOCK
        part = np.frombuffer(row.counts, dtype=np.int32)
        tables[row.j][at : at + len(part)] = part
    steps.drop("tables")
    return tables


def common_words(words: DataFrame, heads: Broadcast, tasks: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The most frequent training words, how often they occur, and the counts of their prefixes."""
    top = words.filter("trained > 0").orderBy(F.desc("trained"), "word").limit(COMMON).select("word").toArrow()
    wanted = frozenset(top.column("word").to_pylist())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, some, prefixes in with_prefixes(batches, heads.value):
            at = [i for i, w in enumerate(some) if w in wanted]
            counts = [prefixes.rows(np.array([i])).astype(np.int64).tobytes() for i in at]
            columns = [pa.array([some[i] for i in at], pa.binary()), rows.column("trained").combine_chunks().take(pa.array(at, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.binary())], names=["word", "trained", "counts"])

    same = words.filter(heads.value.column().isin([F.lit(x) for x in sorted(heads.value.of(list(wanted)))])) if wanted else words
    dealt = by_head(same.select("word", "trained"), heads, tasks)
    got = dealt.mapInArrow(apply, "word binary, trained long, counts binary").orderBy(F.desc("trained"), "word").toArrow()
    counts = np.frombuffer(b"".join(got.column("counts").to_pylist()), dtype=np.int64).reshape(-1, 9)
    return got.column("word").to_pylist(), got.column("trained").to_numpy(), counts


def train(words: DataFrame, heads: Broadcast, tasks: int) -> tuple[Broadcast, np.ndarray, np.ndarray]:
    """Tables from all trained words, then weights and map learned over all of them again.

    The tables are handed on as they were broadcast, as every executor keeps a file of each broadcast.
    """
    spark = words.sparkSession
    tables = build_tables(words, tasks)
    shared = spark.sparkContext.broadcast(tables)
    common = common_words(words, heads, tasks)
    total = words.agg(F.sum("trained")).first()[0] or 0
    share = 1.0 / max(1.0, float(total - common[1].sum()))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, cells, tokens, skip = Mixer(), np.zeros((2, 8 * BINS)), 0.0, set(common[0])
        for rows, some, prefixes in with_prefixes(batches, heads.value):
            rest = np.array([i for i, w in enumerate(some) if w not in skip], dtype=np.int64)
            if len(rest):
                # Words come sorted; in any order but that, a chunk is like the corpus.
                np.random.default_rng(len(rest)).shuffle(rest)
                often = rows.column("trained").to_numpy()[rest]
                learn_mixing([some[i] for i in rest], often, prefixes, rest, common, share, shared.value, mixer, cells)
                tokens += float(often.sum())
        values = [pa.array([x.tobytes()]) for x in (mixer.weights * tokens, cells)]
        part = pa.array([TaskContext.get().partitionId()], pa.int32())
        yield pa.RecordBatch.from_arrays([part, *values, pa.array([tokens])], names=["part", "weights", "cells", "tokens"])

    dealt = by_head(words.filter("trained > 0").select("word", "trained"), heads, tasks)
    # All tasks learn at once; each gives one row of some 22 KB, in the order of the tasks.
    steps = Steps(spark)
    kind = "part int, weights binary, cells binary, tokens double"
    learned = steps.keep(dealt.mapInArrow(learn, kind), "learned")
    rows = learned.orderBy("part").toLocalIterator()
    weights, cells, tokens = np.zeros_like(Mixer().weights), np.zeros((2, 8 * BINS)), 0.0
    for row in rows:
        weights += np.frombuffer(row.weights).reshape(weights.shape)
        cells += np.frombuffer(row.cells).reshape(cells.shape)
        tokens += row.tokens
    steps.drop("learned")
    weights = weights / tokens if tokens else Mixer().weights
    prior = squash(np.tile(np.linspace(-EDGE, EDGE, BINS), 8))
    refined = (cells[0] + 2 * prior) / (cells[1] + 2)
    return shared, weights, refined


@dataclass
class Sums:
    """Token totals of the training texts: all, distinct, by class, and texts by class."""

    tokens: int
    distinct: int
    by_class: np.ndarray
    texts: np.ndarray

    def base(self, trained: np.ndarray) -> np.ndarray:
        return np.log10((trained + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def ratios(self, by_class: np.ndarray) -> np.ndarray:
        """log10 P(class | word) / P(class) by class; 0 for words that training texts do not have."""
        share = (self.by_class + 1) / (self.by_class + 1).sum()
        counts = by_class.sum(axis=1, keepdims=True)
        return np.log10((by_class + CLASS_PRIOR * share) / (counts + CLASS_PRIOR) / share)


def score_words(words: DataFrame, model: tuple[Broadcast, np.ndarray, np.ndarray], sums: Sums, heads: Broadcast, tasks: int) -> DataFrame:
    """(word, trained, total, values): values are the base and model log10 probability and the ratios."""
    tables, weights, refined = model

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = Model(tables.value, weights, refined).prepared()
        for rows, some, prefixes in with_prefixes(batches, heads.value):
            batch = rows.combine_chunks().to_batches()[0]
            trained = batch.column("trained").to_numpy()
            by_class = batch.column("by_class").flatten().to_numpy().reshape(len(trained), -1)
            lm = ready.log10(some, prefixes)
            values = np.column_stack([sums.base(trained), lm, sums.ratios(by_class)])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))
            columns = [batch.column("word"), pa.array(trained), batch.column("total"), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "trained", "total", "values"])

    return by_head(words, heads, tasks).mapInArrow(apply, "word binary, trained long, total long, values array<double>")


def class_norms(scored: DataFrame, kinds: int) -> list[float]:
    """log10 of the sum over all words of model probability times ratio, by class.

    Words that training texts do not have, in the table or not, share what the others leave, at a ratio of 1.
    """
    trained, lm = F.col("trained") > 0, F.col("values")[1]
    over = [F.sum(F.when(trained, F.pow(F.lit(10.0), lm + F.col("values")[z + 2]) - F.pow(F.lit(10.0), lm))) for z in range(kinds)]
    return [math.log10(1 + (x or 0.0)) for x in scored.agg(*over).first()]


def sums_by_text(text: np.ndarray, values: np.ndarray, which: np.ndarray, texts: int) -> np.ndarray:
    """For each of ``texts`` texts the sum of the rows ``which`` of ``values`` that its tokens have."""
    out = np.zeros((texts, values.shape[1]))
    order = np.argsort(text, kind="stable")
    text, which = text[order], which[order]
    for low in range(0, len(text), SUMMED):
        some = text[low : low + SUMMED]
        edges = np.flatnonzero(np.r_[True, some[1:] != some[:-1]])
        out[some[edges]] += np.add.reduceat(values[which[low : low + SUMMED]], edges, axis=0)
    return out


def _documents(docs: DataFrame, frequent: pa.Table, width: int) -> DataFrame:
    """Two kinds of rows: sums of a text's frequent tokens (no word), and its other tokens, counted."""
    values = frequent.column("values").combine_chunks().flatten().to_numpy().reshape(-1, width)
    known = (frequent.column("trained").to_numpy() > 0).astype(float)
    held = (frequent.column("word").to_pylist(), np.column_stack([known, values]))
    shared = docs.sparkSession.sparkContext.broadcast(held)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["key", "doc_id", "word", "times", "bytes", "sums"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, values = shared.value
        at = {w: i for i, w in enumerate(words)}
        key = TaskContext.get().partitionId() << 40
        for batch in some_rows(batches, "text", LOOKED_UP):
            rows = batch.num_rows
            distinct, word, text = numbered_words(batch.column("text"))
            distinct = pa.concat_arrays([distinct, pa.array([b""], pa.binary())])  # the end of each text
            word, text = np.r_[word, np.full(rows, len(distinct) - 1)], np.r_[text, np.arange(rows)]
            found = np.array(list(map(at.get, distinct.to_pylist(), repeat(-1))), dtype=np.int64)[word]
            hit = found >= 0
            shared_sums = sums_by_text(text[hit], values, found[hit], rows)
            sums = pa.FixedSizeListArray.from_arrays(pa.array(shared_sums.ravel()), values.shape[1])
            keys = key + np.arange(rows)
            key += rows
            size = pc.binary_length(batch.column("text")).cast(pa.int64())
            tokens = pa.array(np.bincount(text, minlength=rows), pa.int64())
            arrays = [pa.array(keys), batch.column("doc_id"), pa.nulls(rows, pa.binary()), tokens, size]
            yield pa.RecordBatch.from_arrays([*arrays, sums.cast(pa.list_(pa.float64()))], names=names)
            pair, times = np.unique(text[~hit] * len(distinct) + word[~hit], return_counts=True)
            rare, ids = distinct.take(pa.array(pair % len(distinct))), batch.schema.field("doc_id").type
            arrays = [pa.array(keys[pair // len(distinct)]), pa.nulls(len(pair), ids), rare, pa.array(times, pa.int64())]
            arrays += [pa.nulls(len(pair), pa.int64()), pa.nulls(len(pair), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(apply, f"key long, doc_id {kind}, word binary, times long, bytes long, sums array<double>")


def score_documents(
    docs: DataFrame,
    folds: int = 5,
    held_fold: int = 1,
    frequent_share: float = 1e-6,
    words_per_task: int = 500_000,
    class_col: str | None = "lang",
    most_classes: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document with its token counts, unigram and model log10 probability, and bits per byte.

    The words of a text are mixed a second time: each class of the training texts is an expert
    that scales a word's probability by P(class | word) / P(class), and the experts' weights
    follow from how well they did on the words before. Over a whole text these weights
    telescope to the sum over classes of their share times the product of the ratios, each divided
    by the class's sum over all words, those never seen included, so that every expert is a
    distribution. The class of a text itself is never read when it is scored.

    Words that make up at least ``frequent_share`` of all tokens, at most a million of them with
    at most a million mean token lengths of bytes together, are looked up in a shared table; the
    others are joined. A null text is an empty one and has the end token only; repeated rows are
    scored each; null ids are in the training folds; an empty table gives no rows.
    """
    spark = docs.sparkSession
    steps = Steps(spark)
    training = docs.filter(fold(id_col, folds) != held_fold)
    kind = classes(training, class_col, most_classes)
    kinds = most_classes if class_col in docs.columns and most_classes > 1 else 1
    held = fold(id_col, folds) == held_fold
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.when(held, -1).otherwise(kind).cast("int").alias("kind"))
    words = steps.keep(count_words(texts, kinds), "words")
    each = [F.sum(F.col("by_class")[z]) for z in range(kinds)]
    row = words.agg(F.sum("trained"), F.count_if(F.col("trained") > 0), F.sum("total"), F.count(F.lit(1)), *each).first()
    tokens, distinct, total, types = (int(x or 0) for x in row[:4])
    ends = words.filter(F.octet_length("word") == 0).select("by_class").first()
    texts_by_class = np.array(ends[0] if ends else [0] * kinds, dtype=float)
    sums = Sums(tokens, distinct, np.array([x or 0 for x in row[4:]], dtype=float), texts_by_class)
    tasks = max(1, math.ceil(types / words_per_task))
    heads = spark.sparkContext.broadcast(count_heads(words))
    model = train(words, heads, tasks)
    scored = steps.keep(score_words(words, model, sums, heads, math.ceil(4 * types / words_per_task) or 1), "scored")
    least = max(2.0, frequent_share * total)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = steps.keep(_documents(rows, scored.filter(F.col("total") >= least).toArrow(), kinds + 2), "documents")
    rare = parts.filter("word is not null").select("key", "word", "times")
    joined = rare.join(scored.filter(F.col("total") < least).select("word", "trained", "values"), "word")
    seen = F.sum(F.when(F.col("trained") > 0, F.col("times")).otherwise(0)).cast("double")
    more = joined.groupBy("key").agg(
        seen.alias("m0"), *[F.sum(F.col("times") * F.col("values")[i]).alias(f"m{i + 1}") for i in range(kinds + 2)]
    )
    whole = parts.filter("word is null").drop("word").join(more, "key", "left")
    known, base, lm, *ratio = (F.col("sums")[i] + F.coalesce(F.col(f"m{i}"), F.lit(0.0)) for i in range(kinds + 3))
    share = (texts_by_class + 0.5) / (texts_by_class + 0.5).sum()
    norms = class_norms(scored, kinds)
    logs = [r + math.log10(s) - F.col("times") * n for r, s, n in zip(ratio, share, norms, strict=True)]
    top = F.greatest(*logs) if kinds > 1 else logs[0]
    mixed = top + F.log10(sum((F.pow(F.lit(10.0), x - top) for x in logs[1:]), F.pow(F.lit(10.0), logs[0] - top)))
    out = whole.select("doc_id", "times", "bytes", known.alias("known"), base.alias("base"), (lm + mixed).alias("score"))
    return out.select(
        "doc_id",
        (fold("doc_id", folds) == held_fold).alias("held_out"),
        F.col("times").alias("n_tokens"),
        F.col("known").cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        "score",
        (-F.col("score") * math.log2(10) / F.greatest(F.col("bytes"), F.lit(1))).alias("bits_per_byte"),
    )


def op4_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"))

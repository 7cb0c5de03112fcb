"""Packing examples into sequences under several limits at once, by the dot-product heuristic."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import Steps, fresh, some_rows, table

# ASCII punctuation that the tokenizer's pattern always keeps in one run of its own after a letter.
TAIL = ".,!;:?$%&*#"
SPECIAL = "<|"
WORDS_KEPT = 600_000
BATCH_BYTES = 4 << 20


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be shown."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


BYTE_CHARACTERS = _byte_characters()


def letters(text: str) -> str:
    """Normal form and lower case, one character at a time, as the tokenizer takes them."""
    return "".join(map(str.lower, unicodedata.normalize("NFC", text)))


class WordIds(dict):
    """Ids of words between white space, as little-endian bytes; those of a fixed number of words are kept.

    The tokenizer drops white space and never joins across it, so the ids of a text are
    those of its words in order. The same holds for letters and the punctuation after them.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        core = text.rstrip(TAIL)
        if core != text and letters(core).isalpha():
            return self[core.encode()] + self[text[len(core) :].encode()]
        if (plain := letters(text)).isalpha():
            # One run of letters: beyond normal form and case, the vocabulary's merges are all there is to do.
            shown = plain if plain.isascii() else "".join(map(BYTE_CHARACTERS.__getitem__, plain.encode()))
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(shown)], dtype="<u4").tobytes()
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = ids
        return ids

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text begins in it (one more at the end).

        Words are split and numbered by Arrow; only distinct ones are looked up.
        """
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten()
        # Beyond ASCII, letters and marks are put together before they are lower-cased.
        plain = pc.and_not(pc.string_is_ascii(words), pc.match_substring(words, SPECIAL))
        numbered = pc.if_else(plain, pc.ascii_lower(words), words).dictionary_encode()
        found = list(map(self.__getitem__, numbered.dictionary.cast(pa.binary()).to_pylist()))
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        word = numbered.indices.to_numpy()
        count = size[word]
        end = np.cumsum(count)
        ids = pool[np.repeat(first[word] - (end - count), count) + np.arange(count.sum())]
        return ids, np.r_[0, end][split.offsets.to_numpy() - split.offsets[0].as_py()]


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(
    docs: DataFrame,
    tokenizer: str,
    longest: int = 4096,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Documents as runs of at most ``longest`` ids: (doc_id, start, length, ids_crc32, doc_tokens[, ids]).

    ``tokenizer`` is the path of a vocabulary file that every executor has. A null text is an
    empty one: its only id is the end id.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(tokenizer), np.array([end_id], dtype="<u4")
        for batch in some_rows(batches, "text", BATCH_BYTES):
            ids, begin = words.of(batch.column("text"))
            at, cut = [], []
            for i in range(batch.num_rows):
                whole = np.concatenate([ids[begin[i] : begin[i + 1]], end])
                for start in range(0, len(whole), longest):
                    run = whole[start : start + longest]
                    at.append(i)
                    cut.append((start, len(run), zlib.crc32(run), len(whole), run if with_ids else None))
            columns = list(zip(*cut, strict=True)) if cut else [()] * 5
            arrays = [batch.column("doc_id").take(pa.array(at, pa.int64()))]
            arrays += [pa.array(c, pa.int64()) for c in columns[:4]]
            if with_ids:
                arrays.append(pa.array([r.astype(np.int32) for r in columns[4]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(apply, schema)


def dot_product_bins(demand: np.ndarray, limits: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and its place in that bin. demand: a row per item, a column per limit.

    One bin is open at a time. Among the items that still fit, the one with the largest dot
    product of its demand and what is left, both as shares of the limits and weighted by
    the mean demand, goes in next; the bin closes when none fits. Items of equal demand
    are interchangeable and are held as one kind with a count.
    """
    caps = np.asarray(limits, dtype=np.int64)
    if (demand > caps).any():
        raise ValueError("an item is over a limit on its own")
    kinds, kind_of = np.unique(demand, axis=0, return_inverse=True)
    order = np.argsort(kind_of.ravel(), kind="stable")
    count = np.bincount(kind_of.ravel(), minlength=len(kinds))
    ends = np.cumsum(count)
    share = kinds / caps
    weight = (demand / caps).mean(axis=0) if len(demand) else np.ones(len(caps))
    gain = share * weight
    bins, places = np.zeros(len(demand), dtype=np.int64), np.zeros(len(demand), dtype=np.int64)
    left, number, place = caps.copy(), 0, 0
    alive = np.arange(len(kinds))
    while len(alive):
        fits = alive[(kinds[alive] <= left).all(axis=1)]
        if not len(fits):
            left, number, place = caps.copy(), number + 1, 0
            continue
        best = fits[np.argmax(gain[fits] @ (left / caps))]
        item = order[ends[best] - count[best]]
        bins[item], places[item] = number, place
        left, place = left - kinds[best], place + 1
        count[best] -= 1
        if not count[best]:
            alive = alive[alive != best]
    return bins, places


def pack(
    items: DataFrame,
    limits: dict[str, int],
    tokens_col: str,
    bins_per_group: int = 1000,
) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``, no sum of a column of ``limits`` over its limit.

    ``items`` must be a stored table, so that its rows keep their task and place. A limit's
    column may be the literal count of segments. Items are dealt at random into groups of
    about ``bins_per_group`` full sequences and each group is packed on its own, which costs at
    most a part of a sequence a group. A null demand counts as zero; an item over a limit on its
    own fails the job; repeated rows are items of their own; an empty table gives no rows.
    """
    names = list(limits)
    shares = [F.sum(F.coalesce(F.col(c).cast("long"), F.lit(0))) / F.lit(limits[c]) for c in names]
    full = items.agg(F.greatest(*shares, F.lit(0.0))).first()[0] or 0
    groups = max(1, int(-(-full // bins_per_group)))
    row, group = fresh("item_row_", items.columns), fresh("item_group_", items.columns)
    dealt = items.withColumn(row, F.monotonically_increasing_id())
    dealt = dealt.withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups)))
    caps = [limits[c] for c in names]

    def apply(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(row, ignore_index=True)
        demand = frame[names].fillna(0).to_numpy(dtype=np.int64)
        bins, places = dot_product_bins(demand, caps)
        order = np.lexsort((places, bins))
        tokens = frame[tokens_col].fillna(0).to_numpy(dtype=np.int64)[order]
        before = np.cumsum(tokens) - tokens
        opens = np.r_[True, bins[order][1:] != bins[order][:-1]] if len(order) else np.zeros(0, dtype=bool)
        first = np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))
        offset = np.empty(len(order), dtype=np.int64)
        offset[order] = before - before[first]
        return frame.drop(columns=[row, group]).assign(
            sequence_id=(frame[group].to_numpy(dtype=np.int64) << 32) | bins, offset=offset
        )

    schema = T.StructType(list(items.schema.fields)).add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy(group).applyInPandas(apply, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    longest: int = 4096,
    segments: int = 1024,
    loss_tokens: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    A document is cut after every ``longest`` ids. A sequence has at most ``longest`` ids,
    ``segments`` pieces and ``loss_tokens`` ids that bear loss; in a document all ids do, so
    pieces are cut at the smaller of the two. Null, empty and very long texts, repeated rows
    and null ids are packed like any other; further columns are not read.
    """
    steps = Steps(docs.sparkSession)
    cut = pieces(docs, tokenizer, min(longest, loss_tokens), id_col=id_col, text_col=text_col)
    items = steps.keep(cut.withColumns({"segment": F.lit(1), "loss": F.col("length")}), "pieces")
    packed = pack(items, {"length": longest, "segment": segments, "loss": loss_tokens}, "length")
    return packed.drop("segment", "loss")


def op10_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), tokenizer_path())

"""Grouping of spelling variants: words one edit apart, by dynamic programming over sorted lists."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import Steps, table

LETTERS = "a-zÀ-ÿ"  # after lower-casing A-Z; all are one byte in Latin-1
GROUP_ROWS = 20_000  # a larger group is dealt again by a longer key
BATCH_ROWS = 60_000  # rows of whole groups that a task compares at a time
HELD_WORDS = 200_000  # words that a task counts before it passes them on
ROWS_A_TASK = 200_000


def word_counts(docs: DataFrame, letters: int, divisor: int) -> DataFrame:
    """(word, n): lower-cased runs of letters, with the runs that ``divisor`` marks one letter short."""
    pattern = re.compile(f"[{LETTERS}]{{{letters},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = [w for w in held if len(w) >= letters]
            made = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([held[w] for w in words], pa.int64())], names=["word", "n"]
            )
            held.clear()
            return made

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                start = zlib.crc32(f"{key}:".encode())
                for word, n in Counter(pattern.findall(text.lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % divisor == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield flush()
        yield flush()

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"),
        F.col("text").cast("binary").alias("text"),
    ).filter("text is not null")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))




def _dealt(words: DataFrame, steps: Steps) -> DataFrame:
    """Words in groups such that any two of at most one edit meet in a group of bounded size.

    ``short`` is the length of the shorter of two words. One edit leaves the first half of that
    length or the second as it is, so words meet by equal heads of ``before`` or equal tails of
    ``after`` letters. Groups above ``GROUP_ROWS`` are dealt again: the stretch between head and
    tail is halved once more, until a single letter is left between them, when a group has at
    most the words that differ in that letter or two.
    """

    def halved(rows: DataFrame) -> DataFrame:
        half = F.floor((F.col("short") - F.col("before") - F.col("after")) / 2).cast("int")
        left = F.struct((F.col("before") + half).alias("before"), F.col("after").alias("after"))
        right = F.struct(
            F.col("before").alias("before"),
            (F.col("short") - F.col("before") - half).alias("after"),
        )
        halves = rows.withColumn("side", F.explode(F.array(left, right)))
        return halves.select("word", "n", "short", F.col("side.before").alias("before"), F.col("side.after").alias("after"))

    size = F.char_length("word")
    rows = words.withColumn("short", F.explode(F.array(size, size - 1)))
    rows = rows.select("word", "n", "short", F.lit(0).alias("before"), F.lit(0).alias("after"))
    group, done, turn = ["short", "before", "after", "head", "tail"], None, 0
    while True:
        keyed = halved(rows).withColumns(
            {"head": F.expr("left(word, before)"), "tail": F.expr("right(word, after)")}
        )
        keyed = steps.keep(keyed, f"groups{turn}")
        counts = keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        large = counts.filter((F.col("size") > GROUP_ROWS) & (F.col("short") - F.col("before") - F.col("after") > 1))
        large = steps.keep(large, f"large{turn}")
        some = large.limit(1).count() > 0
        fit = counts.join(large, group, "left_anti") if some else counts
        ready = keyed.join(fit.select(*group), group, "left_semi")
        done = ready if done is None else done.unionByName(ready)
        if not some:
            return done
        rows = keyed.join(large.select(*group), group, "left_semi")
        turn += 1


def near_pairs(words: list[bytes], groups: np.ndarray, short: int, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (a, b) of words one edit apart in a group, where a has ``short`` letters.

    ``words`` are one byte a letter, of ``short`` or one more letters; words of a group share
    their first ``shared`` letters. The words of all groups are sorted; a range of the list that
    shares a prefix is one node with one banded row of the edit matrix (three cells) for each
    query that reaches it, so the row of a prefix is reckoned once for all words below it.
    The lengths of adjacent common prefixes give the ranges of the next letter. A range whose
    row exceeds one edit is skipped with all words in it.
    """
    sort = np.lexsort((np.array(words, dtype=f"S{short + 1}"), groups))
    letters = np.zeros((len(words), short + 3), np.uint8)
    for at, i in enumerate(sort):
        letters[at, : len(words[i])] = np.frombuffer(words[i], np.uint8)
    group, lengths = groups[sort], np.array([len(words[i]) for i in sort])
    differ = letters[1:] != letters[:-1]
    lcp = np.r_[-1, np.where(group[1:] == group[:-1], differ.argmax(axis=1), -1)]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], len(words)]
    nth = np.cumsum(np.r_[True, group[1:] != group[:-1]]) - 1
    query = np.flatnonzero(lengths == short)
    low, high = starts[nth[query]], ends[nth[query]]
    one = np.ones(len(query), np.int8)
    # Cells for y[:depth] against x[:depth - 1], x[:depth], x[:depth + 1]; the shared prefix costs nothing.
    row = np.stack([one + (shared == 0), one * 0, one], axis=1)
    found = []
    for depth in range(shared, short + 1):
        if depth == short:
            hit = (lengths[low] == depth) & (row[:, 1] == 1)
            found.append((query[hit], low[hit]))
        heads = np.flatnonzero((lcp <= depth) & (lengths > depth))
        first, last = np.searchsorted(heads, low), np.searchsorted(heads, high)
        count = last - first
        state = np.repeat(np.arange(len(query)), count)
        at = np.arange(len(state)) - np.repeat(np.cumsum(count) - count, count) + first[state]
        query, stop, old = query[state], high[state], row[state]
        low = heads[at]
        following = np.r_[heads, len(words)][at + 1]
        high = np.minimum(following, stop)
        letter = letters[low, depth]
        before = letters[query, depth - 1] if depth else np.zeros(len(query), np.uint8)
        a = np.minimum(old[:, 0] + (letter != before), old[:, 1] + 1)
        b = np.minimum(np.minimum(old[:, 1] + (letter != letters[query, depth]), old[:, 2] + 1), a + 1)
        c = np.minimum(old[:, 2] + (letter != letters[query, depth + 1]), b + 1)
        b = np.where(depth + 1 > short, 2, b)
        c = np.where(depth + 2 > short, 2, c)
        row = np.minimum(np.stack([a, b, c], axis=1), 2).astype(np.int8)
        alive = row.min(axis=1) <= 1
        query, low, high, row = query[alive], low[alive], high[alive], row[alive]
    hit = row[:, 0] == 1
    found.append((query[hit], low[hit]))
    a, b = (np.concatenate(side) for side in zip(*found, strict=True))
    return sort[a], sort[b]


def near_words(words: DataFrame, steps: Steps) -> DataFrame:
    """(word, near, near_n), each ordered pair of words one edit apart once."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def pairs() -> pa.RecordBatch:
            out: list[tuple] = []
            at = 0
            while at < len(held):
                short, before, after = held[at][0], held[at][1], held[at][2]
                end, groups, names = at, [], {}
                while end < len(held) and held[end][:3] == (short, before, after):
                    groups.append(names.setdefault(held[end][3:5], len(names)))
                    end += 1
                rows = held[at:end]
                at = end
                code = [r[5].encode("latin-1") for r in rows]
                turned = [w[::-1] for w in code] if after > before else code
                left, right = near_pairs(turned, np.array(groups), short, max(before, after))
                for i, j in zip(left.tolist(), right.tolist(), strict=True):
                    out.append((rows[i][5], rows[j][5], rows[j][6]))
                    if len(code[j]) > short:
                        out.append((rows[j][5], rows[i][5], rows[i][6]))
            held.clear()
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "near", "near_n"]
            )

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if len(held) >= BATCH_ROWS and row[:5] != held[-1][:5]:
                    yield pairs()
                held.append(row)
        if held:
            yield pairs()

    group = ["short", "before", "after", "head", "tail"]
    rows = _dealt(words, steps).select(*group, "word", "n")
    rows = steps.keep(rows, "dealt")
    tasks = max(1, -(-rows.count() // ROWS_A_TASK))
    sorted_rows = rows.repartition(tasks, *group).sortWithinPartitions(*group)
    return sorted_rows.mapInArrow(compare, "word string, near string, near_n long").distinct()


def spelling_groups(docs: DataFrame, letters: int = 6, least: int = 5, ratio: int = 5, divisor: int = 199) -> DataFrame:
    """One row per frequent word with the commoner word it is a variant of, and the end of that chain.

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts with A-Z
    lower-cased; a run whose checksum with the id ``divisor`` divides loses one letter. Those of
    at least ``letters`` code points and ``least`` occurrences are compared, each with every other
    one that one inserted, deleted or replaced code point makes of it. ``form`` is the near word
    with the largest count (ties: the smallest), if it is ``ratio`` times the word's own.

    A null text has no words, nor has an empty one; a null id counts as empty text in the checksum;
    repeated rows count as often as they occur; a text or word of any length is read whole; other
    columns are not read; without frequent words there are no rows.
    """
    steps = Steps(docs.sparkSession)
    counted = word_counts(docs, letters, divisor).filter(F.col("n") >= least)
    words = steps.keep(counted, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = steps.keep(
        near_words(words, steps).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best), "near"
    )
    joined = words.join(near, "word", "left")
    common = -F.col("best.less") >= ratio * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(common, F.col("best.near")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n"),
    )
    formed = steps.keep(formed, "formed")

    # Forms grow in count, so chains end. Every round doubles how far a word follows them.
    ends, turn = steps.keep(formed.filter("form is not null").select("word", F.col("form").alias("root")), "ends0"), 0
    while True:
        after = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = ends.join(after, "root", "left")
        later = steps.keep(
            moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            f"ends{turn + 1}",
        )
        more = later.filter("moved").limit(1).count() > 0
        ends, turn = later.select("word", "root"), turn + 1
        if not more:
            break
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_spelling_groups(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups(table(spark, folder, "documents"))

"""Near duplicates by 64-bit SimHash, found with Golay-code fuzzy keys."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import Steps, table
from tradewind.llm.components import components
from tradewind.llm.golay import near_indices

SEED = 42
# Bit ranges of a fingerprint: (first bit, bits). Each fits the 23 bits of the code.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SLICE = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority of the bits of the hashes of all word shingles; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        after = np.cumsum(lengths + 1)
        starts = (after - lengths - 1)[: len(words) - shingle + 1].tolist()
        ends = (after - 1)[shingle - 1 :].tolist()
    total, hashed = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), SLICE):
        pairs = zip(starts[at : at + SLICE], ends[at : at + SLICE], strict=True)
        values = np.array([hashed(joined[s:e], SEED) for s, e in pairs], dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(total * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every document as a signed 64-bit number."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(signed)], names=["id", "fp"])

    return rows.mapInArrow(apply, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def fuzzy_keys(prints: DataFrame) -> DataFrame:
    """(key, fp) such that fingerprints within two bits share a key.

    Two errors leave one of three segments without an error, and then one of the other two
    with at most one. A key is an exact segment with a nearby codeword of another one; every
    ordered pair of segments gives its keys.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            raw = fp.view(np.uint64)
            parts = [((raw >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
            near = [near_indices(p) for p in parts]
            for number, (exact, fuzzy) in enumerate(permutations(range(len(SEGMENTS)), 2)):
                index = near[fuzzy]
                key = (np.int64(number) << 40) | (parts[exact][:, None] << 12) | index
                at = np.nonzero(index.ravel() >= 0)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel()[at]), pa.array(np.repeat(fp, index.shape[1])[at])], names=["key", "fp"]
                )

    return prints.mapInArrow(apply, "key long, fp long")


def _star(groups: DataFrame, key: str) -> DataFrame:
    """Links from every member of a group to its smallest member."""
    least = groups.groupBy(key).agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n"))
    return groups.join(least.filter("n > 1").drop("n"), key).filter("fp > least").select(
        F.col("fp").alias("a"), F.col("least").alias("b")
    )


def links(prints: DataFrame, steps: Steps, max_bits: int, bucket: int) -> DataFrame:
    """Links (a, b) that join exactly the distinct fingerprints within ``max_bits`` of each other.

    A key shared by at most ``bucket`` fingerprints is joined with itself and its pairs are
    verified. Fingerprints of larger groups are linked in another exact way: those within two
    bits are those with a common neighbour at one bit or less, so grouping by all
    neighbours finds every link without a pair, at 65 rows a fingerprint (``max_bits`` 2; for
    1, a neighbour must itself be a fingerprint).
    """
    keys = steps.keep(fuzzy_keys(prints), "keys")
    shared = steps.keep(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    small = keys.join(shared.filter(F.col("n") <= bucket).drop("n"), "key")
    other = small.select("key", F.col("fp").alias("b"))
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("b")))
    pairs = small.join(other, "key").filter((F.col("fp") < F.col("b")) & (differ <= max_bits))
    found = pairs.select(F.col("fp").alias("a"), "b").distinct()
    crowded = keys.join(shared.filter(F.col("n") > bucket).drop("n"), "key").select("fp").distinct()
    near = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64 if i == 63 else 0))) for i in range(64)]
    around = crowded.select("fp", F.explode(F.array(*near)).alias("around"))
    if max_bits == 2:
        return found.union(_star(around, "around"))
    near_one = around.filter("around <> fp").join(crowded.select(F.col("fp").alias("around")), "around")
    return found.union(near_one.select(F.col("fp").alias("a"), F.col("around").alias("b")))


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket: int = 64,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of the documents.

    Equal fingerprints are one node, so groups of copies, also of a third of all rows, cost
    one combined count. A null or empty text has fingerprint zero and is linked like any
    other; a null id never is a component's id unless no member has an id; repeated rows
    are returned as often as they come; further columns are not read; an empty table gives
    no rows. ``max_bits`` is 0, 1 or 2.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("the segments are cut for at most 2 differing bits")
    steps = Steps(docs.sparkSession)
    prints = steps.keep(fingerprints(docs, shingle, id_col, text_col), "prints")
    nodes = steps.keep(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    if max_bits:
        linked = steps.keep(components(links(nodes.select("fp"), steps, max_bits, bucket), steps), "roots")
        for name in ("keys", "shared"):
            steps.drop(name)
        rooted = nodes.join(linked.select(F.col("node").alias("fp"), "root"), "fp", "left")
        rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
        smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        nodes = rooted.join(smallest, "root").select("fp", "component_id")
    else:
        nodes = nodes.withColumnRenamed("least", "component_id")
    return prints.join(nodes, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_golay_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle=3, max_bits=2)

"""Vectors as blocks of bounded size, and a query set met with all rows block by block."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import Steps

Payload = Callable[[np.ndarray], dict[str, bytes]]


@dataclass
class Block:
    """Rows of one block: a number of their own, their ids, and a matrix of double values."""

    rows: np.ndarray
    ids: np.ndarray
    matrix: np.ndarray


def usable(vectors: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """(id, vec) of the vectors that are present, without null or non-finite components."""
    value = F.col(vector_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kept = F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & ~F.exists(value, bad)
    if nonzero:
        kept &= F.exists(value, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), value.alias("vec"), kept.alias("kept")).filter(
        "kept"
    ).drop("kept")


def to_blocks(rows: DataFrame, size: int, count: int, extra: Payload | None = None, names: tuple = ()) -> DataFrame:
    """(block, rows, ids, matrix, ...) with at most ``size`` vectors a row, dealt evenly over tasks.

    ``rows`` is (row, id, vec). ``extra`` makes further binary columns ``names`` of a block's matrix.
    """

    def flush(parts: list[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
        part = pa.Table.from_batches(parts).combine_chunks()
        lists = part.column("vec").chunk(0)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        lengths = np.diff(lists.offsets.to_numpy())
        if len(set(lengths.tolist())) > 1:
            raise ValueError("vectors differ in length")
        matrix = flat.reshape(len(lengths), -1)
        made = {
            "rows": part.column("row").to_numpy().astype("<i8").tobytes(),
            "ids": part.column("id").to_numpy().astype("<i8").tobytes(),
            "matrix": matrix.astype("<f8").tobytes(),
        } | (extra(matrix) if extra else {})
        block = (TaskContext.get().partitionId() << 32) | number
        arrays = [pa.array([block], pa.int64())] + [pa.array([made[k]], pa.binary()) for k in made]
        yield pa.RecordBatch.from_arrays(arrays, names=["block", *made])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held, number = [], 0, 0
        for batch in batches:
            while batch.num_rows:
                take = min(size - held, batch.num_rows)
                waiting.append(batch.slice(0, take))
                held, batch = held + take, batch.slice(take)
                if held == size:
                    yield from flush(waiting, number)
                    waiting, held, number = [], 0, number + 1
        if held:
            yield from flush(waiting, number)

    schema = "block long, rows binary, ids binary, matrix binary" + "".join(f", {n} binary" for n in names)
    return rows.repartition(max(1, math.ceil(count / size))).mapInArrow(apply, schema)


def block_of(row: dict, prefix: str = "") -> Block:
    rows = np.frombuffer(row[f"{prefix}rows"], dtype="<i8")
    matrix = np.frombuffer(row[f"{prefix}matrix"], dtype="<f8").reshape(len(rows), -1)
    return Block(rows, np.frombuffer(row[f"{prefix}ids"], dtype="<i8"), matrix)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    answer: Callable[[Block, Block, dict], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score_type: str,
    extra: Payload | None = None,
    names: tuple = (),
    size: int = 8192,
    queries: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` of what ``answer`` finds in each pair of blocks.

    Every block of candidates meets every block of queries once, over an equal key; the
    number of query blocks is all that the driver learns. ``answer`` gives, for a block of
    queries and one of candidates, the positions of both and the score of what it
    found, without a query's own row. Larger scores come first, then smaller ids. Rows that
    share an id are candidates for each other.
    """
    steps = Steps(vectors.sparkSession)
    rows = steps.keep(vectors, "vectors").withColumn("row", F.monotonically_increasing_id()).select("row", "id", "vec")
    asked = rows.filter(is_query)
    total, number = rows.count(), asked.count()
    held = steps.keep(to_blocks(rows, size, total, extra, names), "candidates")
    sought = to_blocks(asked, queries, number)
    sought = steps.keep(sought.select(*[F.col(c).alias(f"q_{c}") for c in sought.columns]), "queries")
    keys = [r[0] for r in sought.select("q_block").collect()]
    pairs = held.withColumn("q_block", F.explode(F.array(*[F.lit(b).cast("long") for b in keys]).cast("array<long>")))
    pairs = pairs.join(sought.hint("shuffle_hash"), "q_block")
    pairs = pairs.repartition(max(1, math.ceil(total / size) * max(1, len(keys))), "block", "q_block")
    kind = pa.int64() if score_type == "long" else pa.float64()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                ask, have = block_of(row, "q_"), block_of(row)
                q, c, score = answer(ask, have, row)
                arrays = [pa.array(ask.rows[q]), pa.array(ask.ids[q]), pa.array(have.rows[c]), pa.array(have.ids[c])]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(score, kind)], names=["q_row", "query_id", "row", "vec_id", "score"]
                )

    found = pairs.mapInArrow(apply, f"q_row long, query_id long, row long, vec_id long, score {score_type}")
    best = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_of(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the best ``k`` of each query: larger score, then smaller id."""
    order = np.lexsort((ids, -score, q))
    ordered = q[order]
    first = np.searchsorted(ordered, ordered)
    return order[np.arange(len(order)) - first < k]

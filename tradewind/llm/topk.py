"""Exact top-k by inner product: branch and bound over blocks of dimensions."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.blocks import Block, best_of, search, usable
from tradewind.llm.common import table

CHUNK = 128
DENSE = 0.25


def _exact_type(queries: np.ndarray, rows: np.ndarray) -> type:
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    if most >= 2**53:
        raise ValueError("inner products are beyond exact double precision")
    return np.float32 if most < 2**24 else np.float64


def branch_and_bound(ask: Block, have: Block, _: dict, k: int, dims: int) -> tuple:
    """The best ``k`` integer inner products of each query within a block of candidates.

    Candidates lie dimension by dimension, those with the most mass first. After every block
    of ``dims`` dimensions a candidate's score is at most its partial sum plus the product
    of the two norms over the dimensions left (Cauchy-Schwarz); below the k-th best score
    known, it goes, and the survivors are compacted. All scores of survivors are exact.
    """
    kind = _exact_type(ask.matrix, have.matrix)
    order = np.argsort(-np.square(have.matrix).sum(axis=0), kind="stable")
    rows = np.ascontiguousarray(have.matrix[:, order].T.astype(kind))
    cuts = range(0, len(order), dims)
    rest = np.stack([np.sqrt(np.square(rows[c:], dtype=np.float64).sum(axis=0)) for c in [*cuts, len(order)]])
    found: list[tuple] = []
    for at in range(0, len(ask.rows), CHUNK):
        queries = ask.matrix[at : at + CHUNK][:, order].astype(kind)
        left = np.stack([np.sqrt(np.square(queries[:, c:], dtype=np.float64).sum(axis=1)) for c in [*cuts, len(order)]])
        own = have.rows[None, :] == ask.rows[at : at + CHUNK, None]
        dense, sums = True, np.zeros((len(queries), rows.shape[1]), dtype=kind)
        sums[own] = -np.inf
        least = np.full(len(queries), -np.inf)
        for step, cut in enumerate(cuts, 1):
            block = slice(cut, cut + dims)
            if dense:
                sums += queries[:, block] @ rows[block]
                if rows.shape[1] > k:
                    likely = np.argpartition(-sums, k - 1, axis=1)[:, :k]
                    full = np.einsum("qd,dqk->qk", queries, rows[:, likely])
                    full[np.take_along_axis(own, likely, axis=1)] = -np.inf
                    least = np.maximum(least, full.min(axis=1))
                bound = sums + left[step][:, None] * rest[step][None, :]
                alive = bound >= (least - 1e-3 - 1e-6 * np.abs(least))[:, None]
                if alive.mean() < DENSE or step == len(cuts):
                    alive &= ~own
                    q, c = np.nonzero(alive)
                    score, dense = sums[q, c], False
            else:
                score = score + np.einsum("pd,dp->p", queries[q][:, block], rows[block][:, c])
                limit = least[q] - 1e-3 - 1e-6 * np.abs(least[q])
                alive = score + left[step][q] * rest[step][c] >= limit
                q, c, score = q[alive], c[alive], score[alive]
        if not len(cuts):  # vectors without components: every score is 0
            q, c = np.nonzero(~own)
            score = sums[q, c]
        top = best_of(q, have.ids[c], score, k)
        found.append((q[top] + at, c[top], score[top].astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def top_k(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    scale: int = 64,
    dims: int = 8,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): exact integer inner products of vectors scaled and floored.

    Queries are the rows whose id is divisible by ``every``. Vectors that are null, hold null or
    non-finite components or have no id take no part; ties go to the smaller id; repeated
    rows are candidates of their own; zero vectors and those without components have score 0; an empty table gives no rows;
    further columns are not read. Vectors of different lengths fail the job.
    """
    whole = usable(vectors, id_col, vector_col, nonzero=False)
    whole = whole.withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double")))
    return search(whole, F.col("id") % every == 0, k, partial(branch_and_bound, k=k, dims=dims), "long")


def op7_columnar_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))

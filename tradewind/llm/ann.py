"""Approximate nearest neighbours by collision counting over sorted projections."""

from __future__ import annotations

import math
from functools import cache, partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.blocks import Block, best_of, search, usable
from tradewind.llm.common import table

SEED = 20
FIRST_RADIUS, LAST_RADIUS = 0.3, 2.0


@cache
def directions(dims: int, lines: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dims, lines))


def unit(matrix: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that very large and very small vectors keep their direction.
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.square(scaled).sum(axis=1, keepdims=True))


def sorted_lines(matrix: np.ndarray, lines: int) -> dict[str, bytes]:
    """The index of a block: for every projection its values in order, and the rows in that order."""
    values = (unit(matrix) @ directions(matrix.shape[1], lines)).T
    order = np.argsort(values, axis=1, kind="stable")
    ordered = np.take_along_axis(values, order, axis=1)
    return {"line_rows": order.astype("<u2").tobytes(), "line_values": ordered.astype("<f8").tobytes()}


def collisions(ask: Block, have: Block, index: dict, k: int, lines: int, width: float, sure: float, grow: float) -> tuple:
    """The best ``k`` verified cosines of each query within a block of candidates.

    On every line a window around the query's projection has the half-width ``width`` times
    a radius. The radius grows step by step (virtual rehashing: the same arrays, wider
    windows) and rows newly inside a window collide once more. A vector at the radius collides on
    a known share of the lines; rows with that share, less ``sure`` standard deviations, are
    verified on the original vectors. The search of a query ends when its k-th best verified
    distance is within the radius, or when windows have reached every row.
    """
    count = len(have.rows)
    order = np.frombuffer(index["line_rows"], dtype="<u2").reshape(lines, count)
    values = np.frombuffer(index["line_values"], dtype="<f8").reshape(lines, count)
    centres = (unit(ask.matrix) @ directions(ask.matrix.shape[1], lines)).T[:, :, None]
    share = math.erf(width / math.sqrt(2))
    needed = lines * share - sure * math.sqrt(lines * share * (1 - share))
    norms = np.sqrt(np.square(have.matrix).sum(axis=1))
    steps = math.ceil(math.log(LAST_RADIUS / FIRST_RADIUS, grow))
    radii = FIRST_RADIUS * grow ** np.arange(steps + 1)
    # The last window holds every row.
    reach = np.append(width * radii[:-1], np.inf)
    below = np.stack([np.searchsorted(values[j], centres[j] - reach) for j in range(lines)], axis=1)
    above = np.stack([np.searchsorted(values[j], centres[j] + reach, "right") for j in range(lines)], axis=1)
    found: list[tuple] = []
    for i, query in enumerate(ask.matrix):
        norm = math.sqrt(np.square(query).sum())
        hits = np.zeros(count, dtype=np.int64)
        score = np.full(count, np.nan)
        own = np.nonzero(have.rows == ask.rows[i])[0]
        lows, highs = below[i].T.tolist(), above[i].T.tolist()
        low = high = lows[0]
        for step, radius in enumerate(radii):
            # Rows that the window takes in at this step, on the left and on the right.
            fresh = [order[j, b:e] for j, (b, e) in enumerate(zip(lows[step], low, strict=True)) if b < e]
            fresh += [order[j, b:e] for j, (b, e) in enumerate(zip(high, highs[step], strict=True)) if b < e]
            low, high = lows[step], highs[step]
            if fresh:
                hits += np.bincount(np.concatenate(fresh), minlength=count)
            hits[own] = 0
            check = np.nonzero((hits >= needed) & np.isnan(score))[0]
            score[check] = (have.matrix[check] * query).sum(axis=1) / (norms[check] * norm)
            seen = np.nonzero(~np.isnan(score))[0]
            if len(seen) >= k and np.partition(score[seen], -k)[-k] >= 1 - radius * radius / 2:
                break
        else:
            seen = np.setdiff1d(np.arange(count), own)
            score = (have.matrix * query).sum(axis=1) / (norms * norm)
        top = seen[best_of(np.zeros(len(seen), dtype=int), have.ids[seen], score[seen], k)]
        found.append((np.full(len(top), i), top, score[top]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def neighbours(
    vectors: DataFrame,
    every: int = 50,
    k: int = 5,
    lines: int = 96,
    width: float = 1.0,
    sure: float = 1.65,
    grow: float = 1.1,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): nearest rows by cosine for ids divisible by ``every``.

    Every row is indexed, in blocks of at most 8,192 with arrays of their own. Vectors that
    are null, zero, hold null or non-finite components or have no id take no part; equal
    scores go to the smaller id; repeated rows are candidates of their own; with fewer
    than ``k`` candidates all are returned; an empty table gives no rows; further columns are
    not read.
    """
    whole = usable(vectors, id_col, vector_col, nonzero=True)
    answer = partial(collisions, k=k, lines=lines, width=width, sure=sure, grow=grow)
    names = ("line_rows", "line_values")
    index = partial(sorted_lines, lines=lines)
    return search(whole, F.col("id") % every == 0, k, answer, "double", index, names, queries=512)


def op9_collision_ann(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours(table(spark, folder, "embeddings"))

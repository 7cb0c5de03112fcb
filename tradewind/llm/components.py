"""Connected components of a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import Steps

ROWS_A_TASK = 250_000


def _pair(a: str, b: str) -> Column:
    return F.struct(F.col(a).alias("a"), F.col(b).alias("b"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.inline(F.array(_pair("a", "b"), _pair("b", "a"))))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.inline(F.array(_pair("b", "m"), _pair("a", "m"))))


def components(links: DataFrame, steps: Steps, name: str = "links") -> DataFrame:
    """(node, root) for every node that has a link; the root is the smallest node reachable.

    Every round replaces links by links to smaller nodes and ends when none changes, after
    about the logarithm of the longest chain. A node with very many links is one group of a
    combined minimum and one key of a join that adaptive execution splits; no node's links
    and no component are gathered. A round reads its links in tasks of ``ROWS_A_TASK``, so few
    links cost few tasks. Nodes must not be null; repeated links are one.
    """
    clean = links.select("a", "b").filter("a <> b").distinct()
    now, sign, turn = steps.keep(clean, f"{name}0"), None, 0
    tasks = max(1, -(-now.count() // ROWS_A_TASK))
    while True:
        turn += 1
        # Stars never add links, so the tasks of the first round suffice for all.
        starred = _small_star(_large_star(now.coalesce(tasks))).filter("a <> b").distinct()
        later = steps.keep(starred, f"{name}{turn}")
        row = later.agg(
            F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))
        ).first()
        steps.drop(f"{name}{turn - 1}")
        now = later
        if tuple(row) == sign:
            break
        sign = tuple(row)
    root = F.col("b").alias("root")
    return now.select(F.col("a").alias("node"), root).union(now.select(F.col("b").alias("node"), root).distinct())

"""Mixing sources by temperature: weights that meet a target, and the passes that realise them."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import Steps, fresh, table

WORD = r"[^\x20\x09-\x0D]+"
CUTS, ROUNDS = 16, 6


@dataclass
class Target:
    """What the exponent has to meet: at most ``repeats`` passes, or at least ``entropy`` (0 to 1 of the largest)."""

    repeats: float | None = 2.0
    entropy: float | None = None

    def __post_init__(self):
        if (self.repeats is None) == (self.entropy is None):
            raise ValueError("give a repetition limit or a target entropy")


def solve_exponent(sources: DataFrame, target: Target, budget: float | None) -> float:
    """The smallest exponent within the repetition limit, or the largest that reaches the entropy.

    Both measures change one way with the exponent between 0 and 1. One job measures 15 inner
    points at once, which is four halvings; six jobs settle 24. Only sums over sources reach
    the driver. Without a feasible exponent below 1, sources keep their own shares (1).
    """
    low, high = 0.0, 1.0
    total, most, number = sources.agg(F.sum("t"), F.max("t"), F.count(F.lit(1))).first()
    if not number:
        return 1.0

    def measures(points: list[float]) -> list[bool]:
        share = F.col("t") / F.lit(float(total))
        columns = []
        for i, a in enumerate(points):
            columns += [F.sum(F.pow(share, F.lit(a))).alias(f"z{i}"), F.sum(F.pow(share, F.lit(a)) * F.log(share)).alias(f"l{i}")]
            columns.append(F.max(F.pow(share, F.lit(a - 1))).alias(f"r{i}"))
        row, met = sources.agg(*columns).first(), []
        for i, a in enumerate(points):
            z, l, r = row[f"z{i}"], row[f"l{i}"], row[f"r{i}"]
            if target.entropy is not None:
                met.append(number < 2 or (log(z) - a * l / z) / log(number) >= target.entropy)
            else:
                passes = r / (most / total) ** (a - 1) if budget is None else r * budget / (z * total)
                met.append(passes <= target.repeats * (1 + 1e-12))
        return met

    rising = target.entropy is None
    if not measures([1.0 if rising else 0.0])[0]:
        return 1.0 if rising else 0.0
    if measures([0.0 if rising else 1.0])[0]:
        return 0.0 if rising else 1.0
    for _ in range(ROUNDS):
        points = [low + (high - low) * i / CUTS for i in range(1, CUTS)]
        met = measures(points)
        good = [p for p, m in zip(points, met, strict=True) if m]
        bad = [p for p, m in zip(points, met, strict=True) if not m]
        low, high = (max(bad, default=low), min(good, default=high)) if rising else (max(good, default=low), min(bad, default=high))
    return high if rising else low




def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(
    docs: DataFrame,
    target: Target | None = None,
    budget: int | None = None,
    block_tokens: int = 1_000_000,
    seed: int = 17,
    source_col: str = "source",
    text_col: str = "text",
    per_task: int = 20_000,
) -> tuple[DataFrame, dict[str, str]]:
    """One row per drawn copy of a document, with all its columns, and the names of the new ones.

    A source's weight is its token share to the power of the exponent, normalised. ``budget`` is
    the tokens to draw; without it, it is the least that draws every source at least once in
    full, so no document is left out. A source is drawn in passes, each a permutation of all its
    documents by hash; the last pass ends where the source's part of the budget does. New
    columns: ``tokens``, ``pass``, ``offset`` (tokens of the source drawn before), ``weight``,
    ``block`` (every block holds all sources at their weights) and ``place`` (order in a block).

    Documents without tokens, and sources of only such, are drawn once without a budget. A null
    source is a source; repeated rows are drawn each; an empty table gives no rows. A source is never
    ordered in one task: passes are split by hash, and the parts' sums give their offsets. Equal
    rows, of which more than ``per_task`` are dealt over several parts, tie.
    """
    target = target or Target()
    steps = Steps(docs.sparkSession)
    names = {n: fresh(n, docs.columns) for n in ("tokens", "pass", "offset", "weight", "block", "place")}
    row, group = fresh("mix_row_", docs.columns), fresh("mix_source_", docs.columns)
    # Permutations follow from what a row holds, so a rerun draws the same; only equal rows tie.
    print_ = fresh("mix_print_", docs.columns)
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    keyed = docs.withColumns(
        {
            names["tokens"]: count_tokens(F.col(text_col)),
            group: F.to_json(F.struct(F.col(source_col).alias("s"))),
            print_: F.xxhash64(*hashed),
        }
    )
    stored = steps.keep(keyed, "documents").withColumn(row, F.monotonically_increasing_id())
    slim = stored.select(F.col(row).alias("r"), F.col(group).alias("g"), F.col(names["tokens"]).alias("n"), F.col(print_).alias("p"))
    sources = steps.keep(slim.groupBy("g").agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("rows")), "sources")
    live = sources.filter("t > 0")
    total, most, rows = sources.agg(F.sum("t"), F.max("t"), F.sum("rows")).first()
    total, most, rows = total or 0, most or 0, rows or 0
    exponent = solve_exponent(live, target, budget)
    raw = F.pow(F.col("t") / F.lit(float(max(1, total))), F.lit(exponent))
    z = live.agg(F.sum(raw)).first()[0] or 1.0
    whole = budget if budget is not None else most / ((most / max(1, total)) ** exponent / z) if total else 0
    weighted = sources.withColumn("w", F.when(F.col("t") > 0, raw / F.lit(z)).otherwise(0.0))
    weighted = weighted.withColumn("q", F.col("w") * F.lit(float(whole)))
    weighted = weighted.withColumn("passes", F.when(F.col("t") > 0, F.floor(F.col("q") / F.col("t"))).otherwise(0).cast("int"))
    parts = max(1, -(-rows // per_task))
    drawn = slim.join(weighted.select("g", "t", "w", "q", "passes"), "g")
    # Equal rows have one place in a permutation; very many of them are split over several.
    copies = slim.groupBy("p").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > per_task)
    copies = steps.keep(copies.select("p", F.ceil(F.col("c") / per_task).cast("long").alias("split")), "copies")
    drawn = drawn.join(copies, "p", "left")
    drawn = drawn.withColumn("e", F.explode(F.sequence(F.lit(0), F.col("passes"))))
    spread = F.pmod(F.xxhash64("r", F.lit(seed)), F.col("split"))
    one_of = F.when(F.col("split").isNotNull(), F.xxhash64("p", "e", F.lit(seed), spread))
    drawn = drawn.withColumn("key", F.coalesce(one_of, F.xxhash64("p", "e", F.lit(seed)))).drop("split")
    drawn = drawn.withColumn("part", F.pmod(F.shiftright("key", 17), F.lit(parts)))
    inside = Window.partitionBy("g", "e", "part").orderBy("key", "r")
    placed = drawn.withColumn("inside", F.sum("n").over(inside) - F.col("n"))
    sums = drawn.groupBy("g", "e", "part").agg(F.sum("n").alias("s"))
    starts = sums.withColumn("first", F.sum("s").over(Window.partitionBy("g", "e").orderBy("part")) - F.col("s")).drop("s")
    offsets = placed.join(starts, ["g", "e", "part"]).withColumn("o", F.col("e") * F.col("t") + F.col("first") + F.col("inside"))
    taken = offsets.filter((F.col("o") < F.col("q")) | ((F.col("e") == 0) & F.lit(budget is None)))
    share = F.greatest(F.col("w") * F.lit(float(block_tokens)), F.lit(1.0))
    chosen = taken.select(
        F.col("r").alias(row), F.col("e").alias(names["pass"]), F.col("o").alias(names["offset"]), F.col("w").alias(names["weight"]),
        F.floor(F.col("o") / share).alias(names["block"]), F.xxhash64("key", F.lit(seed)).alias(names["place"]),
    )
    chosen = steps.keep(chosen, "drawn")
    return stored.join(chosen.hint("shuffle_hash"), row).select(*docs.columns, *names.values()), names


def op3_temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    slim = docs.select("doc_id", "source", "text")
    rows, names = mix(slim)
    return rows.select("doc_id", "source", *[F.col(c).alias(n) for n, c in names.items()])

"""Checks on a built model. Every check returns rows with a difference and a verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import ratio
from tradewind.operators.profiling import by_key_sets, key_profile, union_all, with_parents


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def with_total(counts: DataFrame, label: str = "TOTAL") -> DataFrame:
    total = counts.agg(F.sum("row_count").alias("row_count"))
    return counts.unionByName(total.select(F.lit(label).alias("table_name"), "row_count"))


def _verdict(df: DataFrame, expected: str, actual: str) -> DataFrame:
    difference = F.col(actual) - F.col(expected)
    return df.withColumn("difference", difference).withColumn("passed", F.col("difference") == 0)


def compare_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows before and after a load, one row per entity."""
    sides = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(entity).alias("entity"), F.lit(side).alias("side"), "n")
        for entity, (staged, loaded) in pairs.items()
        for side, df in (("staging", staged), ("model", loaded))
    ]
    counts = (
        union_all(sides)
        .groupBy("entity")
        .agg(
            F.sum(F.when(F.col("side") == "staging", F.col("n"))).alias("staging_rows"),
            F.sum(F.when(F.col("side") == "model", F.col("n"))).alias("model_rows"),
        )
    )
    return _verdict(counts, "staging_rows", "model_rows")


def _sums(df: DataFrame, columns: Sequence[str], value_name: str) -> DataFrame:
    """Sums of several columns in one pass, one row per column."""
    wide = df.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(22,2)").alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias(value_name)) for c in columns])
    return wide.select(F.inline(pairs))


def compare_sums(pairs: Mapping[tuple[str, ...], tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Totals of measures before and after a load; the key names the measures of one table pair."""
    staged = union_all([_sums(s, columns, "staging_total") for columns, (s, _) in pairs.items()])
    loaded = union_all([_sums(m, columns, "model_total") for columns, (_, m) in pairs.items()])
    return _verdict(staged.join(loaded, "measure"), "staging_total", "model_total")


def check_grain(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Rows beyond the first at the declared grain of every table."""
    profiles = union_all([key_profile(df, keys, name) for name, (df, keys) in tables.items()])
    return profiles.select(
        "table_name",
        F.col("key_columns").alias("grain"),
        F.col("duplicates").alias("duplicate_count"),
        F.col("is_unique").alias("passed"),
    )


def check_identity(df: DataFrame, row_key: str, person: str) -> DataFrame:
    """Row-level customers against real people, and the overcount if rows were counted."""
    per_person = df.groupBy(person).agg(F.count(row_key).alias("n"))
    return per_person.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("customer_rows"), F.count(person).alias("people")
    ).withColumn("overcount", F.col("customer_rows") - F.col("people"))


def check_constraints(
    name: str,
    df: DataFrame,
    not_null: Sequence[str] = (),
    unique: Sequence[Sequence[str]] = (),
    references: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> DataFrame:
    """Violations of NOT NULL, UNIQUE and foreign-key rules. A null foreign key passes.

    The table is read once, whatever the number of rules: its rows are counted by every unique key,
    by every foreign key and by which required columns they lack, in one aggregate; the values of
    all foreign keys then meet the keys of all parents in one join.
    """
    relations = [(column, column, parent, key) for column, (parent, key) in (references or {}).items()]
    lacking = sum(
        (F.when(F.col(c).isNull(), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(not_null)),
        F.lit(0).cast("long"),
    )
    lacks = "_lacks"
    sets = [list(keys) for keys in unique] + [[c] for c, _, _, _ in relations] + [[lacks]] * bool(not_null)
    groups, numbers = by_key_sets(df.withColumn(lacks, lacking), sets)
    foreign = numbers[len(unique) : len(unique) + len(relations)]
    if relations:
        groups = with_parents(groups, foreign, relations)
    of, rows = F.col("_set"), []

    def rule(kind: str, columns: str, condition: Column, value: Column | None = None) -> None:
        found = F.sum(F.when(condition, F.col("_n") if value is None else value))
        rows.append(
            F.struct(F.lit(kind).alias("rule"), F.lit(columns).alias("columns"), F.coalesce(found, F.lit(0)).alias("violations"))
        )

    for i, c in enumerate(not_null):
        rule("not null", c, (of == numbers[-1]) & (F.col(lacks).bitwiseAND(F.lit(1 << i).cast("long")) != 0))
    for keys, number in zip(unique, numbers, strict=False):
        rule("unique", " + ".join(keys), of == number, F.col("_n") - 1)
    for (column, _, _, _), number in zip(relations, foreign, strict=True):
        rule("foreign key", column, (of == number) & F.col(column).isNotNull() & F.col("_found").isNull())
    found = groups.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
    return found.select(
        F.lit(name).alias("table_name"), "rule", "columns", "violations", (F.col("violations") == 0).alias("passed")
    )


def fanout(left: DataFrame, right: DataFrame, on: str, measure: str) -> DataFrame:
    """What a sum becomes when its table is first joined many-to-many, next to the right sum.

    Every row of ``left`` would appear once per matching row of ``right``, so the
    inflated sum is the sum per key times the matches per key. The joined rows are
    never produced: both sides meet as one row per key.
    """
    sums = left.groupBy(on).agg(F.sum(measure).alias("_sum"))
    matches = right.groupBy(on).agg(F.count(F.lit(1)).alias("_matches"))
    per_key = sums.join(matches, on, "left")
    inflated = F.sum(F.col("_sum") * F.col("_matches").cast("decimal(12,0)")).cast("decimal(22,2)")
    both = per_key.agg(
        F.sum("_sum").cast("decimal(22,2)").alias("own_grain"), F.coalesce(inflated, F.lit(0)).alias("joined")
    )
    methods = F.array(
        F.struct(F.lit("joined to payments").alias("method"), F.col("joined").alias("value")),
        F.struct(F.lit("own grain").alias("method"), F.col("own_grain").alias("value")),
    )
    phantom = F.col("value") - F.col("own_grain")
    return both.select("own_grain", F.inline(methods)).select(
        "method",
        "value",
        phantom.alias("phantom"),
        ratio(phantom, F.col("own_grain"), 2, 100).alias("phantom_pct"),
    )

"""Table, key and relation profiles. Each reads its table once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """One row per column: type, rows and columns of the table, nulls in the column."""
    totals = df.agg(
        F.count(F.lit(1)).alias("table_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col(f"n{i}").alias("nulls"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
    )
    return totals.select("table_rows", F.inline(per_column)).select(
        F.lit(name).alias("table_name"),
        "position",
        "column_name",
        "data_type",
        F.col("table_rows"),
        F.lit(len(df.columns)).alias("table_columns"),
        "nulls",
    )


def duplicate_rows(df: DataFrame, name: str) -> DataFrame:
    """Rows that repeat an earlier row in every column; nulls count as equal."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("table_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    ).select(F.lit(name).alias("table_name"), "table_rows", "duplicates")


def key_profile(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Uniqueness of a key of one or more columns. A null counts as a value of its own."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("table_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).alias("null_keys"),
    ).select(
        F.lit(name).alias("table_name"),
        F.lit(" + ".join(keys)).alias("key_columns"),
        "table_rows",
        "distinct_keys",
        "duplicates",
        "null_keys",
        (F.col("duplicates") == 0).alias("is_unique"),
    )


def by_key_sets(df: DataFrame, sets: Sequence[Sequence[str]]) -> tuple[DataFrame, list[int]]:
    """Rows per value of every key set, from one scan: (columns of all sets, _set, _n), and each set's number.

    One shuffle carries the groups of all sets, combined on the map side, so a value that most rows
    share is one row a task. Columns that are not of a row's set are null there.
    """
    columns = list(dict.fromkeys(c for keys in sets for c in keys))
    numbers = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys) for keys in sets]
    wanted = list(dict.fromkeys(tuple(c for c in columns if c in keys) for keys in sets))
    if len(wanted) == 1:  # a single set needs no expansion of rows
        grouped = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_set", F.lit(numbers[0]).cast("long"))
    else:
        grouped = df.select(*columns).groupingSets([list(k) for k in wanted], *columns).agg(
            F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set")
        )
    return grouped.select(*columns, "_set", "_n"), numbers


def _sum_where(condition: Column, value: Column | str = "_n") -> Column:
    return F.coalesce(F.sum(F.when(condition, value if isinstance(value, Column) else F.col(value))), F.lit(0))


def key_profiles(df: DataFrame, sets: Sequence[Sequence[str]], name: str) -> DataFrame:
    """``key_profile`` of several keys of one table, which is read once."""
    groups, numbers = by_key_sets(df, sets)
    rows = []
    for keys, number in zip(sets, numbers, strict=True):
        mine = F.col("_set") == number
        any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
        rows.append(
            F.struct(
                F.lit(" + ".join(keys)).alias("key_columns"),
                _sum_where(mine).alias("table_rows"),
                F.count_if(mine).alias("distinct_keys"),
                _sum_where(mine, F.col("_n") - 1).alias("duplicates"),
                _sum_where(mine & any_null).alias("null_keys"),
            )
        )
    found = groups.agg(F.array(*rows).alias("rows")).select(F.lit(name).alias("table_name"), F.inline("rows"))
    return found.withColumn("is_unique", F.col("duplicates") == 0)


def distinct_count(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct values of each column, nulls not counted; the table is read once."""
    groups, numbers = by_key_sets(df, [[c] for c in columns])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.count_if((F.col("_set") == number) & F.col(c).isNotNull()).alias("distinct_values"))
        for c, number in zip(columns, numbers, strict=True)
    ]
    return groups.agg(F.array(*rows).alias("rows")).select(F.lit(name).alias("table_name"), F.inline("rows"))


Relation = tuple[str, str, DataFrame, str]


def with_parents(groups: DataFrame, numbers: Sequence[int], relations: Sequence[Relation]) -> DataFrame:
    """Groups of key sets with ``_found``: whether the group's value is a key of its relation's parent.

    The keys of all parents are one table next to the number of the set they belong to, so all
    relations of a child are one join. A null value finds a null key. ``relations`` are (label,
    column, parent, key), one per number.
    """
    of = list(zip(numbers, relations, strict=True))
    kind = "long" if all(dict(p.dtypes)[k] in ("int", "bigint") for _, _, p, k in relations) else "string"
    value = F.coalesce(*[F.when(F.col("_set") == n, F.col(c).cast(kind)) for n, (_, c, _, _) in of])
    keys = union_all(
        [
            parent.select(F.lit(n).cast("long").alias("_of"), F.col(k).cast(kind).alias("_key")).distinct()
            for n, (_, _, parent, k) in dict(of).items()
        ]
    ).withColumn("_found", F.lit(True))
    match = (F.col("_set") == F.col("_of")) & F.col("_value").eqNullSafe(F.col("_key"))
    return groups.withColumn("_value", value).join(keys, match, "left").drop("_of", "_key")


def orphan_counts(child: DataFrame, relations: Sequence[Relation]) -> DataFrame:
    """Child rows without a parent, for several relations of one child, which is read once."""
    groups, numbers = by_key_sets(child, [[c] for _, c, _, _ in relations])
    if len(set(numbers)) < len(numbers):  # two relations of one column: each on its own
        return union_all([orphan_count(child, parent, [c], [k], label) for label, c, parent, k in relations])
    matched = with_parents(groups, numbers, relations)
    rows = [
        F.struct(F.lit(label).alias("relation"), _sum_where((F.col("_set") == n) & F.col("_found").isNull()).alias("orphans"))
        for n, (label, _, _, _) in zip(numbers, relations, strict=True)
    ]
    return matched.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def orphans(
    child: DataFrame,
    parent: DataFrame,
    child_keys: Sequence[str],
    parent_keys: Sequence[str],
) -> DataFrame:
    """Child rows without a parent. A null key finds a null key."""
    p = parent.select(*[F.col(k).alias(f"_parent_{i}") for i, k in enumerate(parent_keys)])
    match = reduce(
        Column.__and__,
        [child[k].eqNullSafe(F.col(f"_parent_{i}")) for i, k in enumerate(child_keys)],
    )
    return child.join(p, match, "left_anti")


def orphan_count(
    child: DataFrame,
    parent: DataFrame,
    child_keys: Sequence[str],
    parent_keys: Sequence[str],
    relation: str,
) -> DataFrame:
    """Number of child rows without a parent.

    Rows are counted per key before the join, so a key that holds most of the
    child rows crosses the network as one row per map task.
    """
    per_key = child.groupBy(*child_keys).agg(F.count(F.lit(1)).alias("_n"))
    lost = orphans(per_key, parent, child_keys, parent_keys)
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans")).select(
        F.lit(relation).alias("relation"), "orphans"
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("value"))
    )

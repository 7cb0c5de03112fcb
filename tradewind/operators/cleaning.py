"""Cleaning operators, all parameterised by column names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions import elapsed_days, parse_timestamp, strip_upper, title_case


def parse_timestamps(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: parse_timestamp(F.col(c)) for c in columns})


def delivery_metrics(
    df: DataFrame,
    purchase: str,
    delivered: str,
    estimated: str,
    status: str,
    delivered_status: str = "delivered",
    cancelled_status: str = "canceled",
) -> DataFrame:
    """Day counts and flags of one order.

    A positive delay is late. ``is_late`` stays null without a delivery date: an
    order still under way is neither late nor on time.
    """
    bought, arrived, promised = F.col(purchase), F.col(delivered), F.col(estimated)
    delay = elapsed_days(arrived, promised)
    return df.withColumns(
        {
            "delivery_days": elapsed_days(arrived, bought),
            "estimated_days": elapsed_days(promised, bought),
            "delivery_delay_days": delay,
            "is_delivered": F.col(status).eqNullSafe(F.lit(delivered_status)),
            "is_cancelled": F.col(status).eqNullSafe(F.lit(cancelled_status)),
            "is_late": F.when(arrived.isNotNull(), F.coalesce(delay > 0, F.lit(False))),
        }
    )


def replace_value(df: DataFrame, column: str, old, new) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == old, F.lit(new)).otherwise(F.col(column)))


def fill_missing(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def clean_place(df: DataFrame, city: str, state: str) -> DataFrame:
    return df.withColumns({city: title_case(F.col(city)), state: strip_upper(F.col(state))})


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_column: str,
    tie_columns: Sequence[str],
) -> DataFrame:
    """The row with the latest ``order_column`` of every key; rows without one come last.

    The rank filter is applied on the map side too, so each task sends at most one
    row per key and a key with very many rows stays harmless.
    """
    by_recency = Window.partitionBy(*keys).orderBy(
        F.col(order_column).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie_columns]
    )
    return df.withColumn("_rank", F.row_number().over(by_recency)).filter("_rank = 1").drop("_rank")


def lookup(
    df: DataFrame,
    reference: DataFrame,
    key: str,
    values: Mapping[str, str | None],
) -> DataFrame:
    """Left lookup of ``values`` (column to default) in a reference table.

    The job fails if the reference holds a key twice, because the join would then
    multiply rows. No broadcast is forced: Spark broadcasts the reference when its
    measured size is below the threshold and shuffles otherwise.
    """
    once = F.count(F.lit(1)) == 1
    message = F.concat(F.lit(f"lookup key {key} is not unique: "), F.col(key).cast("string"))
    unique = (
        reference.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            *[
                F.when(once, F.min(v)).otherwise(F.raise_error(message).cast(reference.schema[v].dataType)).alias(v)
                for v in values
            ]
        )
    )
    joined = df.join(unique, key, "left")
    defaults = {v: F.coalesce(F.col(v), F.lit(d)) for v, d in values.items() if d is not None}
    return joined.select(*df.columns, *[defaults.get(v, F.col(v)).alias(v) for v in values])


def collapse_points(
    df: DataFrame,
    key: str,
    mean_columns: Sequence[str],
    mode_columns: Sequence[str],
) -> DataFrame:
    """One row per key: means and most frequent values over the distinct rows.

    Rows without a key are dropped; a tie between values goes to the smallest; a
    key whose values are all null keeps null. Distinct rows are first merged per
    (key, mode columns), and the modes are taken from those few merged rows with
    plain hash aggregates, so no task holds the points of one key.
    """
    distinct = df.select(key, *mean_columns, *mode_columns).filter(F.col(key).isNotNull()).distinct()
    cells = distinct.groupBy(key, *mode_columns).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_sum_{c}") for c in mean_columns],
        *[F.count(c).alias(f"_cnt_{c}") for c in mean_columns],
    )
    result = cells.groupBy(key).agg(
        *[
            F.try_divide(F.sum(f"_sum_{c}"), F.sum(f"_cnt_{c}")).alias(c)
            for c in mean_columns
        ]
    )
    for c in mode_columns:
        result = result.join(_mode(cells, key, c, "_n"), key, "left")
    return result.select(key, *mean_columns, *mode_columns)


def _mode(df: DataFrame, key: str, column: str, weight: str) -> DataFrame:
    counts = (
        df.filter(F.col(column).isNotNull()).groupBy(key, column).agg((-F.sum(weight)).alias("_rank"))
    )
    best: Column = F.min(F.struct("_rank", column))
    return counts.groupBy(key).agg(best[column].alias(column))

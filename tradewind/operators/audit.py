"""Audit of the cleaning rules: what every rule saw, kept and changed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def audit(
    after: DataFrame,
    entity: str,
    changes: Mapping[str, Column],
    rows_before: DataFrame | None = None,
) -> DataFrame:
    """Rows per rule: entity, rule, rows before and after, rows changed.

    ``changes`` holds one row condition per rule, all counted in one pass over
    ``after``. ``rows_before`` is a one-row frame with a ``rows_before`` column for
    rules that remove rows; without it no rows are removed.
    """
    totals = after.agg(
        F.count(F.lit(1)).alias("rows_after"),
        *[F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(changes.values())],
    )
    if rows_before is None:
        totals = totals.withColumn("rows_before", F.col("rows_after"))
    else:
        # Both sides are single-row aggregates.
        totals = totals.withColumn("rows_before", rows_before.select("rows_before").scalar())
    per_rule = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.col(f"c{i}").alias("rows_changed"))
            for i, rule in enumerate(changes)
        ]
    )
    return totals.select("rows_before", "rows_after", F.inline(per_rule)).select(
        F.lit(entity).alias("entity"), "rule", "rows_before", "rows_after", "rows_changed"
    )


def row_count(df: DataFrame, alias: str = "rows_before") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def decision_log(audit_rows: DataFrame) -> DataFrame:
    """One readable line per audited rule."""
    lost = F.col("rows_before") - F.col("rows_after")
    effect = F.when(
        lost > 0,
        F.format_string("%,d rows reduced to %,d", F.col("rows_before"), F.col("rows_after")),
    ).otherwise(F.format_string("%,d of %,d rows", F.col("rows_changed"), F.col("rows_after")))
    return audit_rows.select(
        "entity", "rule", F.concat_ws(": ", F.col("entity"), F.col("rule"), effect).alias("message")
    )

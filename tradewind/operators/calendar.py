"""Calendar table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import date_key


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included; weeks start on Monday."""
    span = spark.range(1).select(F.sequence(F.lit(start), F.lit(end)).alias("days"))
    return describe_days(span.select(F.explode("days").alias("full_date")))


def calendar_for(df: DataFrame, column: str) -> DataFrame:
    """Calendar of the whole years that a date column touches."""
    bounds = df.agg(
        F.make_date(F.year(F.min(column)), F.lit(1), F.lit(1)).alias("first"),
        F.make_date(F.year(F.max(column)), F.lit(12), F.lit(31)).alias("last"),
    )
    return describe_days(bounds.select(F.explode(F.sequence("first", "last")).alias("full_date")))


def describe_days(days: DataFrame) -> DataFrame:
    d = F.col("full_date")
    weekday = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_label"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
    )

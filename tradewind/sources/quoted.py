"""Delimited text whose quoted fields hold line breaks, read by many tasks a file.

A line break ends a record exactly where the quotes before it are even in number, as a quote within
a field is doubled. Lines are therefore read from byte ranges as they come, ranges learn from the
quotes of those before them whether they begin inside a field, and only then are records put together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.sources.schemas import MISSING_TOKENS

RANGE = ("file", "range_start")


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, range_start, at, line): ``at`` ascends with the place in the range."""
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range_start"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )


def _quotes() -> Column:
    return F.length("line") - F.length(F.replace("line", F.lit('"')))


def _opens_inside(lines: DataFrame) -> DataFrame:
    """For every range, whether it begins within quotes; a file whose quotes are odd in number fails the read."""
    totals = lines.groupBy(*RANGE).agg(F.sum(_quotes()).alias("quotes"))
    # One row a range: a window over those of one file is small.
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("range_start")) - F.col("quotes")
    all_of_file = F.sum("quotes").over(Window.partitionBy("file"))
    odd = F.raise_error(F.concat(F.lit("a quoted field does not end in "), F.col("file"))).cast("boolean")
    inside = F.when(all_of_file % 2 != 0, odd).otherwise(before % 2 != 0)
    return totals.select(*RANGE, inside.alias("inside"))


def quoted_records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, first, record): the text of every record, and whether it is the first of its file.

    Lines are sorted within their range, which Spark's split size bounds; records of one line, most
    of them, go on as they are, and only those of several lines meet in a further shuffle, at most
    one record a group. Blank lines between records are none.
    """
    lines = _lines(spark, path)
    in_range = Window.partitionBy(*RANGE).orderBy("at")
    before = F.sum(_quotes()).over(in_range) - _quotes() + F.col("inside").cast("int")
    known = lines.join(_opens_inside(lines), list(RANGE)).withColumn("before", before)
    starts = known.withColumn("starts", (F.col("before") % 2 == 0).cast("int"))
    whole = starts.withColumns(
        {"number": F.sum("starts").over(in_range), "alone": (F.col("starts") == 1) & (_quotes() % 2 == 0)}
    )
    alone = whole.filter("alone").select(*RANGE, "number", F.col("line").alias("record"))

    # Lines before the first start of a range belong to the last record that starts in an earlier one.
    counts = whole.groupBy(*RANGE).agg(F.sum("starts").alias("n"))
    last = F.when(F.col("n") > 0, F.struct(F.col("range_start").alias("begun"), F.col("n").alias("number")))
    earlier = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    owners = counts.select(*RANGE, F.last(last, ignorenulls=True).over(earlier).alias("owner"))
    parts = whole.filter("not alone").join(owners, list(RANGE)).select(
        "file",
        F.when(F.col("number") > 0, F.col("range_start")).otherwise(F.col("owner.begun")).alias("begun"),
        F.when(F.col("number") > 0, F.col("number")).otherwise(F.col("owner.number")).alias("number"),
        F.struct("range_start", "at", "line").alias("part"),
    )
    joined = parts.groupBy("file", "begun", "number").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    several = joined.select(
        "file", F.col("begun").alias("range_start"), "number", F.array_join(F.col("parts.line"), "\n").alias("record")
    )
    records = alone.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))
    first = (F.col("range_start") == 0) & (F.col("number") == 1)
    return records.filter((F.col("record") != "") | first).select("file", first.alias("first"), "record")


def read_quoted_csv(
    spark: SparkSession, path: str | Sequence[str], ddl: str, missing: Sequence[str] = MISSING_TOKENS
) -> DataFrame:
    """What ``read_csv`` gives with ``multi_line``, from many tasks a file; the order of rows is not kept.

    As there, a header that differs from the declared columns fails the read, and so does a row with
    a wrong number of fields or a quoted field that never ends. Nothing is dropped silently.
    """
    records = quoted_records(spark, path)
    row = F.from_csv("record", F.lit(ddl), {"escape": '"', "mode": "FAILFAST", "multiLine": "true"})
    parsed = records.select("first", "record", row.alias("row"))
    names = [c.split()[0] for c in ddl.split(", ")]
    header = F.array(*[F.lower(F.col(f"row.`{n}`")) for n in names])
    wanted = F.array(*[F.lit(n.lower()) for n in names])
    other = F.concat(F.lit("the header is not that of the declared columns: "), F.col("record"))
    plain = F.regexp_replace(F.element_at(header, 1), "^﻿", "")
    same = F.concat(F.array(plain), F.slice(header, 2, max(1, len(names) - 1))) == wanted if len(names) > 1 else F.array(plain) == wanted
    is_header = F.when(~F.col("first"), F.lit(False)).when(same, F.lit(True)).otherwise(F.raise_error(other).cast("boolean"))
    rows = parsed.filter(~is_header).select("row.*")
    if not missing:
        return rows
    return rows.select(*[F.when(~F.col(c).isin(list(missing)), F.col(c)).alias(c) for c in rows.columns])

"""Dense integer keys and global tiles without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_dense_key(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of a stored Parquet table 1..N, in no particular order.

    ``df`` must be a direct scan of the table. The key of a row is the number of
    rows in the files before its own plus its position in the file: counting needs
    the file footers only, and no row is shuffled or sorted. Stored files do not
    change, so a repeated task gives the same keys. The window runs over one row
    per file, and so does the broadcast of two 64-bit numbers a file: a million
    files are 16 MB. Two paths of one hash fail the job.
    """
    columns = df.columns
    path = F.xxhash64(F.col("_metadata.file_path"))
    tagged = df.select(*columns, path.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = df.select(path.alias("_file"), F.col("_metadata.file_path").alias("_path")).groupBy("_path", "_file").count()
    before = Window.orderBy("_file", "_path").rowsBetween(Window.unboundedPreceding, -1)
    clash = F.lag("_file").over(Window.orderBy("_file", "_path")) == F.col("_file")
    first = F.coalesce(F.sum("count").over(before), F.lit(0))
    offsets = counts.select(
        "_file",
        F.when(clash, F.raise_error(F.concat(F.lit("two files have one hash: "), "_path")).cast("long"))
        .otherwise(first)
        .alias("_before"),
    )
    numbered = tagged.join(F.broadcast(offsets), "_file")
    return numbered.select((F.col("_before") + F.col("_row") + 1).alias(name), *columns)


def tile_summary(df: DataFrame, value: str, tiles: int) -> DataFrame:
    """Split rows into ``tiles`` equal groups by descending ``value`` and sum each up.

    Same groups as ``ntile(tiles)`` over a global order: sizes differ by at most
    one, larger groups first. Gives tile, rows, min, max and total of the value, and
    the rows that have one. Rows without a value rank last, as in a descending order.

    Rows of equal value are interchangeable here, so the work is done on a
    histogram of the distinct values: however many rows share one value, they are
    one row after the partial aggregate. Distinct values fall into a bounded
    number of ordered buckets (a pure function of the value, so every branch and
    every retry agrees); ranks come from a running count inside each bucket plus
    the rows in the buckets above.
    """
    bucket = _magnitude_bucket(F.col(value), df.schema[value].dataType.scale)
    histogram = (
        df.groupBy(value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", F.coalesce(bucket, F.lit(-(1 << 62))))
    )
    # One row per bucket, at most 9000 for each number of digits and sign, with where the bucket
    # starts in the whole order and how the whole splits into tiles.
    above = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_size").over(Window.partitionBy())
    buckets = (
        histogram.groupBy("_bucket")
        .agg(F.sum("_n").alias("_size"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_size").over(above), F.lit(0)).alias("_above"),
            F.floor(total / tiles).cast("long").alias("_small"),
            (total % tiles).alias("_larger"),
        )
        .withColumn("_cut", F.col("_larger") * (F.col("_small") + 1))
    )
    inside = Window.partitionBy("_bucket").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    # Every bucket has its totals, so left and inner join agree; the left join adds no filter
    # below the histogram, whose shuffle both branches can then share.
    placed = histogram.join(F.broadcast(buckets), "_bucket", "left").withColumn(
        "_first", F.col("_above") + F.coalesce(F.sum("_n").over(inside), F.lit(0))
    )
    small, larger, cut, first = (F.col(c) for c in ("_small", "_larger", "_cut", "_first"))
    end = first + F.col("_n")

    def tile_of(position: Column) -> Column:
        return F.when(position < cut, F.floor(position / (small + 1))).otherwise(
            larger + F.floor((position - cut) / small)
        )

    spans = placed.withColumn("_tile", F.explode(F.sequence(tile_of(first), tile_of(end - 1))))
    tile = F.col("_tile")
    tile_start = tile * small + F.least(tile, larger)
    tile_end = (tile + 1) * small + F.least(tile + 1, larger)
    parts = spans.withColumn("_rows", F.least(end, tile_end) - F.greatest(first, tile_start))
    return parts.groupBy((tile + 1).alias("tile")).agg(
        F.sum("_rows").alias("n"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.sum(F.col(value) * F.col("_rows").cast("decimal(18,0)")).cast("decimal(22,2)").alias("total"),
        F.sum(F.when(F.col(value).isNotNull(), F.col("_rows")).otherwise(0)).alias("n_valued"),
    )


def _magnitude_bucket(value: Column, scale: int) -> Column:
    """Order-preserving bucket of a decimal: how many digits it has and the leading four."""
    units = (value * F.lit(10**scale).cast("decimal(20,0)")).cast("long")
    digits = F.abs(units).cast("string")
    level = F.length(digits) * 10000 + F.substring(F.rpad(digits, 4, "0"), 1, 4).cast("int")
    return (F.signum(units) * level).cast("long")

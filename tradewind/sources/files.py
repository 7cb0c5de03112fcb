"""Readers and writers: delimited text in, typed Parquet tables out."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.session import writing
from tradewind.sources.quoted import read_quoted_csv
from tradewind.sources.schemas import FREE_TEXT_ENTITIES, MISSING_TOKENS, RAW_COLUMNS, raw_ddl


# Of tables that are large beside all others; 37 to 75 % of the size of Spark's default. Small tables
# keep that: Spark tells by the size of the files whether a table can be broadcast.
CODEC = "zstd"

# Rows that a bucket is made for, and rows over which a bucket is too much for one task.
BUCKET_ROWS, MOST_BUCKET_ROWS = 500_000, 2_000_000


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    ddl: str,
    multi_line: bool = False,
    missing: Sequence[str] = MISSING_TOKENS,
) -> DataFrame:
    """Delimited text with a header row, every column as text, missing values as null.

    The header must match the declared columns and a row with a wrong number of
    fields fails the read: nothing is dropped silently. ``multi_line`` reads line breaks
    in fields, a file in one task; ``read_quoted_csv`` does so in many.
    """
    df = (
        spark.read.schema(ddl)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path if isinstance(path, str) else list(path))
    )
    if not missing:
        return df
    return df.select(*[F.when(~F.col(c).isin(list(missing)), F.col(c)).alias(c) for c in df.columns])


def read_entity(spark: SparkSession, path: str | Sequence[str], entity: str) -> DataFrame:
    """The raw entity as text; free text may hold line breaks, and its files are split all the same."""
    if entity in FREE_TEXT_ENTITIES:
        return read_quoted_csv(spark, path, raw_ddl(entity))
    return read_csv(spark, path, raw_ddl(entity))


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """File names and sizes below a folder, in name order; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length")
        .orderBy("path")
    )


def scan_catalog(
    spark: SparkSession,
    folder: str,
    names: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """One lazy DataFrame per entity, in name order.

    ``names`` maps an entity to its file or folder below ``folder``; the default is
    ``<entity>.csv``, which may be one file or a folder of part files.
    """
    names = names or {entity: f"{entity}.csv" for entity in RAW_COLUMNS}
    return {e: read_entity(spark, f"{folder.rstrip('/')}/{names[e]}", e) for e in sorted(names)}


def write_csv(df: DataFrame, path: str) -> None:
    """Delimited text with a header; quotes are doubled, missing values are empty."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def to_typed(df: DataFrame, types: Mapping[str, str], on_error: str = "null") -> DataFrame:
    """Declared columns in declared order, each with its declared type.

    ``on_error`` decides what a value that does not fit does: ``null`` drops the
    value, ``fail`` fails the job.
    """
    if on_error not in ("null", "fail"):
        raise ValueError(f"on_error must be 'null' or 'fail', not {on_error!r}")

    def typed(name: str, type_name: str):
        value = F.col(name)
        converted = value.try_cast(type_name)
        if on_error == "fail":
            message = F.concat(F.lit(f"{name} is not {type_name}: "), value.cast("string"))
            converted = F.when(value.isNull() | converted.isNotNull(), converted).otherwise(
                F.raise_error(message).cast(type_name)
            )
        return converted.alias(name)

    return df.select(*[typed(n, t) for n, t in types.items()])


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    sort_by: Sequence[str] = (),
    codec: str | None = None,
) -> DataFrame:
    """Write a Parquet table, replacing what was there, and return a scan of it.

    A partitioned table is rebalanced on the partition column first: adaptive
    execution then gives a large month many writers and lets small months share
    one, instead of one writer per month or one small file per task and month.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
        df = df.sortWithinPartitions(partition_by, *sort_by)
    writer = df.write.mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with writing(df.sparkSession):
        writer.parquet(path)
    return read_table(df.sparkSession, path, df)


def read_table(
    spark: SparkSession, path: str, like: DataFrame | None = None, text_partition: str | None = None
) -> DataFrame:
    """A stored table with the columns of ``like``, or as found; a ``text_partition`` of digits stays text."""
    if like is not None:
        return spark.read.schema(like.schema).parquet(path)
    found = spark.read.parquet(path)
    if text_partition is None:
        return found
    fields = [T.StructField(f.name, T.StringType() if f.name == text_partition else f.dataType) for f in found.schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def _bucket_table(path: str, key: str) -> str:
    """Name in the session's catalog for a bucketed table of a folder: only a catalog knows buckets."""
    return f"tradewind_{key}_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(
    df: DataFrame, path: str, key: str, rows: int, rows_a_bucket: int = BUCKET_ROWS, joined: bool = False
) -> DataFrame:
    """Write a Parquet table of about ``rows`` rows in buckets of ``key``, one sorted file each, below ``path``.

    Tables written with the same number of buckets join and group by the key without a shuffle.
    The number is a power of two, so tables of different sizes still fit each other, and part of
    the folder's name, so ``read_bucketed`` finds it again in another session.

    ``joined`` rows come from a shuffle join on the key, whose partitions are made the buckets: they
    are not shuffled once more, and a partition that adaptive execution splits is a bucket of several files.
    """
    spark = df.sparkSession
    buckets = 8
    while buckets * rows_a_bucket < rows and buckets < 1 << 14:
        buckets *= 2
    name = _bucket_table(path, key)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # Spark leaves out this shuffle where the rows already lie in these buckets.
    df = df if joined else df.repartition(buckets, key)
    writer = df.write.format("parquet").mode("overwrite").option("compression", CODEC).bucketBy(buckets, key).sortBy(key)
    with writing(spark, buckets if joined else None):
        writer.option("path", f"{path}/buckets={buckets}").saveAsTable(name)
    return spark.table(name)


def _bucket_folder(spark: SparkSession, path: str) -> str:
    parent = spark._jvm.org.apache.hadoop.fs.Path(path)
    statuses = parent.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(parent)
    return next(s.getPath().toString() for s in statuses if s.getPath().getName().startswith("buckets="))


def read_even(spark: SparkSession, path: str, key: str, most_rows: int = MOST_BUCKET_ROWS) -> DataFrame:
    """A table of ``write_bucketed``, by its buckets only if each is a task's work.

    A key with very many rows makes one bucket large, and a bucket is read by one task. Such a table
    is read as plain files, which are split, and shuffled anew by what joins or groups it. The rows
    of a bucket are counted from the footers.
    """
    files = spark.read.parquet(_bucket_folder(spark, path))
    bucket = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)(?:\..*)?$", 1)
    largest = files.groupBy(bucket.alias("bucket")).count().agg(F.max("count")).first()[0] or 0
    return read_bucketed(spark, path, key) if largest <= most_rows else files


def read_bucketed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A table of ``write_bucketed``, made known to this session's catalog if it is not."""
    name = _bucket_table(path, key)
    if not spark.catalog.tableExists(name):
        folder = _bucket_folder(spark, path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
            f"INTO {int(folder.rsplit('=', 1)[1])} BUCKETS LOCATION '{folder}'"
        )
    return spark.table(name)

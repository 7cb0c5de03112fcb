"""Helpers shared by the corpus operators: folds, packed rows, stored steps, gapless numbers."""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tradewind.session import work_dir

MASK64 = (1 << 64) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; a null id counts as empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


class Steps:
    """Tables written in between, below the shared folder, one folder for each call.

    Written tables cut the lineage: a lost executor costs a read, not the steps before.
    ``drop`` removes a table that no later plan reads.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, work_dir(spark)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(base: str, taken: Sequence[str]) -> str:
    """A column name that no column of the input has."""
    lower = {c.lower() for c in taken}
    return base if base not in lower else f"{base}_{uuid.uuid4().hex[:8]}"


def gapless(df: DataFrame, group: str, rows: int, out: str, per_task: int = 20_000) -> DataFrame:
    """Number the rows of every group from 0 without holding a group in one task.

    All columns but ``group`` together order a group. Equal rows are counted first and
    written out again at the end, so a row repeated many times is one row here. A group
    is split by a hash of its rows into parts of about ``per_task`` rows; a running sum
    of the parts' sizes, one row a part, gives each part its first number.
    """
    columns = df.columns
    parts = max(1, -(-rows // per_task))
    part, copies, first, inside = (fresh(n, columns) for n in ("part_", "copies_", "first_", "inside_"))
    distinct = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(copies))
    keys = [c for c in columns if c != group]
    distinct = distinct.withColumn(part, F.pmod(F.xxhash64(*keys), F.lit(parts)))
    order = Window.partitionBy(group, part).orderBy(*[F.col(c).asc_nulls_first() for c in keys])
    placed = distinct.withColumn(inside, F.sum(copies).over(order) - F.col(copies))
    sizes = distinct.groupBy(group, part).agg(F.sum(copies).alias(first))
    before = Window.partitionBy(group).orderBy(part)
    starts = sizes.withColumn(first, F.sum(first).over(before) - F.col(first))
    joined = placed.join(starts, [group, part])
    numbered = joined.select(
        *columns,
        F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)).alias(part),
        (F.col(first) + F.col(inside)).alias(first),
    )
    return numbered.select(*columns, (F.col(first) + F.col(part)).alias(out))


def ordered(df: DataFrame, order: Sequence[Column], out: str, steps: Steps, name: str) -> DataFrame:
    """Number all rows from 0 in an order, stored, without a task that holds them all.

    Rows are sorted by ranges; the sizes of the ranges, one row a task, give each its first
    number. The columns of ``order`` together must be unique, else equal rows share a task.
    """
    at, part, first = (fresh(n, df.columns) for n in ("at_", "part_", "first_"))
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = steps.keep(sorted_rows.withColumn(at, F.monotonically_increasing_id()), name)
    stored = stored.withColumn(part, F.shiftright(at, 33))
    sizes = stored.groupBy(part).agg(F.count(F.lit(1)).alias(first))
    starts = sizes.withColumn(first, F.sum(first).over(Window.orderBy(part)) - F.col(first))
    placed = stored.join(F.broadcast(starts), part)
    return placed.select(*df.columns, (F.col(first) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))).alias(out))


def some_rows(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``limit`` bytes in a column, a longer one alone."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // limit
        borders = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
        for low, high in zip(borders, [*borders[1:], batch.num_rows], strict=True):
            yield batch.slice(low, high - low)


def numbered_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words between white space with A-Z lower-cased, and the word and the text of every occurrence."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    numbered = split.flatten().dictionary_encode()
    words, word = numbered.dictionary.cast(pa.binary()), numbered.indices.to_numpy()
    text = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    empty = pc.index(words, pa.scalar(b"", pa.binary())).as_py()
    if empty >= 0:  # what white space at the ends leaves
        kept = word != empty
        word, text = word[kept], text[kept]
    return words, word, text


def append_columns(
    df: DataFrame, text_col: str, make: Callable[[Iterator[list]], Iterator[list]], ddl: dict[str, str]
) -> DataFrame:
    """All columns of ``df`` and further ones made from the bytes of a text column, batch by batch.

    ``make`` gets an iterator of lists of texts (bytes or None) and gives, for each list, one
    list or array per new column. The names in ``ddl`` must be new.
    """
    raw = fresh("text_bytes_", df.columns)
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in ddl.items())).fields])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: deque = deque()

        def texts() -> Iterator[list]:
            for batch in batches:
                held.append(batch)
                yield batch.column(raw).to_pylist()

        for made in make(texts()):
            batch = held.popleft()
            columns = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != raw]
            arrays = [pa.array(v, to_arrow_type(schema[n].dataType)) for n, v in zip(ddl, made, strict=True)]
            yield pa.RecordBatch.from_arrays(columns + arrays, names=schema.names)

    return df.withColumn(raw, F.col(text_col).cast("binary")).mapInArrow(apply, schema)


def sample_share(rows: int, wanted: int) -> float:
    return min(1.0, wanted / max(1, rows))


def chosen(key: Column, share: float, seed: int) -> Column:
    """A fixed share of the keys, by hash: the same rows on every run and every retry."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))

"""Items are joined once, by order; what a table was shuffled by does not stay on disk."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.plans import star
from tradewind.sources import files


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_lines_and_fact_are_made_of_items_that_lie_by_order(spark, small, no_broadcast):
    """Neither meets products or orders again; only the fact's months are dealt anew."""
    small.order_lines  # noqa: B018
    items = files.read_even(spark, f"{small.model_root}/order_items", "order_id")
    lines = star.build_order_lines(items, small.dim_product)
    assert "Exchange" not in _plan(lines) and "Bucketed: true" in _plan(lines)
    assert "Join" not in _plan(lines) + _plan(star.build_fact_order_items(small.order_items))
    columns = sorted(lines.columns)
    of_fact = star.build_order_lines(small.fact_order_items, small.dim_product)
    assert rows(lines, *columns) == rows(of_fact, *columns) == rows(small.order_lines, *columns)
    assert len(small.order_items.inputFiles()) == 8  # one file a bucket, without a shuffle after the join
    assert lines.dtypes == small.order_lines.dtypes


def test_a_bucket_too_large_for_a_task_is_read_in_parts(spark, tmp_path):
    """An order with a third of the items is dealt by all keys, as plain files are."""
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") / 4).cast("int").cast("string"))
    items = spark.range(6000).select(
        hot.alias("order_id"),
        (F.col("id") % 7).alias("product_key"),
        (F.col("id") % 5).alias("seller_key"),
        (F.col("id") % 7).cast("string").alias("category"),
        F.lit("1.25").cast("decimal(12,2)").alias("price"),
        F.lit("0.50").cast("decimal(12,2)").alias("freight_value"),
    )
    path = str(tmp_path / "items")
    stored = files.write_bucketed(items.repartition(3), path, "order_id", 6000, joined=True)
    assert len(stored.inputFiles()) > 8  # a bucket of several files, as where adaptive execution splits one
    even = files.read_even(spark, path, "order_id")
    parts = files.read_even(spark, path, "order_id", most_rows=1500)
    lines, split = (star.build_order_lines(df, None) for df in (even, parts))
    assert "Exchange" not in _plan(lines)
    dealt = _plan(split).split("hashpartitioning(")[1].split(")")[0]
    assert "order_id" in dealt and "product_key" in dealt and "seller_key" in dealt
    assert "partial_sum" in _plan(split).split("hashpartitioning(")[1]
    assert rows(lines) == rows(split) and lines.filter("order_id = 'hot'").count() == 35
    assert split.agg(F.sum("items"), F.sum("price")).first() == (6000, 7500)


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = []
    while found.hasNext():
        names.append(found.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


@pytest.mark.parametrize("bucketed", [False, True])
def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path, bucketed):
    df = spark.range(20_000).select("id", (F.col("id") % 3).alias("month"))
    before = _shuffle_files(spark)
    if bucketed:
        stored = files.write_bucketed(df, str(tmp_path / "t"), "id", 20_000)
    else:
        stored = files.write_table(df, str(tmp_path / "t"), "month", ["id"])
    for _ in range(100):  # they are removed in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert stored.count() == 20_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_only_tables_by_order_are_packed(small):
    """Dimensions stay as large as Spark expects of rows that it may broadcast."""
    small.order_outcomes  # noqa: B018
    for table in (small.staged("order_items"), small.fact_order_items, small.order_items, small.order_outcomes):
        assert all(".zstd." in f for f in table.inputFiles())
    for table in (small.dim_product, small.dim_seller, small.dim_customer):
        assert not any(".zstd." in f for f in table.inputFiles())

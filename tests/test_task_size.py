"""Tables are built in tasks of a bounded size."""

from pyspark.sql import functions as F

from tradewind.session import small_tasks
from tradewind.sources import files

MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_settings_hold_for_the_action_only(spark):
    before = spark.conf.get(MERGED), spark.conf.get(INITIAL, None)
    with small_tasks(spark, task_bytes=1 << 20, partitions=300):
        assert (spark.conf.get(MERGED), spark.conf.get(INITIAL)) == (str(1 << 20), "300")
    assert (spark.conf.get(MERGED), spark.conf.get(INITIAL, None)) == before
    spark.conf.set(MERGED, "64k")  # a session that asks for less keeps it
    try:
        with small_tasks(spark):
            assert spark.conf.get(MERGED) == str(64 << 10)
        assert spark.conf.get(MERGED) == "64k"
    finally:
        spark.conf.set(MERGED, before[0])


def test_a_table_is_shuffled_into_enough_partitions(spark, tmp_path):
    # The session begins with 4 partitions; without settings of its own the writer would have 4 tasks.
    rows = spark.range(60_000).select(F.col("id"), F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"))
    before = spark.conf.get(MERGED)
    spark.conf.set(MERGED, "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
    try:
        joined = rows.join(rows.select(F.col("id"), F.lit(1).alias("one")).hint("merge"), "id")
        files.write_table(joined, str(tmp_path / "t"))
    finally:
        spark.conf.set(MERGED, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 60_000 and len(stored.inputFiles()) > 4


def test_scans_are_as_small_as_packed_files_need(spark):
    # A shuffle of over 200 partitions sorts what a task scanned in memory, and spills above the task's share.
    with small_tasks(spark):
        assert int(spark.conf.get("spark.sql.files.maxPartitionBytes")) <= 8 << 20

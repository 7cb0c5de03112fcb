"""Session defaults and the shared folder for tables derived during a run."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "tradewind",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Session with the settings the library is tested under.

    ``shuffle_partitions`` is the starting point only: adaptive execution merges
    small partitions and splits skewed ones, so on a cluster set it high (two to
    three times the cores) rather than exact.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.timestampType", "TIMESTAMP_NTZ")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared folder of the cluster.

    ``spark.checkpoint.dir`` names that folder. A machine-local folder is only
    taken in local mode, where every task sees it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder every executor can reach; "
                "derived tables are written below it"
            )
        base = tempfile.mkdtemp(prefix="tradewind-")
    return f"{base.rstrip('/')}/tradewind-{uuid.uuid4().hex}"


# Bytes of shuffled rows that a task takes, and of a file that it scans, while tables are built. As
# rows in memory they are about five times that, and twenty times of a file, which is packed tighter: a core's
# share of a small executor holds them, also where a shuffle of over 200 partitions sorts what is scanned.
TASK_BYTES, SCAN_BYTES = 32 << 20, 8 << 20


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, object]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def small_tasks(spark: SparkSession, task_bytes: int = TASK_BYTES, partitions: int = 200) -> Iterator[None]:
    """Settings for actions that shuffle or sort whole tables: tasks small enough that none spills.

    Adaptive execution merges shuffled partitions up to a size whatever a task's memory is, so tasks
    of large tables spill what tasks of small ones hold. Here partitions begin as many enough and are
    merged less. Settings of the session that ask for smaller tasks hold; all are as before afterwards.
    """
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    merged, scanned = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    settings = {
        merged: min(task_bytes, as_bytes(spark.conf.get(merged))),
        scanned: min(SCAN_BYTES, as_bytes(spark.conf.get(scanned))),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions"))),
    }
    with _settings(spark, settings):
        yield


@contextmanager
def writing(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings for writing a table: small tasks, and its shuffle files go when it is written.

    Else Spark keeps them until the driver happens to collect its garbage, and the shuffles of all
    tables of a build lie on disk together. Shuffles begin with exactly ``partitions`` if given, for
    tables in the buckets of a join; their tasks sort what they join once more, and so take half as much.
    """
    settings: dict[str, object] = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if partitions:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = partitions
        settings["spark.sql.shuffle.partitions"] = partitions
    with small_tasks(spark, TASK_BYTES // 2 if partitions else TASK_BYTES), _settings(spark, settings):
        yield

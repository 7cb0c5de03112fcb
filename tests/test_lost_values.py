"""Values that do not fit their type, repeated lookup keys, and keys above the broadcast threshold."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tradewind.operators import ledger
from tradewind.operators.keys import with_dense_key
from tradewind.plans import prepare, star
from tradewind.sources.schemas import RAW_COLUMNS, REQUIRED_RAW, ROW_KEYS, raw_ddl, raw_types


def test_unfit_values_are_counted(frame, small):
    bad = small.raw("order_items").withColumn("price", F.when(F.col("order_item_id") == 1, "12,50").otherwise(F.col("price")))
    raw = lambda e: bad if e == "order_items" else small.raw(e)
    expected = bad.filter("price = '12,50'").count()
    lost = prepare.lost_values(prepare.cleaning_audit(raw, small.staged)).collect()
    assert [(r.entity, r.rule, r.rows_changed) for r in lost] == [("order_items", prepare.UNFIT, expected)]


def _lost(raw, entity):
    cells = ledger.lost_cells(raw, entity, raw_types(entity), REQUIRED_RAW[entity], ROW_KEYS[entity])
    return rows(cells, "column_name", "reason", "value", "stops", "row_key")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_the_ledger_has_every_lost_cell(spark, frame, ansi):
    kept = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        ddl = ", ".join(f"{c} string" for c in RAW_COLUMNS["geolocation"])
        points = frame(ddl, [("1", "-23,5", "2.5", "c", "s"), (None, "1", "x", "c", "s"), ("10x2", "1", None, "", "s"), ("7", "1", "2", "c", "s")])
        assert _lost(points, "geolocation") == sorted(
            [
                ("geolocation_lat", "not double", "-23,5", True, key("1", "-23,5", "2.5")),
                ("geolocation_lng", "not double", "x", True, key(None, "1", "x")),
                ("geolocation_zip_code_prefix", "missing", None, True, key(None, "1", "x")),
                ("geolocation_zip_code_prefix", "not int", "10x2", True, key("10x2", "1", None)),
            ],
            key=lambda t: tuple((x is None, str(x)) for x in t),
        )
        ddl = ", ".join(f"{c} string" for c in RAW_COLUMNS["orders"])
        day = "2017-01-02 03:04:05"
        orders = frame(
            ddl,
            [("a", "c", "s", day, day, "soon", None, day), ("b", "c", "s", "soon", day, None, None, day), ("d", None, "s", None, None, None, None, None)],
        )
        got = {(r[0], r[1], r[3]) for r in _lost(orders, "orders")}
        assert got == {
            ("order_delivered_carrier_date", "not timestamp_ntz", False),  # set to null by a rule of the cleaning
            ("order_purchase_timestamp", "not timestamp_ntz", True),
            ("order_purchase_timestamp", "missing", True),
            ("customer_id", "missing", True),
        }
        assert prepare.lost_values(prepare.cleaning_audit(EMPTY(spark), lambda e: prepare.stage(EMPTY(spark), e))).count() == 0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", kept)


def key(*values):
    return json.dumps(dict(zip(ROW_KEYS["geolocation"], values, strict=True)), separators=(",", ":"))


def EMPTY(spark):
    return lambda e: spark.createDataFrame([], raw_ddl(e))


def test_a_repeated_zip_prefix_fails(frame):
    geo = frame(
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double",
        [(1, 1.0, 2.0), (1, 3.0, 4.0)],
    )
    with pytest.raises(PySparkException, match="not unique"):
        star.locate(frame("zip_code_prefix int", [(1,)]), geo).collect()


def test_dense_keys_do_not_shuffle_a_large_table(spark, tmp_path):
    spark.range(2000).repartition(5).write.parquet(f"{tmp_path}/t")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        keyed = with_dense_key(spark.read.parquet(f"{tmp_path}/t"), "sk")
        assert sorted(r.sk for r in keyed.collect()) == list(range(1, 2001))
        plan = keyed._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan

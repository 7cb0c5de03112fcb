import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from tradewind.plans import pipeline, prepare, reports, star, validate
from tradewind.plans import questions as Q
from tradewind.plans.slicing import slice_fact
from tradewind.plans.warehouse import FACTS, ChecksFailed, Warehouse
from tradewind.sources.files import read_entity, write_csv
from tradewind.sources.schemas import RAW_COLUMNS
from tradewind.sources.versions import Versions
from tradewind.testbed.raw import RawTables


@pytest.fixture(scope="module")
def csv_folder(spark, tmp_path_factory):
    """Raw files holding two purchase months of the test data and what belongs to them."""
    folder = tmp_path_factory.mktemp("raw")
    raw = RawTables(spark, SMALL)
    orders = raw("orders").filter(F.col("order_purchase_timestamp").between("1997-10-01", "1997-12-01"))
    for entity in RAW_COLUMNS:
        df = raw(entity)
        key = next((k for k in ("order_id", "customer_id") if k in df.columns), None)
        if key:
            df = df.join(orders.select(key), key, "left_semi").select(*RAW_COLUMNS[entity])
        write_csv(df, f"{folder}/{entity}.csv")
    return str(folder)


# The test items repeat (order, line) pairs: exactly the checks on that grain say so.
ACCEPTED = ["check_grain", "check_constraints"]


@pytest.fixture(scope="module")
def built(spark, csv_folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return pipeline.run(spark, csv_folder, out, accept=ACCEPTED), out


def test_from_csv_files_to_checked_answers(spark, csv_folder, built):
    wh, out = built
    assert pipeline.failures(spark, wh.root) == ACCEPTED
    violated = spark.read.parquet(f"{wh.root}/reports/check_constraints").filter("not passed")
    assert rows(violated, "table_name", "rule", "columns") == [
        ("fact_order_items", "unique", "order_id + order_item_id")
    ]

    text = read_entity(spark, f"{csv_folder}/order_items.csv", "order_items")
    value = text.agg(F.sum(F.col("price").cast("decimal(12,2)"))).collect()[0][0]
    growth = Q.monthly_growth(wh).collect()
    assert [r.year_month for r in growth] == ["1997-10", "1997-11"]
    assert sum(r.merchandise_value for r in growth) == value
    reconciled = spark.read.parquet(f"{wh.root}/reports/reconciliation")
    status = {r.metric: r.status for r in reconciled.collect()}
    assert len(status) == 12 and set(status.values()) == {"Match", "Expected"}
    assert status["Total reviews"] == "Expected"

    opened = Warehouse.open(spark, out)
    for name in FACTS + star.ORDER_LAYOUT:
        columns = sorted(wh.table(name).columns)
        assert rows(opened.table(name), *columns) == rows(wh.table(name), *columns)
    assert opened.raw("orders").count() == opened.staged("orders").count()
    assert rows(Q.seller_watchlist(opened, 1)) == rows(Q.seller_watchlist(wh, 1))


def _counts_differ(new):
    return [] if validate.row_counts(new).filter("not passed").isEmpty() else ["row counts"]


def test_a_rebuild_replaces_the_model_whole_or_not_at_all(spark, built, monkeypatch):
    wh, out = built
    versions, first = Versions(spark, out), Versions(spark, out).current()
    before = {t: wh.table(t).count() for t in FACTS}
    old_files = wh.fact_payments.inputFiles()

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(star, "build_fact_payments", dies)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.rebuild(wh, out, ACCEPTED)
    assert versions.current() == first and wh.fact_payments.inputFiles() == old_files

    with monkeypatch.context() as patch:  # half of the payments get lost on the way
        whole = star.build_fact_payments
        patch.setattr(star, "build_fact_payments", lambda *a: whole(*a).filter("payment_sequential > 1"))
        with pytest.raises(ChecksFailed, match="row counts"):
            wh.rebuild_model(_counts_differ, versions)
    assert versions.current() == first
    assert {t: Warehouse.open(spark, out).table(t).count() for t in FACTS} == before

    wh.rebuild_model(_counts_differ, versions)
    assert versions.numbers() == [1, 2] and versions.current()["model"] != first["model"]
    assert versions.current()["staging"] == first["staging"]
    assert wh.fact_payments.inputFiles() != old_files
    assert {t: wh.table(t).count() for t in FACTS} == before
    assert {t: Warehouse.open(spark, out).table(t).count() for t in FACTS} == before
    with pytest.raises(Exception, match="(?i)exist"):  # a second writer of one number
        monkeypatch.setattr(versions, "numbers", lambda: [1])
        versions.publish({"model": out})
    monkeypatch.undo()
    assert versions.retire(keep=1) == [] and versions.numbers() == [2]  # its staging is still in use


def test_a_failed_check_stops_the_switch(spark, built, tmp_path):
    """Checks of the run above, judged without the accepted ones: nothing is published."""
    wh, _ = built
    assert pipeline.failures(spark, wh.root) == ACCEPTED
    with pytest.raises(ChecksFailed) as stopped:
        wh.rebuild_model(lambda new: pipeline.failures(spark, wh.root), Versions(spark, str(tmp_path / "other")))
    assert stopped.value.failed == ACCEPTED and Versions(spark, str(tmp_path / "other")).current() is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_run_stops_on_lost_values(spark, csv_folder, tmp_path, ansi):
    folder, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for entity in RAW_COLUMNS:
        df = read_entity(spark, f"{csv_folder}/{entity}.csv", entity)
        if entity == "order_payments":
            df = df.withColumn("payment_installments", F.expr("if(payment_sequential = '2', 'two', payment_installments)"))
        if entity == "orders":
            df = df.withColumn("order_purchase_timestamp", F.expr("if(order_id % 8 = 0, null, order_purchase_timestamp)"))
        write_csv(df, f"{folder}/{entity}.csv")
    kept = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(ChecksFailed, match="order_payments.payment_installments not int") as stopped:
            pipeline.run(spark, folder, out, accept=ACCEPTED)
        assert "orders.order_purchase_timestamp missing" in str(stopped.value)
        assert Versions(spark, out).current() is None
        (home,) = [f.path for f in os.scandir(f"{out}/versions")]
        counted = spark.read.parquet(f"{home}/reports/cleaning_audit").filter("rows_changed > 0")
        second = read_entity(spark, f"{folder}/order_payments.csv", "order_payments").filter("payment_sequential = '2'").count()
        assert (second,) in rows(counted.filter(F.col("rule") == prepare.UNFIT), "rows_changed")
        wh = Warehouse(spark, lambda e: read_entity(spark, f"{folder}/{e}.csv", e), f"{tmp_path}/lenient")
        assert wh.staged("order_payments").filter("payment_installments is null").count() == second
        assert wh.ledger.filter("entity = 'order_payments'").count() == second
    finally:
        spark.conf.set("spark.sql.ansi.enabled", kept)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_order_questions_move_no_fact_rows(spark, small):
    """Lines and outcomes meet in their buckets: the only shuffles are of sums by category or seller."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = Q.order_lines(small).groupBy("order_id", "category").agg(F.sum("price").alias("value"))
        for df in (
            lines.join(Q.order_outcomes(small), "order_id"),
            reports.propagate(Q.order_lines(small), ["category"], Q.order_outcomes(small)),
            Q.order_lines(small).join(Q.order_outcomes(small), "order_id"),
        ):
            assert "Exchange" not in _plan(df) and "Bucketed: true" in _plan(df)
        for df in (Q.at_risk_categories(small), reports.scores_by_category(small), Q.seller_watchlist(small)):
            assert "hashpartitioning(order_id" not in _plan(df)
        assert "Exchange" not in _plan(Q.order_outcomes(small).filter("is_late"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_an_order_with_a_third_of_the_items_is_split(spark, small):
    """Its items are dealt by order, product and seller before they become lines."""
    items = small.fact_order_items.withColumn("order_id", F.when(F.rand(1) < 0.34, F.lit("hot")).otherwise(F.col("order_id")))
    lines = star.build_order_lines(items, small.dim_product)
    plan = _plan(lines)
    assert "hashpartitioning(order_id" in plan and "product_key" in plan.split("hashpartitioning(order_id")[1].split(")")[0]
    assert "partial_sum" in plan.split("hashpartitioning(order_id")[1]
    hot = lines.filter("order_id = 'hot'")
    assert hot.agg(F.sum("items")).first()[0] == items.filter("order_id = 'hot'").count()


def test_facts_are_pruned_by_month(small):
    df = Q.filtered_category_revenue(small, 19971001, 19971231, "NATION_3")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "purchase_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # Customers of other states stay in their files too.
    assert any("PartitionFilters: [isnotnull(state" in line and "NATION_3" in line for line in plan.splitlines())
    items = [line for line in plan.splitlines() if "FileScan" in line and "freight" in line]
    assert not items  # columns the question does not use are not read


def test_a_calendar_filter_prunes_files(small):
    year = slice_fact(small, "fact_order_items", ["category"], {"year": 1997})
    for df in (year, reports.conformed_filter(small, {"quarter_label": "Q1"})["fact_payments"]):
        assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()


def test_views_answer_plain_sql(spark, small):
    small.register_views()
    got = spark.sql(
        """SELECT p.category_name_english AS category, count(DISTINCT i.order_id) AS orders, sum(i.price) AS merchandise_value
        FROM fact_order_items i JOIN dim_customer c ON c.customer_key = i.customer_key
        JOIN dim_product p ON p.product_key = i.product_key
        WHERE i.purchase_date_key BETWEEN 19971001 AND 19971231 AND c.state = 'NATION_3'
        GROUP BY p.category_name_english"""
    )
    assert rows(got) == rows(Q.filtered_category_revenue(small, 19971001, 19971231, "NATION_3"))


def test_no_cross_joins(small):
    for question in (Q.at_risk_categories, Q.seller_watchlist, Q.spend_quartiles, Q.repeat_customers):
        plan = question(small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_every_fact_carries_the_conformed_keys(small):
    for fact in FACTS:
        assert {"customer_key", "purchase_date_key", star.MONTH_PARTITION} <= set(small.table(fact).columns)

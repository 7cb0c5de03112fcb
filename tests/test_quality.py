import json
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from tradewind.operators import profiling as P
from tradewind.operators import quality as Q
from tradewind.operators import reconcile as R
from tradewind.plans import star, validate
from tradewind.testbed.readvolume import by_group


def test_counts_and_sums(frame):
    a = frame("v decimal(12,2)", [(Decimal("1.10"),), (Decimal("2.20"),)])
    lost = a.limit(1)
    assert rows(Q.compare_counts({"same": (a, a), "lost": (a, lost), "doubled": (a, a.union(a))})) == [
        ("doubled", 2, 4, 2, False),
        ("lost", 2, 1, -1, False),
        ("same", 2, 2, 0, True),
    ]
    b = frame("v decimal(12,2)", [(Decimal("1.10"),)])
    got = rows(Q.compare_sums({("v",): (a, b)}))
    assert got == [("v", Decimal("3.30"), Decimal("1.10"), Decimal("-2.20"), False)]
    assert rows(Q.with_total(Q.row_counts({"a": a, "b": b}))) == [("TOTAL", 3), ("a", 2), ("b", 1)]


def test_grain_and_identity(frame):
    df = frame("o string, i int, p string", [("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", None, "x"), ("b", None, None)])
    assert rows(Q.check_grain({"t": (df, ["o", "i"])})) == [("t", "o + i", 2, False)]
    assert rows(Q.check_identity(df, "o", "p")) == [(5, 2, 3)]


def test_constraints(frame):
    child = frame("id int, fk int", [(1, 10), (1, 11), (None, None), (2, 99)])
    parent = frame("k int", [(10,), (11,)])
    got = rows(Q.check_constraints("t", child, ["id", "fk"], [["id"]], {"fk": (parent, "k")}))
    assert got == [
        ("t", "foreign key", "fk", 1, False),
        ("t", "not null", "fk", 1, False),
        ("t", "not null", "id", 1, False),
        ("t", "unique", "id", 1, False),
    ]


def test_fanout_equals_the_real_join(frame):
    items = frame("o string, price decimal(12,2)", [("a", Decimal(10)), ("a", Decimal(20)), ("a", Decimal(30)), ("b", Decimal(5)), ("c", Decimal(7))])
    pays = frame("o string", [("a",), ("a",), ("b",)])
    joined = items.join(pays, "o").agg(F.sum("price")).collect()[0][0]
    got = {r.method: r for r in Q.fanout(items, pays, "o", "price").collect()}
    wrong, right = got["joined to payments"], got["own grain"]
    assert wrong.value == joined == Decimal("125.00")
    assert (right.value, wrong.phantom, wrong.phantom_pct, right.phantom) == (Decimal(72), Decimal(53), Decimal("73.61"), 0)


def test_reconcile_statuses(frame):
    def stage(**values):
        return frame("metric string, value decimal(22,2)", [(k, Decimal(v)) for k, v in values.items()])

    result = R.reconcile(
        {
            "raw": stage(same="5", explained="10", unexplained="10", broken="10"),
            "cleaned": stage(same="5", explained="9", unexplained="9", broken="9"),
            "model": stage(same="5", explained="9", unexplained="9", broken="8"),
        },
        {"explained": "one was a duplicate", "broken": "does not excuse a later loss"},
    )
    got = {r.metric: (r.status, r.difference, r.explanation) for r in result.collect()}
    assert got == {
        "same": ("Match", 0, None),
        "explained": ("Expected", 1, "one was a duplicate"),
        "unexplained": ("MISMATCH", 1, None),
        "broken": ("MISMATCH", 1, None),
    }
    assert rows(R.overall(result)) == [(4, 1, 1, 2, False)]
    text = R.render_markdown(result)
    assert "| explained | 10 | 9 | 9 | Expected |" in text
    assert "- explained (1): one was a duplicate" in text
    assert "Not reconciled: broken, unexplained" in text
    assert "All metrics reconcile." in R.render_markdown(result.filter("metric = 'same'"))


def _scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_all_rules_of_a_table_are_checked_in_one_scan(spark, small):
    fact = "fact_order_items"
    parents = {"purchase_date_key": (small.dim_date, "date_key")}
    parents |= {k: (small.table(t), k) for t, (k, _) in star.DIMENSION_KEYS.items()}
    checked = Q.check_constraints(fact, small.table(fact), validate.REQUIRED[fact], validate.UNIQUE[fact], parents)
    assert _scans(checked) == 1 + len(parents)  # the fact once, each parent once
    assert {r.rule for r in checked.collect()} == {"not null", "unique", "foreign key"}


def test_rules_of_one_table_count_alike_together_and_alone(frame):
    parent = frame("k int", [(1,), (2,)])
    other = frame("k long", [(7,)])
    child = frame(
        "id int, a int, b int, note string",
        [(1, 1, 7, "x"), (1, 1, 8, None), (2, 3, 7, "y"), (None, None, None, None), (None, 3, 7, "z")],
    )
    got = rows(Q.check_constraints("t", child, ["id", "note"], [["id"], ["a", "b"]], {"a": (parent, "k"), "b": (other, "k")}))
    assert got == sorted(
        [
            ("t", "not null", "id", 2, False),
            ("t", "not null", "note", 2, False),
            ("t", "unique", "id", 2, False),
            ("t", "unique", "a + b", 1, False),
            ("t", "foreign key", "a", 2, False),
            ("t", "foreign key", "b", 1, False),
        ],
        key=lambda t: tuple((x is None, str(x)) for x in t),
    )
    empty = child.limit(0)
    assert all(r.violations == 0 and r.passed for r in Q.check_constraints("t", empty, ["id"], [["id"]], {"a": (parent, "k")}).collect())


def test_several_keys_of_a_table_in_one_scan(spark, small):
    reviews = small.staged("order_reviews")
    both = P.key_profiles(reviews, [["review_id"], ["order_id"], ["order_id", "review_score"]], "r")
    assert _scans(both) == 1
    alone = [P.key_profile(reviews, k, "r") for k in (["review_id"], ["order_id"], ["order_id", "review_score"])]
    assert rows(both) == rows(P.union_all(alone))
    assert _scans(P.distinct_count(reviews, ["order_id", "review_score"], "r")) == 1
    relations = [("o", "order_id", small.staged("orders"), "order_id"), ("i", "review_id", small.staged("order_items"), "order_id")]
    found = P.orphan_counts(reviews, relations)
    assert _scans(found) == 3
    assert rows(found) == rows(P.union_all([P.orphan_count(reviews, p, [c], [k], label) for label, c, p, k in relations]))


def test_read_volume_from_an_event_log(tmp_path):
    def plan(numbers):
        metrics = [{"name": n, "accumulatorId": i} for n, i in zip(("number of files read", "size of files read"), numbers, strict=True)]
        scan = {"nodeName": "Scan parquet ", "metadata": {"Location": "InMemoryFileIndex(1 paths)[file:/x/fact]"}, "metrics": metrics, "children": []}
        return {"nodeName": "Project", "metadata": {}, "metrics": [], "children": [scan]}

    prefix = "org.apache.spark.sql.execution.ui."
    task = {"Input Metrics": {"Bytes Read": 40}, "Executor CPU Time": 2_000_000}
    events = [
        {"Event": f"{prefix}SparkListenerSQLExecutionStart", "executionId": 3, "sparkPlanInfo": plan((7, 8))},
        {"Event": "SparkListenerJobStart", "Stage IDs": [5], "Properties": {"spark.jobGroup.id": "g", "spark.sql.execution.id": "3"}},
        {"Event": f"{prefix}SparkListenerDriverAccumUpdates", "executionId": 3, "accumUpdates": [[7, 2], [8, 90]]},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 5, "Task Metrics": task},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 5, "Task Metrics": task},
        {"Event": "SparkListenerTaskEnd", "Stage ID": 6, "Task Metrics": task},
    ]
    (tmp_path / "local-1").write_text("\n".join(map(json.dumps, events)) + "\n")
    assert by_group(str(tmp_path)) == {"g": {"bytes_read": 80, "cpu_ms": 4.0, "tables": {"fact": {"files": 2, "bytes": 90}}}}

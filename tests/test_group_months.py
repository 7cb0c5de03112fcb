"""Monthly figures by group come from one read of the fact."""

from decimal import Decimal

from tradewind.plans import metrics
from tradewind.plans.slicing import slice_fact


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sums_by_month_and_product_move_the_rows_once(small):
    rows = slice_fact(small, "fact_order_items", ["category", "year_month"], sums=["price"])
    assert "HashAggregate" not in _plan(rows)


def test_group_months_come_from_one_aggregate(small):
    plan = metrics.prev_month(small, by=["category"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_months_by_group_line_up(frame):
    monthly = frame("g string, year_month string, v decimal(22,2)", [("a", "2017-11", Decimal(1)), ("a", "2018-01", Decimal(3)), (None, "2017-12", Decimal(5))])
    got = metrics.prev_month(None, monthly, "v", ["g"]).collect()
    assert {(r.g, r.year_month, r.v, r.prev_month_value) for r in got} == {
        ("a", "2017-11", 1, None), ("a", "2017-12", None, 1), ("a", "2018-01", 3, None),
        (None, "2017-11", None, None), (None, "2017-12", 5, None), (None, "2018-01", None, 5),
    }

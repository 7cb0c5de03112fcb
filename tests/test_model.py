"""Questions, metrics and reports on a hand-made model with the awkward cases."""

from datetime import date, datetime
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.functions import date_key, month_key
from tradewind.operators.calendar import calendar
from tradewind.plans import metrics as M
from tradewind.plans import questions as Q
from tradewind.plans import reports as B
from tradewind.plans.slicing import Between, slice_fact
from tradewind.plans.star import MONTH_PARTITION
from tradewind.sources.files import write_table

D = Decimal

# order, customer key, purchase, status, delivery days, delay, late, delivered key
ORDERS = [
    ("o1", 1, "2017-01-31 23:59:00", "delivered", 5, -12, False, 20170205),
    ("o2", 2, "2017-02-01 00:01:00", "delivered", 9, 0, False, 20170210),
    ("o3", 3, "2017-02-10 12:00:00", "delivered", 30, 8, True, 20170312),
    ("o4", 4, "2017-02-10 18:00:00", "canceled", None, None, None, None),
    ("o5", 5, "2017-05-05 08:00:00", "unavailable", None, None, None, None),
    ("o6", 6, "2018-02-11 09:00:00", "delivered", 4, -3, False, 20180215),
]
# customer key, person, state
CUSTOMERS = [(1, "p1", "SP"), (2, "p1", "SP"), (3, "p2", "RJ"), (4, "p2", "RJ"), (5, "p3", "SP"), (6, "p1", "RJ")]
# order, item, product, seller, price, freight
ITEMS = [
    ("o1", 1, 1, 1, "100.00", "10.00"),
    ("o1", 2, 2, 1, "50.00", "5.00"),
    ("o1", 3, 1, 2, "50.00", "5.00"),
    ("o2", 1, 1, 2, "0.00", "1.00"),
    ("o3", 1, 2, 3, "300.00", "30.00"),
    ("o6", 1, 3, 1, "1000000.00", "0.00"),
]
REVIEWS = [("r1", "o1", 5), ("r2", "o2", 1), ("r3", "o3", 2), ("r5", "o5", 3)]
PAYMENTS = [("o1", 1, "card", 2, "150.00"), ("o1", 2, "voucher", 1, "65.00"), ("o3", 1, "card", 3, "330.00"), ("o5", 1, "card", 1, "10.00")]


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("model")

    def frame(ddl, data):
        return spark.createDataFrame(data, ddl)

    orders = frame(
        "order_id string, customer_key long, t string, order_status string, delivery_days int, delivery_delay_days int, is_late boolean, delivered_date_key int",
        ORDERS,
    ).withColumn("purchase_timestamp", F.col("t").cast("timestamp_ntz"))
    orders = orders.select(
        "*",
        date_key(F.col("purchase_timestamp")).alias("purchase_date_key"),
        month_key(F.col("purchase_timestamp")).alias(MONTH_PARTITION),
        F.lit(20).alias("estimated_days"),
        (F.col("order_status") == "delivered").alias("is_delivered"),
        (F.col("order_status") == "canceled").alias("is_cancelled"),
    ).drop("t")
    carried = orders.select("order_id", "customer_key", "purchase_date_key", MONTH_PARTITION, "order_status")
    items = frame("order_id string, order_item_id int, product_key long, seller_key long, price string, freight_value string", ITEMS)
    payments = frame("order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value string", PAYMENTS)
    reviews = frame("review_id string, order_id string, review_score int", REVIEWS)
    money = "decimal(12,2)"
    tables = dict(
        dim_date=calendar(spark, date(2017, 1, 1), date(2018, 12, 31)),
        dim_customer=frame("customer_key long, customer_unique_id string, state string", CUSTOMERS),
        dim_seller=frame("seller_key long, seller_id string, state string", [(1, "s1", "SP"), (2, "s2", "SP"), (3, "s3", "RJ")]),
        dim_product=frame("product_key long, category_name_english string", [(1, "toys"), (2, "books"), (3, "Unknown")]),
        fact_orders=orders,
        fact_order_items=items.withColumns({c: F.col(c).cast(money) for c in ("price", "freight_value")}).join(carried, "order_id"),
        fact_payments=payments.withColumn("payment_value", F.col("payment_value").cast(money)).join(carried, "order_id"),
        fact_reviews=reviews.withColumns({"is_negative": F.col("review_score") <= 2, "is_positive": F.col("review_score") >= 4}).join(carried, "order_id"),
    )
    return SimpleNamespace(**{n: write_table(df.coalesce(1), f"{folder}/{n}") for n, df in tables.items()})


def test_monthly_growth_reads_the_previous_row(model):
    got = [tuple(r)[:1] + tuple(r)[2:] for r in Q.monthly_growth(model).collect()]
    assert got == [
        ("2017-01", D(200), None, None),
        ("2017-02", D(300), D(200), D("50.00")),
        ("2018-02", D(1000000), D(300), D("333233.33")),  # months without items are no rows
    ]


def test_growth_by_calendar_month(model):
    got = {r.year_month: r.mom_growth_pct for r in M.mom_growth(model).collect()}
    assert got == {"2017-01": None, "2017-02": D("50.00"), "2018-02": None}
    got = {r.year_month: r.yoy_growth_pct for r in M.yoy_growth(model).collect()}
    assert got == {"2017-01": None, "2017-02": None, "2018-02": D("333233.33")}


def test_growth_from_zero_is_null(spark, model):
    monthly = spark.createDataFrame([("2017-01", D(0)), ("2017-02", D(5))], "year_month string, v decimal(12,2)")
    got = {r.year_month: (r.prev_month_value, r.mom_growth_pct) for r in M.mom_growth(model, monthly, "v").collect()}
    assert got == {"2017-01": (None, None), "2017-02": (D(0), None)}


def test_year_to_date_restarts(model):
    assert rows(Q.ytd_revenue(model), "year_month", "ytd_merchandise_value") == [
        ("2017-01", D(200)),
        ("2017-02", D(500)),
        ("2018-02", D(1000000)),
    ]
    assert rows(M.year_to_date(model), "year_month", "ytd_value") == rows(Q.ytd_revenue(model), "year_month", "ytd_merchandise_value")


def test_share_is_of_all_categories(model):
    got = [tuple(r) for r in Q.top_categories(model, top=2).collect()]
    assert got == [("Unknown", 1, D(1000000), D("99.95")), ("books", 2, D(350), D("0.03"))]


def test_ties_keep_more_than_the_top(spark, model):
    tied = SimpleNamespace(**vars(model))
    tied.fact_order_items = model.fact_order_items.withColumn("price", F.lit(1).cast("decimal(12,2)")).filter("order_item_id = 1 or seller_key = 2")
    got = rows(Q.top_sellers_by_state(tied, top=1))
    assert got == [("RJ", 1, "s3", 1, D(1)), ("SP", 1, "s1", 2, D(2)), ("SP", 1, "s2", 2, D(2))]


def test_repeat_customers_keep_people_without_items(model):
    got = {r.customer_type: tuple(r)[1:] for r in Q.repeat_customers(model).collect()}
    assert got == {
        "One-time": (1, D("33.33"), D(0), D("0.00"), D("0.00")),
        "Repeat": (2, D("66.67"), D("1000500.00"), D("100.00"), D("500250.00")),
    }


def test_gap_counts_calendar_days(model):
    # p1: two minutes apart over midnight is one day; p2: the same day; p3 bought once.
    assert rows(Q.second_order_gap(model)) == [("1. Same day", 1, D("50.00")), ("2. 1-30 days", 1, D("50.00"))]


def test_delivery_by_state_keeps_unreviewed_orders(model):
    assert [tuple(r) for r in Q.state_delivery(model).collect()] == [
        ("RJ", 2, D("17.00"), D("50.00"), D("2.00")),
        ("SP", 2, D("7.00"), D("0.00"), D("3.00")),
    ]


def test_delay_buckets(model):
    assert rows(Q.delay_vs_score(model)) == [
        ("1. 10+ days early", 1, D("5.00"), D("0.00")),
        ("3. On estimated day", 1, D("1.00"), D("100.00")),
        ("5. 8-14 days late", 1, D("2.00"), D("100.00")),
    ]


def test_at_risk_categories(model):
    # All reviews average 2.75. Only Unknown sells above the mean, and it has no review.
    assert rows(Q.at_risk_categories(model)) == []
    cheaper = SimpleNamespace(**vars(model))
    cheaper.fact_order_items = model.fact_order_items.filter("price < 1000")
    # books 350 (orders o1: 5, o3: 2), toys 150 (o1: 5, o2: 1)
    assert rows(Q.at_risk_categories(cheaper)) == []
    low = SimpleNamespace(**vars(cheaper))
    low.fact_reviews = model.fact_reviews.withColumn("review_score", F.when(F.col("order_id") == "o1", 2).otherwise(F.col("review_score") + 1))
    # scores: o1 2, o2 2, o3 3, o5 4; mean 2.75; books (2 + 3) / 2
    assert rows(Q.at_risk_categories(low)) == [(1, "books", D(350), 2, D("2.50"))]


def test_freight_burden_drops_small_categories(model):
    assert [tuple(r) for r in Q.freight_burden(model, min_items=2).collect()] == [
        ("toys", 3, D("50.00"), D("5.33"), D("10.67")),
        ("books", 2, D("175.00"), D("17.50"), D("10.00")),
    ]


def test_payment_mix(model):
    got = [tuple(r) for r in Q.payment_mix(model).collect()]
    assert got == [
        ("card", 3, 3, D(490), D("88.29"), D("163.33"), D("2.00")),
        ("voucher", 1, 1, D(65), D("11.71"), D("65.00"), D("1.00")),
    ]


def test_seller_counts_an_order_once(model):
    got = {r.seller_id: tuple(r)[1:] for r in Q.seller_watchlist(model, min_orders=1).collect()}
    assert got == {
        "s1": ("SP", 2, D(1000150), D("0.00"), D("5.00")),
        "s2": ("SP", 2, D(50), D("0.00"), D("3.00")),
        "s3": ("RJ", 1, D(300), D("100.00"), D("2.00")),
    }


def test_cancellations(model):
    got = {r.year_month: tuple(r)[1:] for r in Q.cancellation_trend(model).collect()}
    assert got["2017-02"] == (3, 1, 0, D("33.33"))
    assert got["2017-05"] == (1, 0, 1, D("0.00"))


def test_fewer_people_than_quartiles(model):
    got = [tuple(r)[:4] for r in Q.spend_quartiles(model).collect()]
    assert got == [(1, 1, D("1000200.00"), D("1000200.00")), (2, 1, D("300.00"), D("300.00"))]


def test_estimate_accuracy_threshold(model):
    assert Q.estimate_accuracy(model).count() == 0
    got = [tuple(r) for r in Q.estimate_accuracy(model, min_orders=2).collect()]
    assert got == [("SP", 2, D("20.00"), D("7.00"), D("13.00"), D("50.00")), ("RJ", 2, D("20.00"), D("17.00"), D("3.00"), D("0.00"))]


def test_filtered_revenue(model):
    got = [tuple(r) for r in Q.filtered_category_revenue(model, 20170101, 20170131, "SP").collect()]
    assert got == [("toys", 1, D(150)), ("books", 1, D(50))]


def test_two_meanings_of_delivered(model):
    mix = M.order_status_mix(model).collect()[0]
    assert tuple(mix) == (6, 4, 1, 1)
    rates = M.delivery_rates(model).collect()[0]
    assert tuple(rates) == (4, D("75.00"), D("25.00"), D("-1.75"), D("12.00"), D("20.00"))


def test_customer_metrics(model):
    assert tuple(M.customers(model).collect()[0]) == (3, 2, D("66.67"))
    assert rows(M.new_customers(model)) == [("2017-01", 1), ("2017-02", 1), ("2017-05", 1)]
    assert rows(M.new_customers(model, "year")) == [(2017, 3)]


def test_measures_come_from_their_own_fact(model):
    assert tuple(M.financials(model).collect()[0]) == (D("1000500.00"), D("51.00"), D("555.00"))
    by_month = {r.year_month: tuple(r)[1:] for r in M.financials(model, ["year_month"]).collect()}
    assert by_month["2017-05"] == (None, None, D(10))
    assert by_month["2018-02"] == (D(1000000), D(0), None)


def test_average_order_value_counts_orders_without_items(model):
    got = {r.customer_state: tuple(r)[1:] for r in M.average_order_value(model, ["customer_state"]).collect()}
    assert got == {"SP": (3, D(200), D("66.67")), "RJ": (3, D(1000300), D("333433.33"))}


def test_ratios(model):
    assert M.freight_pct(model, where={"seller_id": "s2"}).collect()[0].freight_pct == D("12.00")
    got = {r.seller_state: r.contribution_pct for r in M.contribution_pct(model, ["seller_state"]).collect()}
    assert got == {"SP": D("99.97"), "RJ": D("0.03")}
    assert tuple(M.reviews(model).collect()[0]) == (4, D("2.75"), 2, 1)


def test_complete_months(model):
    # The data runs from 31 January 2017 to 11 February 2018, so the ends are partial.
    assert rows(M.complete_months(model), "year_month") == [("2017-02",)]


def test_slicing(model):
    df = slice_fact(model, "fact_order_items", ["category"], {"customer_state": ["SP"], "purchase_date_key": Between(20170101, 20170201)})
    assert rows(df, "order_id", "order_item_id", "category") == [("o1", 1, "toys"), ("o1", 2, "books"), ("o1", 3, "toys"), ("o2", 1, "toys")]
    with pytest.raises(ValueError, match="fact_orders has no product_key"):
        slice_fact(model, "fact_orders", ["category"])
    with pytest.raises(ValueError, match="unknown attributes: colour"):
        slice_fact(model, "fact_orders", ["colour"])


def test_one_filter_for_all_facts(model):
    got = rows(B.conformed_totals(model, {"year_month": "2017-01"}, {"state": "SP"}))
    assert got == [
        ("fact_order_items", 3, 1, D(200)),
        ("fact_orders", 1, 1, None),
        ("fact_payments", 2, 1, D(215)),
        ("fact_reviews", 1, 1, D(5)),
    ]
    unfiltered = rows(B.conformed_totals(model), "fact", "fact_rows")
    assert unfiltered == [("fact_order_items", 6), ("fact_orders", 6), ("fact_payments", 4), ("fact_reviews", 4)]


def test_propagation_counts_an_order_once_per_group(model):
    got = {r.category: tuple(r)[1:] for r in B.scores_by_category(model).collect()}
    assert got == {
        "toys": (2, 2, D("3.00"), D("0.00")),
        "books": (2, 2, D("3.50"), D("50.00")),
        "Unknown": (1, 0, None, D("0.00")),
    }


def test_seller_detail(model):
    r = B.seller_detail(model, "s1").collect()[0]
    assert (r.orders, r["items"], r.merchandise_value, r.freight_value) == (2, 3, D(1000150), D(15))
    assert (r.delivered_orders, r.late_pct, r.reviewed_orders, r.avg_review_score) == (2, D("0.00"), 1, D("5.00"))
    assert B.seller_detail(model, "nobody").count() == 0


def test_timestamps_stay_zone_free(model):
    assert dict(model.fact_orders.dtypes)["purchase_timestamp"] == "timestamp_ntz"
    assert model.fact_orders.filter("order_id = 'o1'").collect()[0].purchase_timestamp == datetime(2017, 1, 31, 23, 59)

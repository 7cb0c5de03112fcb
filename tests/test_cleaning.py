import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.operators import cleaning as C
from tradewind.operators.audit import audit, decision_log, row_count
from tradewind.plans import prepare
from tradewind.sources.schemas import RAW_COLUMNS


def raw_orders(frame, data):
    ddl = ", ".join(f"{c} string" for c in RAW_COLUMNS["orders"])
    return frame(ddl, data)


def test_delivery_metrics(frame):
    def order(key, status, delivered, purchase="2017-06-01 10:00:00", estimated="2017-06-11 00:00:00"):
        return (key, f"c{key}", status, purchase, None, "garbage", delivered, estimated)

    df = raw_orders(
        frame,
        [
            order("early3h", "delivered", "2017-06-10 21:00:00"),
            order("same", "delivered", "2017-06-11 18:00:00"),
            order("late", "delivered", "2017-06-12 03:00:00"),
            order("ten", "delivered", "2017-06-01 00:00:00", purchase="2017-05-30 00:00:00"),
            order("nodate", "delivered", None),
            order("cancelled", "canceled", "2017-06-05 12:00:00"),
            order("nostatus", None, None),
            order("noestimate", "delivered", "2017-06-05 12:00:00", estimated=None),
        ],
    )
    got = {
        r[0]: tuple(r)[1:]
        for r in prepare.prepare_orders(lambda e: df)
        .select("order_id", "delivery_days", "estimated_days", "delivery_delay_days", "is_delivered", "is_cancelled", "is_late")
        .collect()
    }
    assert got == {
        "early3h": (9, 9, -1, True, False, False),
        "same": (10, 9, 0, True, False, False),
        "late": (10, 9, 1, True, False, True),
        "ten": (2, 12, -10, True, False, False),
        "nodate": (None, 9, None, True, False, None),
        "cancelled": (4, 9, -6, False, True, False),
        "nostatus": (None, 9, None, False, False, None),
        "noestimate": (4, None, None, True, False, False),
    }


def test_replace_and_fill(frame):
    df = frame("a int, b string", [(0, None), (1, "x"), (None, "y")])
    got = C.fill_missing(C.replace_value(df, "a", 0, 1), "b", "unknown")
    assert rows(got) == [(1, "unknown"), (1, "x"), (None, "y")]


def test_latest_per_key(frame):
    df = frame(
        "k string, d string, id string",
        [("a", "2018-01-01", "1"), ("a", "2018-01-03", "2"), ("b", "2018-01-01", "9"), ("b", "2018-01-01", "3"), ("c", None, "5"), ("c", "2017-01-01", "6"), ("d", None, "7")],
    )
    got = C.latest_per_key(df, ["k"], "d", ["id"])
    assert rows(got, "k", "id") == [("a", "2"), ("b", "3"), ("c", "6"), ("d", "7")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_lookup(frame):
    df = frame("id int, k string", [(1, "a"), (2, "zz"), (3, None), (4, "a")])
    ref = frame("k string, v string", [("a", "A"), ("b", "B"), (None, "N")])
    assert rows(C.lookup(df, ref, "k", {"v": "Unknown"})) == [
        (1, "a", "A"),
        (2, "zz", "Unknown"),
        (3, None, "Unknown"),
        (4, "a", "A"),
    ]
    twice = ref.union(frame("k string, v string", [("a", "other")]))
    with pytest.raises(Exception, match="lookup key k is not unique: a"):
        C.lookup(df, twice, "k", {"v": "Unknown"}).collect()


def test_collapse_points(frame):
    df = frame(
        "zip int, lat double, city string, state string",
        [
            (1, 1.0, "sao paulo", "SP"),
            (1, 1.0, "sao paulo", "SP"),  # exact duplicate counts once
            (1, 2.0, "são paulo", "SP"),
            (1, 3.0, "são paulo", "SP"),
            (2, 5.0, "b", "X"),
            (2, 7.0, "a", "X"),  # tie goes to the smallest
            (3, None, None, "Y"),
            (3, 4.0, None, None),
            (None, 9.0, "lost", "Z"),
        ],
    )
    got = rows(C.collapse_points(df, "zip", ["lat"], ["city", "state"]))
    assert got == [(1, 2.0, "são paulo", "SP"), (2, 6.0, "a", "X"), (3, 4.0, None, "Y")]


def test_products(frame):
    products = frame(
        ", ".join(f"{c} string" for c in RAW_COLUMNS["products"]),
        [("p1", "perfumaria", "1", "2", "3", "4", "5", "6", "7"), ("p2", None, *[None] * 7), ("p3", "novo", *[None] * 7)],
    )
    translation = frame("product_category_name string, product_category_name_english string", [("perfumaria", "perfumery")])
    raw = {"products": products, "product_category_name_translation": translation}.__getitem__
    staged = prepare.stage(raw, "products")
    assert rows(staged, "product_id", "product_category_name", "product_category_name_english", "product_name_length") == [
        ("p1", "perfumaria", "perfumery", 1.0),
        ("p2", "unknown", "Unknown", None),
        ("p3", "novo", "Unknown", None),
    ]


def test_audit_and_log(frame):
    df = frame("a int", [(0,), (1,), (2,)])
    rules = audit(df, "e", {"zero": F.col("a") == 0, "big": F.col("a") > 0})
    assert rows(rules) == [("e", "big", 3, 3, 2), ("e", "zero", 3, 3, 1)]
    removed = audit(df.filter("a > 0"), "e", {"removed": F.lit(False)}, row_count(df))
    assert rows(removed) == [("e", "removed", 3, 2, 0)]
    messages = rows(decision_log(rules.union(removed)), "message")
    assert messages == [("e: big: 2 of 3 rows",), ("e: removed: 3 rows reduced to 2",), ("e: zero: 1 of 3 rows",)]

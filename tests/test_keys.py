import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradewind.operators.calendar import calendar
from tradewind.operators.keys import tile_summary, with_dense_key
from tradewind.sources.files import write_table


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_dense_key(spark, tmp_path, n):
    stored = write_table(spark.range(n).select(F.col("id").alias("nk")).repartition(7), str(tmp_path / "t"))
    keyed = with_dense_key(stored, "sk")
    pairs = keyed.collect()
    assert sorted(r.sk for r in pairs) == list(range(1, n + 1))
    assert sorted(r.nk for r in pairs) == list(range(n))
    assert {r.nk: r.sk for r in keyed.collect()} == {r.nk: r.sk for r in pairs}
    # A filter must not renumber the rows that stay.
    kept = {r.nk: r.sk for r in keyed.filter("nk % 2 = 0").collect()}
    assert kept == {r.nk: r.sk for r in pairs if r.nk % 2 == 0}


def expected_tiles(values, tiles):
    ordered = sorted(values, reverse=True)
    size, larger = divmod(len(ordered), tiles)
    out, at = [], 0
    for t in range(tiles):
        part = ordered[at : at + size + (t < larger)]
        at += len(part)
        if part:
            out.append((t + 1, len(part), min(part), max(part), sum(part)))
    return out


def cents(x):
    return Decimal(x).scaleb(-2)


RANDOM = random.Random(7)
CASES = {
    "empty": [],
    "one": [cents(5)],
    "fewer than tiles": [cents(5), cents(7), cents(7)],
    "distinct": [cents(i * 1337) for i in range(101)],
    "one hot value": [cents(500)] * 700 + [cents(i) for i in range(300)],
    "all equal": [cents(100)] * 10,
    "many magnitudes": [cents(RANDOM.choice([0, 1, 999, 1000, 9999, 10000, 10**9]) + RANDOM.randint(0, 5)) for _ in range(503)],
    "negative": [cents((i - 20) * 10001) for i in range(57)],
}


@pytest.mark.parametrize("tiles", [1, 2, 4, 7])
@pytest.mark.parametrize("case", CASES)
def test_tiles_equal_a_global_ntile(frame, case, tiles):
    df = frame("v decimal(22,2)", [(v,) for v in CASES[case]])
    rows = tile_summary(df, "v", tiles).collect()
    assert sorted(tuple(r)[:5] for r in rows) == expected_tiles(CASES[case], tiles)
    assert all(r.n_valued == r.n for r in rows)


def test_rows_without_a_value_are_in_the_last_tiles(frame):
    df = frame("v decimal(22,2)", [(cents(-300),), (None,), (cents(500),), (None,), (None,)])
    got = sorted(tuple(r) for r in tile_summary(df, "v", 3).collect())
    assert got == [
        (1, 2, cents(-300), cents(500), cents(200), 2),
        (2, 2, None, None, None, 0),
        (3, 1, None, None, None, 0),
    ]


def test_tiles_never_rank_rows_in_one_task(frame):
    df = frame("v decimal(22,2)", [(cents(i),) for i in range(50)])
    plan = tile_summary(df, "v", 4)._jdf.queryExecution().executedPlan().toString()
    # The only unpartitioned window is over bucket totals, above their aggregate.
    before_single = plan[plan.index("Exchange SinglePartition") :]
    assert plan.count("Exchange SinglePartition") == 1
    assert "HashAggregate(keys=[_bucket" in before_single


def test_calendar(spark):
    days = calendar(spark, date(2016, 1, 1), date(2018, 12, 31))
    assert days.count() == 1096
    leap = days.filter("full_date = date'2016-02-29'").drop("full_date").collect()[0]
    assert tuple(leap) == (20160229, 2016, 1, "Q1", 2, "February", "Feb", "2016-02", 29, 1, "Monday", False)
    sunday = days.filter("date_key = 20180107").collect()[0]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (7, "Sunday", True)

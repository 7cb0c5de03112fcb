from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tradewind.functions import date_key, elapsed_days, month_key, parse_timestamp, ratio, strip_upper, title_case


def test_timestamps_are_parsed_leniently(frame):
    df = frame("t string", [("2017-10-02 10:56:33",), ("2017-10-02",), ("",), ("bad",), ("2017-13-40 00:00:00",), ("2017",), (None,)])
    got = [r[0] for r in df.select(parse_timestamp(F.col("t"))).collect()]
    assert got == [datetime(2017, 10, 2, 10, 56, 33), datetime(2017, 10, 2), None, None, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_elapsed_days_round_down_in_any_zone(spark, frame, zone):
    cases = [
        ("2017-06-10 21:00:00", "2017-06-11 00:00:00", -1),
        ("2017-06-11 15:00:00", "2017-06-11 00:00:00", 0),
        ("2017-06-12 03:00:00", "2017-06-11 00:00:00", 1),
        ("2017-06-01 00:00:00", "2017-06-11 00:00:00", -10),
        ("2017-06-01 23:00:00", "2017-06-11 00:00:00", -10),
        ("2017-10-25 00:00:00", "2017-10-15 00:00:00", 10),  # ten days over a clock change
        ("2017-06-12 00:00:00.2", "2017-06-11 00:00:00.9", 0),
        (None, "2017-06-11 00:00:00", None),
    ]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = frame("a string, b string, want int", cases)
        got = df.select("want", elapsed_days(parse_timestamp(F.col("a")), parse_timestamp(F.col("b"))).alias("got"))
        assert all(r.want == r.got for r in got.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "text",
    [
        "  santa barbara d'oeste ",
        "mogi-guacu",
        "SÃO PAULO",
        "\tnbsp padded ",
        "4o. centenario",
        "",
        "arraial d'ajuda",
        "são josé dos pinhais",
        "a1b2 c3",
    ],
)
def test_title_case_is_that_of_python(frame, text):
    df = frame("t string", [(text,)])
    got = df.select(title_case(F.col("t")), strip_upper(F.col("t"))).collect()[0]
    assert tuple(got) == (text.strip().title(), text.strip().upper())


def test_text_functions_keep_null(frame):
    got = frame("t string", [(None,)]).select(title_case(F.col("t")), strip_upper(F.col("t"))).collect()[0]
    assert tuple(got) == (None, None)


def test_ratio_is_exact_and_safe(frame):
    df = frame("n string, d string", [("1", "3"), ("1", "0"), ("12345", "100000"), ("-5", "1000"), ("1000000", "1"), (None, "2")])
    df = df.select(ratio(F.col("n").cast("decimal(22,2)"), F.col("d").cast("decimal(22,2)"), 2, 100).alias("r"))
    got = [None if r[0] is None else str(r[0]) for r in df.collect()]
    assert got == ["33.33", None, "12.35", "-0.50", "100000000.00", None]


def test_date_keys(frame):
    df = frame("t string", [("2018-03-05 23:59:59",), (None,)]).select(parse_timestamp(F.col("t")).alias("t"))
    assert rows(df.select(date_key(F.col("t")), month_key(F.col("t")))) == [(20180305, 201803), (None, None)]

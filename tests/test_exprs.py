import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import exprs as X
from millrace.plans import care
from millrace.plans.commerce import frequency_segment


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_age_and_stay_buckets(spark):
    ages = column(spark, [18, 19, 35, 36, 60, 61, None], "int", care.age_group("v"))
    assert ages == ["0-18", "19-35", "19-35", "36-60", "36-60", "60+", "60+"]
    assert column(spark, [None], "int", care.age_group("v", "unknown")) == ["unknown"]
    stays = column(spark, [2, 3, 7, 8, None], "int", care.stay_bucket("v"))
    assert stays == ["Short", "Medium", "Medium", "Long", "Long"]


def test_bucketize_needs_one_label_more():
    with pytest.raises(ValueError):
        X.bucketize("v", (1, 2), ("a", "b"))


def test_price_tiers(spark):
    prices = [Decimal("999.99"), Decimal("1000"), Decimal("3000"), Decimal("3000.01"), None]
    got = column(spark, prices, "decimal(10,2)", X.price_tier("v"))
    assert got == ["Budget", "Mid-Range", "Mid-Range", "Premium", None]


def test_frequency_segment(spark):
    got = column(spark, [1, 2, 4, 5], "int", frequency_segment("v"))
    assert got == ["One-Time", "Occasional", "Occasional", "Loyal"]


def test_currency_text(spark):
    texts = ["₹3,995.00", '"₹1,23,456.50"', " 12 ", "on request", None, ""]
    got = column(spark, texts, "string", X.parse_currency("v"))
    assert got == [Decimal("3995.00"), Decimal("123456.50"), Decimal("12.00"), None, None, None]


def test_lenient_conversions(spark):
    assert column(spark, ["1.5", " 2 ", "x", None], "string", X.to_number("v")) == [1.5, 2.0, None, None]
    days = column(
        spark, ["2021-01-07 00:00:00", "2021-01-07", "2021-13-01", "", None], "string",
        X.to_day("v").cast("string"),
    )
    assert days == ["2021-01-07", "2021-01-07", None, None, None]
    parsed = column(spark, ["1/9/2014", "12/31/2017", "31/12/2017"], "string", X.parse_day("v").cast("string"))
    assert parsed == ["2014-01-09", "2017-12-31", None]


def test_canonical_keeps_unknown_text(spark):
    names = ["Cardio", " CARDIOLOGY ", "Gen. Medicine", "Dermatology", None]
    got = column(spark, names, "string", X.canonical("v", care.DEPARTMENTS))
    assert got == ["Cardiology", "Cardiology", "General Medicine", "Dermatology", None]


def test_growth_is_null_without_a_base(spark):
    df = spark.createDataFrame([(110.0, 100.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(X.growth_pct("a", "b")).collect()] == [10.0, None, None]


def test_clip_and_flag(spark):
    assert column(spark, [-0.1, 0.5, 1.5, None], "double", X.clip("v", 0.0, 1.0, 0.0)) == [0.0, 0.5, 1.0, 0.0]
    assert column(spark, [1, 0, None, 2], "int", X.flag("v")) == [1, 0, 0, 0]


def test_month_offset_truncates(spark):
    assert column(spark, [0, 29, 30, 59, 60], "int", X.month_offset("v")) == [0, 0, 1, 1, 2]


def test_money_sum_is_exact(spark):
    rng = random.Random(7)
    values = [rng.randint(-(10**15), 10**15) for _ in range(500)] + [9 * 10**18, 9 * 10**18]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert df.agg(X.money_sum("v", 4)).first()[0] == Decimal(sum(values)).scaleb(-4)
    assert df.where("v = 0").agg(X.money_sum("v", 4)).first()[0] is None


def test_line_revenue_and_cents(spark):
    df = spark.createDataFrame([(100.10, 0.05), (0.01, 0.1), (19.99, 0.0)], "g double, d double")
    got = df.select(X.line_revenue("g", "d"), X.cents("g")).collect()
    assert [tuple(r) for r in got] == [
        (Decimal("95.0950"), 10010), (Decimal("0.0090"), 1), (Decimal("19.9900"), 1999)
    ]


def test_year_range_reaches_the_scan(spark, sf):
    from millrace.sources import tables

    plan = (
        tables.orders(spark, sf).where(X.in_year("order_date", 1998))
        ._jdf.queryExecution().executedPlan().toString()
    )
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_rounding_is_half_up(spark):
    assert column(spark, [2.675, -2.5, 0.125], "double", F.round("v", 2)) == [2.68, -2.5, 0.13]

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abacist import Period
from abacist.functions import (
    amount,
    band,
    display_name,
    exchange,
    growth,
    numeric,
    pct,
    seconds_between,
    tiered_price,
    token_cost,
    whole_days,
)
from abacist.functions.columns import needs_custom_price
from abacist.operators.tickets import AGE_EDGES, AGE_LABELS
from abacist.operators.usage import VOLUME_EDGES, VOLUME_LABELS


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_period_is_half_open_and_rolls_over_the_year():
    assert Period.month(2025, 12) == Period(date(2025, 12, 1), date(2026, 1, 1))
    assert Period.month(2024, 2).days()[-1] == "29"
    assert Period.year(1996).months() == [f"1996-{m:02d}" for m in range(1, 13)]


@pytest.mark.parametrize(
    "first, last, email, name",
    [
        ("Ada", "Low", "a@x", "Ada Low"),
        ("Ada", None, "a@x", "a@x"),
        (None, "Low", None, "(unknown user)"),
        (" ", " ", "a@x", "a@x"),
        ("Ada", "", "a@x", "Ada"),
    ],
)
def test_display_name(spark, first, last, email, name):
    parts = [F.lit(p).cast("string") for p in (first, last, email)]
    assert one(spark, display_name(*parts)) == name


@pytest.mark.parametrize(
    "units, price",
    [
        (1, 2990),
        (299, 2990),
        (300, 3000),
        (500, 5000),
        (501, 5009),
        (1000, 9500),
        (1500, 13500),
        (2000, 17000),
        (3000, 23000),
        (5000, 33000),
        (5001, 2990),
    ],
)
def test_tiered_price(spark, units, price):
    n = F.lit(units).cast("bigint")
    assert one(spark, tiered_price(n)) == price
    assert one(spark, needs_custom_price(n)) is (units > 5000)
    assert one(spark, tiered_price(n, over_cap="null")) == (None if units > 5000 else price)


def test_tiered_price_never_falls_below_the_cap(spark):
    prices = spark.range(5001).select(tiered_price(F.col("id")).alias("p"), "id")
    found = [r["p"] for r in prices.orderBy("id").collect()]
    assert all(a <= b for a, b in zip(found, found[1:]))


def test_money_rounds_half_up_in_decimals(spark):
    units = F.lit(237).cast("bigint")
    assert one(spark, amount(units, Decimal("0.035"))) == Decimal("8.30")
    assert one(spark, exchange(F.lit(Decimal("8.30")), Decimal("25.0"))) == Decimal("207.50")
    assert one(spark, numeric(F.lit(6.949999999999999), 1)) == Decimal("7.0")


def test_shares_and_growth(spark):
    big = lambda n: F.lit(n).cast("bigint")
    assert one(spark, pct(big(1), big(3))) == Decimal("33.3")
    assert one(spark, pct(big(1), big(0))) is None
    assert one(spark, growth(big(150), big(100))) == Decimal("50.0")
    assert one(spark, growth(big(150), big(0))) is None
    assert one(spark, growth(big(41), big(2000))) == Decimal("-98.0")  # -97.95 away from zero


def test_token_cost_is_exact(spark):
    cost = token_cost(F.lit(1_000_000).cast("bigint"), F.lit(3).cast("bigint"))
    assert one(spark, cost) == Decimal("2.10102523")


@pytest.mark.parametrize("zone", ["UTC", "Europe/Prague"])
def test_elapsed_time_ignores_clock_changes(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamp = lambda s: F.lit(s).cast("timestamp_ntz")
        # the night of the spring change in this zone
        gap = seconds_between(stamp("2024-04-01 00:00:00.5"), stamp("2024-03-31 00:00:00"))
        assert one(spark, gap) == Decimal("86400.500000")
        days = lambda a, b: one(spark, whole_days(stamp(a), stamp(b)))
        assert days("2024-01-02 11:59:00", "2024-01-01 12:00:00") == 0  # across midnight
        assert days("2024-01-02 12:00:00", "2024-01-01 12:00:00") == 1
        assert days("2024-01-01 11:59:59", "2024-01-01 12:00:00") == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_volume_bands_are_upper_inclusive(spark):
    label = lambda n: one(spark, band(F.lit(n), VOLUME_EDGES, VOLUME_LABELS))
    assert [label(n) for n in (0, 500, 501, 5000, 5001)] == [
        "0–500",
        "0–500",
        "501–1000",
        "3001–5000",
        "5000+",
    ]


def test_age_bands_are_lower_inclusive(spark):
    label = lambda n: one(spark, band(F.lit(n), AGE_EDGES, AGE_LABELS, "lower"))
    ages = (-1, 0, 1, 2, 3, 6, 7, 13, 14, 29, 30, 59, 60, 89, 90)
    assert [label(n) for n in ages] == [
        None, "0d", "1-2d", "1-2d", "3-6d", "3-6d", "7-13d", "7-13d", "14-29d", "14-29d",
        "30-59d", "30-59d", "60-89d", "60-89d", "90d+",
    ]


def test_lit_of_a_date_compares_with_timestamps(spark):
    inside = Period.month(2026, 7).contains(F.lit(datetime(2026, 8, 1)))
    assert one(spark, inside) is False
    assert one(spark, Period.month(2026, 8).contains(F.lit("2026-08-01").cast("timestamp"))) is True

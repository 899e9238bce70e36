import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemart.functions import (
    day_type,
    parse_price,
    percent_change,
    sales_amount,
    season_of_month,
    time_id_of,
    week_monday_first,
)


def _week_mode1_brute(d: dt.date) -> int:
    """Monday-first week, week 1 = first week with >= 4 days in the year,
    range 0..53 - computed by walking the calendar."""
    jan1 = dt.date(d.year, 1, 1)
    # Monday of the week containing 1 January
    start = jan1 - dt.timedelta(days=jan1.weekday())
    days_in_year_in_first_week = 7 - jan1.weekday()
    first_week_no = 1 if days_in_year_in_first_week >= 4 else 0
    return first_week_no + (d - start).days // 7


def test_week_matches_calendar_walk(spark):
    start = dt.date(1994, 12, 20)
    dates = [start + dt.timedelta(days=i) for i in range(0, 365 * 12, 3)]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = {r.d: r.w for r in df.select("d", week_monday_first("d").alias("w")).collect()}
    for d in dates:
        assert got[d] == _week_mode1_brute(d), d


def test_week_year_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1),), (dt.date(1996, 12, 31),), (dt.date(1996, 1, 1),)], "d date")
    got = [r.w for r in df.select(week_monday_first("d").alias("w")).collect()]
    assert got == [0, 53, 1]


def test_time_id_and_day_type_and_season(spark):
    df = spark.createDataFrame([(dt.date(1998, 3, 7),), (dt.date(1998, 12, 2),), (None,)], "d date")
    rows = df.select(
        time_id_of("d").alias("t"), day_type("d").alias("k"),
        season_of_month(F.month("d")).alias("s")).collect()
    assert [(r.t, r.k, r.s) for r in rows] == [
        (19980307, "Weekend", "Spring"), (19981202, "Weekday", "Winter"), (None, "Weekday", "Winter")]


def test_parse_price(spark):
    df = spark.createDataFrame([("1299.99$",), (" 69.99$ ",), ("abc",), (None,), ("1,299.50$",)], "p string")
    got = [r.v for r in df.select(parse_price("p").alias("v")).collect()]
    assert got == [Decimal("1299.99"), Decimal("69.99"), None, None, Decimal("1299.50")]


def test_sales_amount_nulls_are_zero(spark):
    df = spark.createDataFrame(
        [(Decimal("10.25"), 3), (None, 2), (Decimal("5.00"), None)], "price decimal(10,2), q int")
    got = [r.v for r in df.select(sales_amount("price", "q").alias("v")).collect()]
    assert got == [Decimal("30.75"), Decimal("0.00"), Decimal("0.00")]


def test_percent_change_guards(spark):
    df = spark.createDataFrame([(150.0, 100.0), (5.0, 0.0), (5.0, None)], "c double, p double")
    got = [r.v for r in df.select(percent_change("c", "p").alias("v")).collect()]
    assert got == [50.0, None, None]

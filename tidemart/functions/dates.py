"""Calendar attributes of the time dimension, as JVM column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: must equal the report specification --------------------
# Weekend = Sunday and Saturday (Spark dayofweek numbers Sunday 1 .. Saturday 7)
WEEKEND_DAYS = (1, 7)
WEEKEND, WEEKDAY = "Weekend", "Weekday"
# Seasons by calendar month; every other month (and NULL) is Winter
SEASONS = (("Spring", (3, 4, 5)), ("Summer", (6, 7, 8)), ("Fall", (9, 10, 11)))
DEFAULT_SEASON = "Winter"
# Week numbering: Monday is the first day; week 1 is the first week with at
# least 4 days in the year; weeks run 0..53
WEEK_FIRST_FULL_DAYS = 4
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_order_date(col) -> Column:
    """Timestamp (with or without zone) or date -> DATE."""
    return _c(col).cast("date")


def time_id_of(date_col) -> Column:
    """Day key ``yyyymmdd`` as INT; one id per calendar day (no fan-out)."""
    d = _c(date_col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def week_monday_first(date_col) -> Column:
    """Week number with Monday as first day, week 1 = first week having at
    least four days in the year, range 0..53 (days before week 1 are week 0;
    late December never rolls into next year's week 1).
    """
    d = _c(date_col)
    # weekday of 1 January, Monday = 0 .. Sunday = 6
    jan1 = (F.dayofweek(F.trunc(d, "year")) + 5) % 7
    weeks_since_jan1_week = F.floor((F.dayofyear(d) - 1 + jan1) / 7)
    # the week holding 1 January is week 1 when it has >= 4 days of the year
    first_is_week1 = F.when(7 - jan1 >= WEEK_FIRST_FULL_DAYS, 1).otherwise(0)
    return (weeks_since_jan1_week + first_is_week1).cast("int")


def quarter_of(date_col) -> Column:
    return F.quarter(_c(date_col))


def day_type(date_col) -> Column:
    """'Weekend' for Sunday and Saturday, else 'Weekday' (NULL -> Weekday)."""
    return (
        F.when(F.dayofweek(_c(date_col)).isin(*WEEKEND_DAYS), F.lit(WEEKEND))
        .otherwise(F.lit(WEEKDAY))
    )


def season_of_month(month_col) -> Column:
    """Meteorological season; anything else, NULL included, is Winter."""
    m = _c(month_col)
    expr = None
    for name, months in SEASONS:
        expr = (F.when if expr is None else expr.when)(m.isin(*months), F.lit(name))
    return expr.otherwise(F.lit(DEFAULT_SEASON))


def month_index(year_col, month_col) -> Column:
    """Months since year 0: consecutive calendar months differ by one."""
    return _c(year_col) * 12 + _c(month_col) - 1


def time_attributes(date_col) -> dict[str, Column]:
    """All time-dimension attributes of a date column, by output name."""
    d = _c(date_col)
    return {
        "day": F.dayofmonth(d),
        "week": week_monday_first(d),
        "month": F.month(d),
        "year": F.year(d),
        "quarter": quarter_of(d),
    }

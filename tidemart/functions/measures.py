"""Money and measure expressions.

Amounts stay exact decimals; a report turns a finished aggregate into
DOUBLE with :func:`as_double` as its very last step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.schemas import MONEY

# --- Fixed values: must equal the report specification --------------------
OUTLIER_YES, OUTLIER_NO = "Yes", "No"
OUTLIER_FACTOR = 2          # a sale is an outlier above 2 x the mean
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


#: A price with or without thousands commas; "1.299,99" is not one.
PRICE_PATTERN = r"^[+-]?(\d+|\d{1,3}(,\d{3})+)(\.\d*)?$"


def parse_price(text_col) -> Column:
    """Currency text such as ``"1299.99$"`` -> decimal(10,2).

    Currency signs and blanks are dropped, and commas between groups of three
    digits; text that still is no number becomes NULL instead of failing the
    job or changing the amount.
    """
    cleaned = F.regexp_replace(F.trim(_c(text_col)), r"[$\s]", "")
    return F.when(cleaned.rlike(PRICE_PATTERN), F.regexp_replace(cleaned, ",", "")).try_cast(MONEY)


def zero_if_null(col, type_name: str | None = None) -> Column:
    c = F.coalesce(_c(col), F.lit(0))
    return c.cast(type_name) if type_name else c


def sales_amount(price_col, quantity_col) -> Column:
    """price x quantity in exact decimal(10,2); a missing side counts as 0, an
    amount beyond the type is NULL (the row is rejected, the load goes on)."""
    price = zero_if_null(_c(price_col).cast(MONEY), None).cast(MONEY)
    qty = zero_if_null(_c(quantity_col), None).cast("int")
    return (price * qty).try_cast(MONEY)


def as_double(col) -> Column:
    return _c(col).cast("double")


def percent_change(current_col, previous_col) -> Column:
    """(current - previous) / previous * 100 as DOUBLE; NULL when there is no
    previous value or it is zero (no division by zero under ANSI mode)."""
    cur = as_double(current_col)
    prev = as_double(previous_col)
    return (
        F.when(prev.isNull() | (prev == 0), F.lit(None).cast("double"))
        .otherwise((cur - prev) / prev * 100.0)
    )


def ratio(numerator, denominator) -> Column:
    """DOUBLE numerator / denominator (an exact mean from sum and count)."""
    den = as_double(denominator)
    return F.when(den == 0, F.lit(None).cast("double")).otherwise(as_double(numerator) / den)


def above_factor_of_mean(value, total, count) -> Column:
    """'Yes' when value > OUTLIER_FACTOR x (total / count), decided exactly as
    value * count > OUTLIER_FACTOR * total (no rounded mean), else 'No'."""
    return (
        F.when(_c(value) * _c(count) > _c(total) * OUTLIER_FACTOR, F.lit(OUTLIER_YES))
        .otherwise(F.lit(OUTLIER_NO))
    )

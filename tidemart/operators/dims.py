"""Dimension members: insert-if-absent, first value wins.

A dimension row is never updated once written (type-0 dimension).  When
one key arrives with several attribute values (a supplier id under two
names) the row with the smallest fact key wins - a deterministic rule
instead of "whichever was processed first".  Members are found as distinct
(key, attributes), a hash aggregate; only the keys that turn out to have
several values are ordered by the fact key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.dates import time_attributes
from tidemart.schemas import FACT_KEY
from tidemart.session import materialize


def first_wins(rows: DataFrame, key: str, attrs: Sequence[str],
               order_by: Sequence[str] = FACT_KEY) -> DataFrame:
    """One row per non-NULL ``key`` with the attributes of its first row.

    The rows are read once to find each key's distinct values and once more
    for the conflicting keys only, so callers pass a stored table or a cheap
    plan.  Both passes aggregate on the map side; a hot key costs one partial
    row per task."""
    order = [c for c in order_by if c in rows.columns]
    if not order:
        raise ValueError("first_wins needs at least one ordering column")
    known = rows.where(F.col(key).isNotNull())
    values = known.select(key, *attrs).distinct()
    several = values.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    plain = values.join(several.where("_n = 1").select(key), key, "left_semi")
    picked = F.min_by(F.struct(*[F.col(a) for a in attrs]), F.struct(*[F.col(c) for c in order]))
    conflicting = (
        known.join(several.where("_n > 1").select(key), key, "left_semi")
        .groupBy(key)
        .agg(picked.alias("_first"))
        .select(key, *[F.col(f"_first.{a}").alias(a) for a in attrs])
    )
    return plain.unionByName(conflicting)


def absent_members(members: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Members whose key is not in the existing dimension yet."""
    if existing is None:
        return members
    known = existing.select(key).where(F.col(key).isNotNull())
    return members.join(known, key, "left_anti")


def dimension_members(matched: DataFrame, key: str, attrs: Sequence[str],
                      existing: DataFrame | None = None,
                      order_by: Sequence[str] = FACT_KEY) -> DataFrame:
    """New members of one dimension from enriched (matched) rows only."""
    attrs = [a for a in attrs if a in matched.columns]
    return absent_members(first_wins(matched, key, attrs, order_by), existing, key)


def carried_members(matched: DataFrame, master: DataFrame, via: str, key: str, attrs: Sequence[str],
                    existing: DataFrame | None = None, order_by: Sequence[str] = FACT_KEY) -> DataFrame:
    """:func:`dimension_members` where the attributes come from a master with unique ``via``: matched rows need
    only their keys.

    The ids sold are one aggregate over a key column; names meet them in the
    master, so no text is carried through the rows.  Where the dimension's key
    is not the master's (stores of suppliers), one key may have several values:
    for those keys alone the rows are ordered by the fact key.  The master's rows
    that were sold are stored first: their size is known then, and matched rows are
    not shuffled to meet a few clashing members, or none."""
    sold = matched.select(via).where(F.col(via).isNotNull()).distinct()
    rows = master.select(*dict.fromkeys((via, key, *attrs))).join(sold, via, "left_semi")
    if key == via:
        return absent_members(rows.select(key, *attrs), existing, key)
    rows = materialize(rows, "members-sold")
    order = [c for c in order_by if c in matched.columns]
    known = rows.where(F.col(key).isNotNull())
    values = known.select(key, *attrs).distinct()
    several = values.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    plain = values.join(several.where("_n = 1").select(key), key, "left_semi")
    clashing = known.join(several.where("_n > 1").select(key), key, "left_semi")
    clashing = clashing.select(F.col(via), F.struct(F.col(key), *[F.col(a) for a in attrs]).alias("_value"))
    picked = F.min_by("_value", F.struct(*[F.col(c) for c in order]))
    conflicting = (
        matched.select(*dict.fromkeys((via, *order))).join(clashing, via)
        .groupBy(F.col(f"_value.{key}").alias("_key")).agg(picked.alias("_first"))
        .select(*[F.col(f"_first.{c}").alias(c) for c in (key, *attrs)])
    )
    return absent_members(plain.unionByName(conflicting), existing, key)


def time_members(feed: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """New time-dimension rows from *all* feed rows (matched or not).

    Every distinct (time_id, date) with a date and a time id enters - several
    dates of one new time_id all do - while any date of a time_id already
    in the dimension is ignored (anti-join on time_id, NULLs excluded).
    Distinct dates are calendar-bounded, so this output stays small.
    """
    rows = (
        feed.where(F.col("order_date").isNotNull() & F.col("time_id").isNotNull())
        .select("time_id", "order_date")
        .distinct()
    )
    rows = absent_members(rows, existing, "time_id")
    attrs = time_attributes("order_date")
    return rows.select(
        "time_id", "order_date",
        attrs["day"].alias("day"), attrs["week"].alias("week"),
        attrs["month"].alias("month"), attrs["year"].alias("year"),
        attrs["quarter"].alias("quarter"),
    )


# attribute lists of the star's dimensions (extra attributes such as a
# product category or a store region are carried when present)
DIMENSIONS = {
    "dim_customer": ("customer_id", ("customer_name", "gender")),
    "dim_product": ("product_id", ("product_name", "product_price", "category")),
    "dim_store": ("store_id", ("store_name", "region")),
    "dim_supplier": ("supplier_id", ("supplier_name",)),
}

"""Two interchangeable views of the sales star.

Reports ask a star for ``sales(year=..., dims=...)``: fact rows with the
attributes of the requested dimensions.  Both implementations return the
same columns and the same rows, so every report is written once.  In both,
time attributes come from the time dimension joined on ``time_id``: an id
with several dates multiplies its facts, and a fact whose id has no date
drops out, as the reports are specified.

* :class:`WarehouseStar` - loaded warehouse tables (fact + dims).  Joins the
  fact to exactly the dimensions a report needs.  A year filter goes to the
  time dimension only; the join is on ``time_id`` and the storage bucket
  derived from it, so Spark prunes the fact's partitions at run time, and
  exactly.
* :class:`FeedStar` - the star computed straight from the sources: the
  enrichment join already carries product/supplier/store attributes; the
  time dimension is built from the feed's own (time_id, date) pairs.  Where
  every time id is derived from the row's date (``dated``), an id has one date
  and the row carries it: the attributes are computed from it without building
  the dimension, and a year is a range of dates that the source's scan takes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.dates import day_type, time_attributes
from tidemart.operators.dims import time_members
from tidemart.operators.enrich import enrich, normalise_feed
from tidemart.operators.facts import TIME_BUCKET, time_bucket
from tidemart.schemas import DIM_TIME

TIME = "time"
PRODUCT = "product"
STORE = "store"
SUPPLIER = "supplier"
ALL_DIMS = (TIME, PRODUCT, STORE, SUPPLIER)


def _with_time(rows: DataFrame, days: DataFrame, year: int | None, on: list[str]) -> DataFrame:
    """Rows joined to the time dimension (its date is the report's date)."""
    if year is not None:
        days = days.where(F.col("year") == F.lit(year))
    return rows.drop("order_date").join(days, on, "inner").withColumn("day_type", day_type("order_date"))


class FeedStar:
    def __init__(self, feed: DataFrame, customers: DataFrame, products: DataFrame,
                 suppliers: DataFrame | None = None, dated: Callable[[int | None], DataFrame] | None = None):
        """``dated``: the feed, or its rows of a year, if every time id is derived from the row's date."""
        self.feed = normalise_feed(feed)
        self.dated = dated
        self.customers = customers
        self.products = products
        self.suppliers = suppliers

    @classmethod
    def from_fixtures(cls, sources) -> "FeedStar":
        return cls(sources.feed(), sources.customers(), sources.products(), sources.suppliers(),
                   dated=lambda year: sources.feed(year=year))

    @classmethod
    def from_frames(cls, feed: DataFrame, customers: DataFrame, products: DataFrame,
                    suppliers: DataFrame | None = None) -> "FeedStar":
        """A star over an in-hand feed."""
        return cls(feed, customers, products, suppliers)

    def sales(self, year: int | None = None, dims: Iterable[str] = ALL_DIMS) -> DataFrame:
        timed = TIME in set(dims) or year is not None
        if timed and self.dated is not None:
            rows = enrich(normalise_feed(self.dated(year)), self.customers, self.products, self.suppliers)
            parts = time_attributes("order_date")
            days = {c: parts[c] for c in ("day", "week", "month", "year", "quarter")}
            return rows.where("order_date is not null").withColumns(days).withColumn("day_type", day_type("order_date"))
        rows = enrich(self.feed, self.customers, self.products, self.suppliers)
        if timed:
            rows = _with_time(rows, time_members(self.feed), year, ["time_id"])
        return rows


class WarehouseStar:
    def __init__(self, fact: DataFrame, time: DataFrame, product: DataFrame,
                 store: DataFrame, supplier: DataFrame, customer: DataFrame | None = None):
        self.fact = fact
        self.time = time
        self.product = product
        self.store = store
        self.supplier = supplier
        self.customer = customer

    @classmethod
    def read(cls, spark, root: str) -> "WarehouseStar":
        """The star of a loaded warehouse (every table holds rows)."""
        r = root.rstrip("/")
        return cls(
            fact=spark.read.parquet(f"{r}/sales"),
            time=spark.read.parquet(f"{r}/dim_time"),
            product=spark.read.parquet(f"{r}/dim_product"),
            store=spark.read.parquet(f"{r}/dim_store"),
            supplier=spark.read.parquet(f"{r}/dim_supplier"),
            customer=spark.read.parquet(f"{r}/dim_customer"),
        )

    def sales(self, year: int | None = None, dims: Iterable[str] = ALL_DIMS) -> DataFrame:
        dims = set(dims)
        fact = self.fact
        if TIME in dims or year is not None:
            days = self.time.select(*DIM_TIME).withColumn(TIME_BUCKET, time_bucket())
            fact = _with_time(fact, days, year, ["time_id", TIME_BUCKET])
        fact = fact.drop(TIME_BUCKET)  # storage only, no fact attribute
        if PRODUCT in dims:
            fact = fact.join(self.product.drop("product_price"), "product_id", "inner")
        if STORE in dims:
            fact = fact.join(self.store, "store_id", "inner")
        if SUPPLIER in dims:
            fact = fact.join(self.supplier, "supplier_id", "inner")
        return fact

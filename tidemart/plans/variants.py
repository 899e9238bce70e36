"""Report variants: what the report descriptions ask for where the
as-specified SQL computes something narrower."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions.dates import month_index, season_of_month
from tidemart.functions.measures import above_factor_of_mean, as_double, percent_change, ratio
from tidemart.operators.affinity import top_pairs
from tidemart.plans.reports import DEFAULT_YEAR, TOP_K, _monthly_store_supplier
from tidemart.plans.star import PRODUCT, STORE, SUPPLIER, TIME


def v1_top5_per_month_daytype(star, year: int = DEFAULT_YEAR, k: int = TOP_K) -> DataFrame:
    """Top k product names *within* each (month, day type).

    ``row_number() <= k`` lets Spark insert a partial per-partition group
    limit before the shuffle (WindowGroupLimit), so a window group never
    receives more than k rows per upstream partition, however many products
    a month holds."""
    s = star.sales(year=year, dims=(TIME, PRODUCT))
    agg = s.groupBy("month", "day_type", "product_name").agg(F.sum("total_sales").alias("_rev"))
    w = Window.partitionBy("month", "day_type").orderBy(F.desc("_rev"), "product_name")
    return (
        agg.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("month", "day_type", "product_name", as_double("_rev").alias("total_revenue"),
                F.col("rank").cast("int").alias("rank"))
    )


def v2_store_qoq_growth(star, year: int = DEFAULT_YEAR) -> DataFrame:
    """Quarter-over-quarter revenue growth per store within one year; the
    previous value is the previous *calendar* quarter (NULL after a gap)."""
    s = star.sales(year=year, dims=(TIME,))
    q = s.groupBy("store_id", "year", "quarter").agg(F.sum("total_sales").alias("_rev"))
    w = Window.partitionBy("store_id").orderBy("quarter")
    prev_q = F.lag("quarter", 1).over(w)
    prev = F.when(prev_q == F.col("quarter") - 1, F.lag("_rev", 1).over(w))
    out = q.select("store_id", "year", "quarter", as_double("_rev").alias("revenue"),
                   as_double(prev).alias("previous_revenue"))
    return out.withColumn("growth_pct", percent_change("revenue", "previous_revenue"))


def v3_category_contribution(star) -> DataFrame:
    s = star.sales(dims=(PRODUCT, SUPPLIER, STORE))
    return s.groupBy("store_name", "supplier_name", "category").agg(
        as_double(F.sum("total_sales")).alias("total_sales"))


def v4_product_season_region(star) -> DataFrame:
    s = star.sales(dims=(TIME, PRODUCT, STORE)).withColumn("season", season_of_month("month"))
    return s.groupBy("product_name", "season", "region").agg(
        as_double(F.sum("total_sales")).alias("total_sales"))


def v5_volatility_calendar(star) -> DataFrame:
    """As q5, but against the previous *calendar* month: after a month
    without sales the previous revenue is NULL."""
    monthly = _monthly_store_supplier(star).withColumn("_ym", month_index("year", "month"))
    w = Window.partitionBy("store_id", "supplier_id").orderBy("_ym")
    prev = F.when(F.lag("_ym", 1).over(w) == F.col("_ym") - 1, F.lag("_rev", 1).over(w))
    out = monthly.select("year", "month", "store_id", "supplier_id",
                         as_double("_rev").alias("current_revenue"),
                         as_double(prev).alias("previous_revenue"))
    return out.withColumn("percentage_change", percent_change("current_revenue", "previous_revenue"))


def v6_affinity_distinct(star, k: int = TOP_K) -> DataFrame:
    """Top k pairs counted once per order (repeated lines ignored)."""
    return top_pairs(star.sales(dims=()), k=k, distinct_per_basket=True)


def v9_daily_spikes(star) -> DataFrame:
    """Per product and day: the day's sales, the product's mean over its
    sales days, and whether the day exceeds twice that mean.  The window is
    keyed by product after the daily aggregation, so a window group holds
    at most one row per calendar day."""
    s = star.sales(dims=(TIME,))
    daily = s.groupBy("product_id", "order_date").agg(F.sum("total_sales").alias("_day"))
    w = Window.partitionBy("product_id")
    with_mean = daily.select(
        "product_id", "order_date", "_day",
        F.sum("_day").over(w).alias("_tot"), F.count(F.lit(1)).over(w).alias("_n"))
    return with_mean.select(
        "product_id", "order_date",
        as_double("_day").alias("daily_sales"),
        ratio("_tot", "_n").alias("avg_daily_sales"),
        above_factor_of_mean("_day", "_tot", "_n").alias("outlier"),
    )


def v10_region_store_quarter(star) -> DataFrame:
    s = star.sales(dims=(TIME, STORE))
    return s.groupBy("region", "store_name", "year", "quarter").agg(
        as_double(F.sum("total_sales")).alias("total_sales")
    ).orderBy("region", "store_name", "year", "quarter")

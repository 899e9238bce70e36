"""The ten sales reports, as specified (column names lower-case).

Every report takes a star (plans.star) and returns a lazy DataFrame.
Aggregates are exact decimals cast to DOUBLE last; integer sums are BIGINT.
Global top-k reports break ties on their group keys so that the result is
deterministic; ordered reports keep their ORDER BY.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.functions.dates import season_of_month
from tidemart.functions.measures import above_factor_of_mean, as_double, percent_change, ratio
from tidemart.operators.affinity import top_pairs, top_pairs_pruned
from tidemart.plans.star import PRODUCT, STORE, SUPPLIER, TIME

# Fixture dates span 1995-2001; the reports' fixed year is a parameter.
DEFAULT_YEAR = 1998
TOP_K = 5


def q1_top_products_daytype(star, year: int = DEFAULT_YEAR, k: int = TOP_K) -> DataFrame:
    """Top k (month, weekday/weekend, product name) groups by revenue in one
    year - one global top k, not k per group."""
    s = star.sales(year=year, dims=(TIME, PRODUCT))
    agg = s.groupBy("month", "day_type", "product_name").agg(F.sum("total_sales").alias("_rev"))
    return (
        agg.orderBy(F.desc("_rev"), "month", "day_type", "product_name")
        .limit(k)
        .select("month", "day_type", "product_name", as_double("_rev").alias("total_revenue"))
    )


def q2_store_quarter_revenue(star, year: int = DEFAULT_YEAR) -> DataFrame:
    s = star.sales(year=year, dims=(TIME,))
    return s.groupBy("store_id", "quarter", "year").agg(F.sum("total_sales").alias("_rev")).select(
        "store_id", F.col("quarter").alias("quarters"), "year", as_double("_rev").alias("totalrevenue"))


def q3_store_supplier_product(star) -> DataFrame:
    """Contribution by store, supplier and product *names* (ids sharing a
    name are merged)."""
    s = star.sales(dims=(PRODUCT, SUPPLIER, STORE))
    return s.groupBy("store_name", "supplier_name", "product_name").agg(
        as_double(F.sum("total_sales")).alias("totalsalescontribution"))


def q4_product_season(star) -> DataFrame:
    s = star.sales(dims=(TIME, PRODUCT)).withColumn("season", season_of_month("month"))
    return s.groupBy("product_name", "season").agg(as_double(F.sum("total_sales")).alias("total_sales"))


def _monthly_store_supplier(star) -> DataFrame:
    s = star.sales(dims=(TIME,))
    return s.groupBy("year", "month", "store_id", "supplier_id").agg(
        F.sum("total_sales").alias("_rev"))


def q5_volatility(star) -> DataFrame:
    """Month-over-month change per (store, supplier); the previous row is the
    previous month *with sales* (see v5 for calendar months).  The window is
    partitioned by the pair after aggregation: at most one row per month."""
    monthly = _monthly_store_supplier(star)
    w = Window.partitionBy("store_id", "supplier_id").orderBy("year", "month")
    with_prev = monthly.select(
        "year", "month", "store_id", "supplier_id",
        as_double("_rev").alias("current_revenue"),
        as_double(F.lag("_rev", 1).over(w)).alias("previous_revenue"))
    return with_prev.withColumn(
        "percentage_change", percent_change("current_revenue", "previous_revenue")
    ).orderBy("store_id", "supplier_id", "year", "month")


def q6_affinity(star, k: int = TOP_K) -> DataFrame:
    """Top k co-purchased product pairs, counting line pairs."""
    return top_pairs(star.sales(dims=()), k=k)


def q6_affinity_pruned(star, k: int = TOP_K) -> DataFrame:
    """Q6 by thresholds: only items that can be in a top pair are paired."""
    return top_pairs_pruned(star.sales(dims=()), k=k).top


def q7_rollup(star) -> DataFrame:
    """ROLLUP(store, supplier, product, year); ``gid`` = grouping_id tells a
    subtotal row from a NULL data value."""
    s = star.sales(dims=(TIME,))
    return (
        s.rollup("store_id", "supplier_id", "product_id", "year")
        .agg(F.sum("total_sales").alias("_rev"), F.grouping_id().cast("int").alias("gid"))
        .select("store_id", "supplier_id", "product_id", "year",
                as_double("_rev").alias("total_revenue"), "gid")
        .orderBy("store_id", "supplier_id", "product_id", "year", "gid")
    )


def q8_half_year(star) -> DataFrame:
    s = star.sales(dims=(TIME, PRODUCT))
    h1 = F.col("month").between(1, 6)
    h2 = F.col("month").between(7, 12)
    zero_money = F.lit(0).cast("decimal(10,2)")
    return (
        s.groupBy("product_id", "year")
        .agg(
            as_double(F.sum(F.when(h1, F.col("total_sales")).otherwise(zero_money))).alias("first_half_revenue"),
            as_double(F.sum(F.when(h2, F.col("total_sales")).otherwise(zero_money))).alias("second_half_revenue"),
            as_double(F.sum("total_sales")).alias("total_revenue"),
            F.sum(F.when(h1, F.col("quantity")).otherwise(0)).cast("long").alias("first_half_quantity"),
            F.sum(F.when(h2, F.col("quantity")).otherwise(0)).cast("long").alias("second_half_quantity"),
            F.sum("quantity").cast("long").alias("total_quantity"),
        )
        .orderBy("product_id", "year")
    )


def q9_outliers(star) -> DataFrame:
    """Per product: the largest single sale, the mean sale and whether any
    sale exceeds twice the mean.  "Any row above 2 x mean" is the same as
    "max above 2 x mean", and max * n > 2 * sum decides it exactly, so this
    is one aggregation pass - no join back to a per-product average."""
    s = star.sales(dims=())
    agg = s.groupBy("product_id").agg(
        F.max("total_sales").alias("_max"), F.sum("total_sales").alias("_sum"),
        F.count(F.lit(1)).alias("_n"))
    return agg.select(
        "product_id",
        as_double("_max").alias("daily_sales"),
        ratio("_sum", "_n").alias("avg_daily_sales"),
        above_factor_of_mean("_max", "_sum", "_n").alias("outliers"),
    ).orderBy("product_id")


REGION_STORE_VIEW = "region_store_quarterly_sales"


def region_store_quarterly(star) -> DataFrame:
    s = star.sales(dims=(TIME, STORE))
    return s.groupBy("store_name", "year", "quarter").agg(
        as_double(F.sum("total_sales")).alias("total_sales"))


def register_region_store_view(spark: SparkSession, star, name: str = REGION_STORE_VIEW) -> str:
    """The reusable quarterly view (lazy: it re-reads the star on every use).
    Order is applied on read, not stored."""
    region_store_quarterly(star).createOrReplaceTempView(name)
    return name


def refresh_region_store_table(star, path: str) -> None:
    """The materialized form of the quarterly view, written in full after each
    load.  ``path`` is a fresh folder: an overwrite would delete the old copy
    before the new one is complete, so readers are switched to the new path."""
    region_store_quarterly(star).write.parquet(path)


def q10_store_quarter_view(spark: SparkSession, star) -> DataFrame:
    name = register_region_store_view(spark, star)
    return spark.table(name).orderBy("store_name", "year", "quarter")

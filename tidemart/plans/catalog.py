"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the whole driver tables of ``sf_dir`` (the reject and
data-quality scenarios use reduced *master* catalogues, never a reduced
feed).  Queries that write (loads, streams) write below the shared
checkpoint folder and return the read-back result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.dates import time_id_of
from tidemart.functions.measures import as_double
from tidemart.operators.dims import DIMENSIONS, dimension_members, time_members
from tidemart.operators.enrich import enrich, enrich_rejects, normalise_feed
from tidemart.operators.quality import (
    dependency_violations,
    duplicate_keys,
    key_report,
    null_counts,
    one_per_key,
    orphan_report,
)
from tidemart.plans import reports as R
from tidemart.plans import variants as V
from tidemart.plans.bucketed import store_bucketed
from tidemart.plans.load import load_warehouse, new_warehouse_root
from tidemart.plans.quarterly import QuarterlyView
from tidemart.plans.star import FeedStar, WarehouseStar
from tidemart.schemas import CUSTOMERS_CSV, FACT_COLUMNS, FACT_KEY, TRANSACTIONS_CSV
from tidemart.session import app_id, apply_sql_defaults, materialize, shared_scratch_dir, size_shuffles
from tidemart.sources.counts import source_counts
from tidemart.sources.csv_feeds import (
    read_checked_csv,
    read_customers_csv,
    read_products_csv,
    read_transactions_csv,
    write_csv,
)
from tidemart.sources.fixtures import FixtureSources, fingerprint, star_bytes, table
from tidemart.sources.keyed import read_master_ranges
from tidemart.sources.segments import segment_stream
from tidemart.streaming import manifest
from tidemart.streaming.enrich_stream import (
    ROWS_PER_SEGMENT,
    StreamedWarehouse,
    run_to_completion,
    stage_feed_files,
    start_enrichment,
)

#: Rows of a key range of a master.
MASTER_RANGE = 5_000

Query = Callable[[SparkSession, str], DataFrame]


def feed_star(spark: SparkSession, sf_dir: str, restricted: bool = False) -> FeedStar:
    return FeedStar.from_fixtures(_sources(spark, sf_dir, restricted=restricted))


def _report(fn, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(feed_star(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    return run


def _q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.q10_store_quarter_view(spark, feed_star(spark, sf_dir))


def report_queries() -> dict[str, Query]:
    return {
        "q1_top_products_daytype": _report(R.q1_top_products_daytype),
        "q2_store_quarter_revenue": _report(R.q2_store_quarter_revenue),
        "q3_store_supplier_product": _report(R.q3_store_supplier_product),
        "q4_product_season": _report(R.q4_product_season),
        "q5_volatility": _report(R.q5_volatility),
        "q6_affinity": _report(R.q6_affinity),
        "q6_affinity_pruned": _report(R.q6_affinity_pruned),
        "q7_rollup": _report(R.q7_rollup),
        "q8_half_year": _report(R.q8_half_year),
        "q9_outliers": _report(R.q9_outliers),
        "q10_store_quarter_view": _q10,
    }


def variant_queries() -> dict[str, Query]:
    return {
        "v1_top5_per_month_daytype": _report(V.v1_top5_per_month_daytype),
        "v2_store_qoq_growth": _report(V.v2_store_qoq_growth),
        "v3_category_contribution": _report(V.v3_category_contribution),
        "v4_product_season_region": _report(V.v4_product_season_region),
        "v5_volatility_calendar": _report(V.v5_volatility_calendar),
        "v6_affinity_distinct": _report(V.v6_affinity_distinct),
        "v9_daily_spikes": _report(V.v9_daily_spikes),
        "v10_region_store_quarter": _report(V.v10_region_store_quarter),
    }


# ---------------------------------------------------------------- sources

def _sources(spark: SparkSession, sf_dir: str, restricted: bool = False) -> FixtureSources:
    apply_sql_defaults(spark)
    size_shuffles(spark, star_bytes(spark, sf_dir))
    return FixtureSources(spark, sf_dir, restricted=restricted)


def q_src_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole transaction feed in the enrichment layout."""
    return normalise_feed(_sources(spark, sf_dir).feed())


def q_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count per source table."""
    src = _sources(spark, sf_dir)
    return source_counts({  # a feed row is a line; lines without order are dq_fk's business
        "transactions": table(spark, sf_dir, "lineitem"), "products": src.products(), "customers": src.customers()})


def q_src_masters_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both masters read by key ranges, one task each."""
    _sources(spark, sf_dir)
    path = sf_dir.rstrip("/")
    customers = read_master_ranges(spark, f"{path}/customer.parquet", "c_custkey", ["c_custkey", "c_name"], MASTER_RANGE)
    products = read_master_ranges(spark, f"{path}/part.parquet", "p_partkey", ["p_partkey", "p_name", "p_retailprice"], MASTER_RANGE)
    return customers.select(
        F.lit("customers").alias("master"), F.col("c_custkey").alias("key_value"), F.col("c_name").alias("name"), F.lit(None).cast("double").alias("price"),
    ).unionByName(products.select(
        F.lit("products").alias("master"), F.col("p_partkey").alias("key_value"), F.col("p_name").alias("name"), F.col("p_retailprice").cast("double").alias("price")))


def q_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as a CR LF CSV in the positional transactions
    layout, then loaded back through the CSV reader."""
    src = _sources(spark, sf_dir)
    path = shared_scratch_dir(spark, "transactions-csv")
    feed = normalise_feed(src.feed()).select(*[f.name for f in TRANSACTIONS_CSV.fields])
    write_csv(feed, path)
    return read_transactions_csv(spark, path)


def q_csv_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the part table written in the product-master CSV layout (price as
    text with a trailing ``$``, a comma inside the quoted name, empty
    supplier/store fields, CR LF), then loaded and cleaned."""
    _sources(spark, sf_dir)
    part = table(spark, sf_dir, "part")
    raw = part.select(
        F.col("p_partkey").alias("productID"),
        F.concat_ws(", ", "p_name", "p_brand").alias("productName"),
        F.concat(F.format_string("%.2f", F.col("p_retailprice")), F.lit("$")).alias("productPrice"),
        F.lit(None).cast("string").alias("supplierID"),
        F.lit(None).cast("string").alias("supplierName"),
        F.lit(None).cast("string").alias("storeID"),
        F.lit(None).cast("string").alias("storeName"),
    )
    path = shared_scratch_dir(spark, "products-csv")
    write_csv(raw, path)
    out = read_products_csv(spark, path)
    return out.withColumn("product_price", as_double("product_price")).drop("bad_price")


def q_csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table written in the customer-master CSV layout
    (customer_id, customer_name, gender; CR LF) and loaded back."""
    _sources(spark, sf_dir)
    raw = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("gender"))
    path = shared_scratch_dir(spark, "customers-csv")
    write_csv(raw, path)
    return read_customers_csv(spark, path)


def q_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer master as a CSV in which every seventh row lacks a field, every eleventh has one more,
    every thirteenth an id that is no number and every fifth name has a line break; good rows and quarantine."""
    _sources(spark, sf_dir)
    customer = table(spark, sf_dir, "customer")
    every = lambda n: F.col("c_custkey") % n == 0
    name = F.concat(F.lit('"'), F.when(every(5), F.concat("c_name", F.lit("\n"), "c_mktsegment")).otherwise(F.col("c_name")), F.lit('"'))
    line = F.concat_ws(",", F.when(every(13), F.concat(F.lit("x"), "c_custkey")).otherwise(F.col("c_custkey").cast("string")), name,
                       F.when(every(7), None).otherwise(F.col("c_mktsegment")), F.when(every(11), F.lit("more")))
    path = shared_scratch_dir(spark, "customers-csv")
    customer.select(line.alias("value")).write.text(path)
    read = read_checked_csv(spark, path, CUSTOMERS_CSV, multi_line=True, header="false")
    good = read.rows.select(F.lit("row").alias("kind"), "customer_id", "customer_name", "gender", F.lit(None).cast("string").alias("text"))
    return good.unionByName(read.quarantine.select(F.lit("quarantine").alias("kind"), "text"), allowMissingColumns=True)


def q_src_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: one feed row per (order_id, line_no), the last one in arrival
    order (here the remaining fact-key columns) winning."""
    feed = materialize(normalise_feed(_sources(spark, sf_dir).feed()), "feed")  # read by three branches
    return one_per_key(feed, ["order_id", "line_no"], ["product_id", "supplier_id", "quantity"])


def q_csv_enrich_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product master that carries its supplier and store (the part's
    smallest supplier), written as CSV with all seven columns, loaded, and the
    feed enriched against it (the feed's own supplier is not used)."""
    src = _sources(spark, sf_dir)
    carried = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(F.min("l_suppkey").alias("supplier_id"))
    products = src.products().join(carried, "product_id").join(src.suppliers(), "supplier_id")
    path = shared_scratch_dir(spark, "products-csv")
    write_csv(products.select(
        F.col("product_id").alias("productID"), F.col("product_name").alias("productName"),
        F.concat(F.col("product_price").cast("string"), F.lit("$")).alias("productPrice"),
        F.col("supplier_id").alias("supplierID"), F.col("supplier_name").alias("supplierName"),
        F.col("store_id").alias("storeID"), F.col("store_name").alias("storeName")), path)
    rows = enrich(src.feed(), src.customers(), read_products_csv(spark, path))
    return _money_to_double(rows.select(*FACT_COLUMNS, "product_name", "supplier_name", "store_name"))


# ------------------------------------------------------------- enrichment

def _money_to_double(df: DataFrame) -> DataFrame:
    return df.select(*[as_double(c).alias(c) if c in ("total_sales", "product_price") else F.col(c)
                       for c in df.columns])


def q_enrich_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with the attributes of customer, product, supplier and store."""
    src = _sources(spark, sf_dir)
    rows = enrich(src.feed(), src.customers(), src.products(), src.suppliers())
    return _money_to_double(rows.select(
        *FACT_COLUMNS, "customer_name", "product_name", "product_price", "supplier_name", "store_name"))


def q_enrich_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E4, as ``enrich_sales``."""
    src = _sources(spark, sf_dir)
    rows = enrich(src.feed(), src.customers(), src.products(), src.suppliers())
    return _money_to_double(rows.select(
        *FACT_COLUMNS, "customer_name", "product_name", "product_price", "supplier_name", "store_name"))


def q_enrich_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: with the reduced catalogues, the feed rows without a match, missing side(s) flagged."""
    src = _sources(spark, sf_dir, restricted=True)
    return enrich_rejects(src.feed(), src.customers(), src.products(), src.suppliers())


def _dim_query(name: str) -> Query:
    key, attrs = DIMENSIONS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = _sources(spark, sf_dir)
        matched = enrich(src.feed(), src.customers(), src.products(), src.suppliers())
        kept = [c for c in dict.fromkeys((key, *attrs, *FACT_KEY)) if c in matched.columns]
        rows = materialize(matched.select(*kept), "matched")  # read by the branches of first_wins
        return _money_to_double(dimension_members(rows, key, attrs, None, FACT_KEY))

    run.__name__ = name
    return run


def q_dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time days from every feed row (matched or not)."""
    return time_members(normalise_feed(_sources(spark, sf_dir).feed()))


def _load_three_times(spark: SparkSession, sf_dir: str) -> WarehouseStar:
    src = _sources(spark, sf_dir)
    root = new_warehouse_root(spark)
    for feed in (src.feed(before=HALF), src.feed(), src.feed()):
        star = load_warehouse(spark, root, feed, src.customers(), src.products(), src.suppliers())
    return star


def q_load_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads into one fresh warehouse - the orders before 1998,
    then the whole feed, then the whole feed again - and the fact table read
    back.  Overlap and repetition must add nothing twice."""
    return _money_to_double(_load_three_times(spark, sf_dir).fact.select(*FACT_COLUMNS))


def q_load_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that holds every row twice, then the feed with all dates
    moved by more than a year.  One fact for each key, as first loaded."""
    src = _sources(spark, sf_dir)
    root = new_warehouse_root(spark)
    feed = normalise_feed(src.feed())
    moved = feed.withColumn("order_date", F.date_add("order_date", 400)).withColumn("time_id", time_id_of("order_date"))
    for rows in (feed.unionAll(feed), moved):
        star = load_warehouse(spark, root, rows, src.customers(), src.products(), src.suppliers())
    return _money_to_double(star.fact.select(*FACT_COLUMNS))


def q_load_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load with the reduced catalogues counted while it staged its rows."""
    src = _sources(spark, sf_dir, restricted=True)
    root = new_warehouse_root(spark)
    load_warehouse(spark, root, src.feed(), src.customers(), src.products(), src.suppliers())
    return spark.read.parquet(f"{root}/load_reports").drop("bad_amount")


def q_view_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: the quarterly table after three overlapping loads (before 1997, before 1998, all), kept up to date
    by the sums of each load."""
    src = _sources(spark, sf_dir)
    root = new_warehouse_root(spark)
    view = QuarterlyView(spark, root)
    for feed in (src.feed(before=dt.date(1997, 1, 1)), src.feed(before=HALF), src.feed()):
        load_warehouse(spark, root, feed, src.customers(), src.products(), src.suppliers(), view=view)
    return view.read()


def _loaded_dim_query(name: str) -> Query:
    """A dimension after a load of half the feed, of all of it, and again."""
    attr = name.removeprefix("dim_")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = _once(spark, sf_dir, "three-loads", lambda: _load_three_times(spark, sf_dir))
        return _money_to_double(getattr(star, attr))

    run.__name__ = f"load_{name}"
    return run


# ---------------------------------------------------------- data quality

def q_dq_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_id, line_no) values held by more than one feed line."""
    return duplicate_keys(normalise_feed(_sources(spark, sf_dir).feed()), ["order_id", "line_no"])


def q_dq_pk_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 on the masters: duplicate customer, product and supplier ids."""
    src = _sources(spark, sf_dir)
    return key_report({
        "customers": (src.customers(), "customer_id"),
        "products": (src.products(), "product_id"),
        "suppliers": (src.suppliers(), "supplier_id"),
    })


def q_dq_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed keys without a master row (reduced catalogues)."""
    src = _sources(spark, sf_dir, restricted=True)
    feed = normalise_feed(src.feed())
    return orphan_report(feed, [
        ("customer_id", src.customers(), "customer_id"),
        ("product_id", src.products(), "product_id"),
        ("supplier_id", src.suppliers(), "supplier_id"),
    ])


def q_dq_wh_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 on the six tables of the month-grain warehouse: the time id of a
    month holds many days and an order many facts; the other keys are unique."""
    star = month_warehouse(spark, sf_dir)
    return key_report({
        "dim_customer": (star.customer, "customer_id"), "dim_product": (star.product, "product_id"),
        "dim_store": (star.store, "store_id"), "dim_supplier": (star.supplier, "supplier_id"),
        "dim_time": (star.time, "time_id"), "sales": (star.fact, "order_id"),
    })


def q_dq_wh_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 on all five references of the facts, against the dimensions of a
    warehouse that holds the orders before 1998 only."""
    fact, half = loaded_warehouse(spark, sf_dir).fact, half_warehouse(spark, sf_dir)
    return orphan_report(fact, [
        ("customer_id", half.customer, "customer_id"), ("product_id", half.product, "product_id"),
        ("store_id", half.store, "store_id"), ("supplier_id", half.supplier, "supplier_id"),
        ("time_id", half.time, "time_id"),
    ])


def q_dq_time_fanout_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 on month-grain time ids."""
    return dependency_violations(time_members(month_feed(spark, sf_dir)), "time_id", "order_date")


def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL counts of the feed's key and measure columns."""
    feed = normalise_feed(_sources(spark, sf_dir).feed())
    return null_counts(feed, ["order_id", "product_id", "customer_id", "order_date", "quantity", "time_id"])


def q_dq_time_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: time ids carrying more than one date in the time dimension."""
    days = time_members(normalise_feed(_sources(spark, sf_dir).feed()))
    return dependency_violations(days, "time_id", "order_date")


def q_dq_dim_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products sold under more than one supplier (a product-level
    supplier attribute would conflict for these keys)."""
    feed = normalise_feed(_sources(spark, sf_dir).feed())
    return dependency_violations(feed, "product_id", "supplier_id")


# ------------------------------------------------------------- streaming

def _stream(spark: SparkSession, sf_dir: str, restricted: bool) -> StreamedWarehouse:
    src = _sources(spark, sf_dir, restricted=restricted)
    feed = normalise_feed(src.feed())
    landing = shared_scratch_dir(spark, "feed-landing")
    stage_feed_files(feed, landing)
    out_root = shared_scratch_dir(spark, "stream-warehouse")
    masters = (src.customers(), src.products(), src.suppliers())
    query = start_enrichment(
        spark, segment_stream(spark, landing, feed.schema, ROWS_PER_SEGMENT, out_root), *masters,
        out_root, checkpoint=f"{out_root}/_checkpoint")
    run_to_completion(query)
    return StreamedWarehouse(spark, out_root, *masters, feed=feed.schema)


def _streamed(spark: SparkSession, sf_dir: str, restricted: bool = False) -> StreamedWarehouse:
    """The warehouse that the stream has loaded."""
    return _once(spark, sf_dir, f"stream-{restricted}", lambda: _stream(spark, sf_dir, restricted))


def q_stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1-ST3: the feed enriched as a stream of row segments, facts read back."""
    return _money_to_double(_streamed(spark, sf_dir).sales().select(*FACT_COLUMNS))


def q_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 in the stream: with the reduced catalogues, every feed row that has no fact."""
    rejects = _streamed(spark, sf_dir, restricted=True).rejects()
    return rejects.withColumnRenamed("source_time_id", "time_id").drop("batch_id", "bad_amount")


def q_stream_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, ST3: the commit manifest - every batch with its rows, and all rows up to it."""
    return manifest.commits(spark, _streamed(spark, sf_dir).root)


def _stream_dim_query(name: str) -> Query:
    """ST4, E7-E11: a dimension grown batch by batch."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _money_to_double(_streamed(spark, sf_dir).dimension(name))
    run.__name__ = f"stream_{name}"
    return run


# ------------------------------------------------- reports on the warehouse

HALF = dt.date(1998, 1, 1)

# what is loaded once per application and input: written tables in the shared
# checkpoint folder that several queries below read; changed files are loaded anew
_LOADED: dict[tuple[str, str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, load: Callable[[], object]):
    key = (app_id(spark), sf_dir, fingerprint(spark, sf_dir), what)
    if key not in _LOADED:
        _LOADED[key] = load()
    return _LOADED[key]


def _warehouse(spark: SparkSession, sf_dir: str, what: str, feed: Callable[[], DataFrame]) -> WarehouseStar:
    src = _sources(spark, sf_dir)
    return _once(spark, sf_dir, what, lambda: load_warehouse(
        spark, new_warehouse_root(spark), feed(), src.customers(), src.products(), src.suppliers()))


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> WarehouseStar:
    return _warehouse(spark, sf_dir, "warehouse", lambda: _sources(spark, sf_dir).feed())


def half_warehouse(spark: SparkSession, sf_dir: str) -> WarehouseStar:
    return _warehouse(spark, sf_dir, "half", lambda: _sources(spark, sf_dir).feed(before=HALF))


def month_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with one time id for each month, so an id has many dates."""
    feed = normalise_feed(_sources(spark, sf_dir).feed())
    return feed.withColumn("time_id", (F.year("order_date") * 100 + F.month("order_date")).cast("int"))


def month_warehouse(spark: SparkSession, sf_dir: str) -> WarehouseStar:
    return _warehouse(spark, sf_dir, "month", lambda: month_feed(spark, sf_dir))


def _month_report(fn, loaded: bool) -> Query:
    """A report where the join to the time dimension multiplies facts."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if loaded:
            return fn(month_warehouse(spark, sf_dir))
        src = _sources(spark, sf_dir)
        return fn(FeedStar(month_feed(spark, sf_dir), src.customers(), src.products(), src.suppliers()))
    run.__name__ = f"month_{fn.__name__}"
    return run


def bucketed_warehouse(spark: SparkSession, sf_dir: str) -> WarehouseStar:
    return _once(spark, sf_dir, "bucketed", lambda: store_bucketed(
        spark, loaded_warehouse(spark, sf_dir), shared_scratch_dir(spark, "bucketed")))


def _bucketed_report(fn) -> Query:
    """A report on facts and products that are stored in the same buckets."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(bucketed_warehouse(spark, sf_dir))
    run.__name__ = f"bucketed_{fn.__name__}"
    return run


def _warehouse_report(fn, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(loaded_warehouse(spark, sf_dir), **kw)
    run.__name__ = f"wh_{fn.__name__}"
    return run


def _wh_q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.q10_store_quarter_view(spark, loaded_warehouse(spark, sf_dir))


def _wh_q10_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3's materialized form: the quarterly view written as a table next to
    the loaded warehouse, read back in view order."""
    path = shared_scratch_dir(spark, "region-store-quarterly")
    R.refresh_region_store_table(loaded_warehouse(spark, sf_dir), path)
    return spark.read.parquet(path).orderBy("store_name", "year", "quarter")


BUCKETED = ("q1_top_products_daytype", "q4_product_season", "q8_half_year", "q9_outliers")


def warehouse_queries() -> dict[str, Query]:
    """All reports over the loaded star schema: the fact joined to the
    dimensions a report needs, no fact shuffle but the report's own."""
    found = {f"wh_{name}": _warehouse_report(fn) for name, fn in (
        *((n, getattr(R, n)) for n in report_queries() if n != "q10_store_quarter_view"),
        *((n, getattr(V, n)) for n in variant_queries()),
    )}
    return found | {
        "wh_q10_store_quarter_view": _wh_q10,
        "wh_q10_materialized": _wh_q10_materialized,
        "month_q2_feed": _month_report(R.q2_store_quarter_revenue, loaded=False),
        "month_q2_wh": _month_report(R.q2_store_quarter_revenue, loaded=True),
        "month_q5_feed": _month_report(R.q5_volatility, loaded=False),
        "month_q5_wh": _month_report(R.q5_volatility, loaded=True),
        **{f"bucketed_{n}": _bucketed_report(getattr(R, n)) for n in BUCKETED},
    }


def load_queries() -> dict[str, Query]:
    return {
        "src_transactions": q_src_transactions,
        "source_counts": q_source_counts,
        "src_masters_ranges": q_src_masters_ranges,
        "csv_load": q_csv_load,
        "csv_products": q_csv_products,
        "csv_quarantine": q_csv_quarantine,
        "csv_customers": q_csv_customers,
        "csv_enrich_products": q_csv_enrich_products,
        "src_dedup": q_src_dedup,
        "enrich_all": q_enrich_all,
        "enrich_sales": q_enrich_sales,
        "enrich_rejects": q_enrich_rejects,
        "dim_customer": _dim_query("dim_customer"),
        "dim_product": _dim_query("dim_product"),
        "dim_store": _dim_query("dim_store"),
        "dim_supplier": _dim_query("dim_supplier"),
        "dim_time": q_dim_time,
        "load_sales": q_load_sales,
        "load_doubled": q_load_doubled,
        "load_checks": q_load_checks,
        "view_quarterly": q_view_quarterly,
        **{f"load_{n}": _loaded_dim_query(n) for n in (*DIMENSIONS, "dim_time")},
        "dq_pk": q_dq_pk,
        "dq_pk_masters": q_dq_pk_masters,
        "dq_wh_pk": q_dq_wh_pk,
        "dq_fk": q_dq_fk,
        "dq_wh_fk": q_dq_wh_fk,
        "dq_not_null": q_dq_not_null,
        "dq_time_fanout": q_dq_time_fanout,
        "dq_time_fanout_month": q_dq_time_fanout_month,
        "dq_dim_conflicts": q_dq_dim_conflicts,
        "stream_enrich": q_stream_enrich,
        "stream_rejects": q_stream_rejects,
        "stream_dims": _stream_dim_query("dim_product"),
        **{f"stream_{n}": _stream_dim_query(n) for n in (*DIMENSIONS, "dim_time") if n != "dim_product"},
        "stream_segments": q_stream_segments,
    }


def shared_loads() -> list[tuple[str, tuple[str, ...], Callable[[SparkSession, str], object]]]:
    """(name, prefixes of the queries that read it, load): what is loaded once and shared."""
    return [
        ("warehouse", ("wh_", "dq_wh_fk"), loaded_warehouse),
        ("bucketed", ("bucketed_",), bucketed_warehouse),
        ("half_warehouse", ("dq_wh_fk",), half_warehouse),
        ("month_warehouse", ("month_", "dq_wh_pk"), month_warehouse),
        ("three_loads", ("load_dim_",), lambda spark, d: _once(spark, d, "three-loads", lambda: _load_three_times(spark, d))),
        ("stream", ("stream_",), lambda spark, d: _once(spark, d, "stream-False", lambda: _stream(spark, d, False))),
        ("stream_restricted", ("stream_rejects",), lambda spark, d: _once(spark, d, "stream-True", lambda: _stream(spark, d, True))),
    ]


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(report_queries())
    out.update(variant_queries())
    out.update(load_queries())
    out.update(warehouse_queries())
    return out

"""Batch warehouse load: feed + masters -> star schema tables.

One load is:

1. enrich the whole feed once (left joins with match flags) and write the
   facts' and rejects' columns to a staging table in the shared checkpoint
   folder - the only pass over the feed; it also cuts the lineage, so a lost
   executor re-reads staged files instead of re-running the joins.  Names and
   other attributes of members are not staged: they are taken from the masters,
   once for each member (tidemart.operators.dims.carried_members);
2. append rejects, dimension members (insert-if-absent, first wins), new
   time days and new facts, each a set-based job over the staged table.

A load stops before it writes when a master repeats a key or when its rows are
beyond the limits given (tidemart.plans.checks), which are counted in the staging
pass.  Dimensions are
written before facts.  Every step is idempotent: running the same load again,
or an overlapping one, adds no row twice; equal rows within one load are one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.dims import DIMENSIONS, carried_members, dimension_members, time_members
from tidemart.operators.enrich import enrich_flagged, normalise_feed, require_unique_masters
from tidemart.operators.facts import (
    absent_facts,
    append_facts,
    append_members,
    delta_facts,
    fact_rows,
    read_if_exists,
    read_or_empty,
    write_facts,
)
from tidemart.plans.checks import LoadCheck, LoadLimits, LoadStopped, breaches
from tidemart.plans.quarterly import QuarterlyView
from tidemart.plans.star import WarehouseStar
from tidemart.schemas import FACT_COLUMNS, FACT_KEY
from tidemart.session import materialize, shared_scratch_dir

REJECT_COLUMNS = (
    "order_id", "line_no", "order_date", "product_id", "supplier_id", "quantity",
    "customer_id", "source_time_id", "missing_customer", "missing_product", "missing_supplier", "bad_amount",
)


Carriers = dict[str, tuple[DataFrame, str]]


def _carriers(flagged: DataFrame, customers: DataFrame, products: DataFrame, suppliers: DataFrame | None) -> Carriers:
    """The master, and its key, that carries all attributes of a dimension (as ``enrich_flagged`` reads them);
    a dimension whose attributes come from several masters has none."""
    other = (products, "product_id") if suppliers is None else (suppliers, "supplier_id")
    sides = {"dim_customer": (customers, "customer_id"), "dim_product": (products, "product_id"), "dim_store": other, "dim_supplier": other}
    wanted = {n: [key, *(a for a in attrs if a in flagged.columns)] for n, (key, attrs) in DIMENSIONS.items()}
    return {n: side for n, side in sides.items() if set(wanted[n]) <= set(side[0].columns)}


def _staged_columns(flagged: DataFrame, carriers: Carriers, fact_key: Sequence[str]) -> list[str]:
    """Columns of the facts, the rejects, the time days and the flags, and those that no single master carries."""
    rest = [c for n, (key, attrs) in DIMENSIONS.items() if n not in carriers for c in (key, *attrs)]
    used = {*FACT_COLUMNS, *REJECT_COLUMNS, *fact_key, "matched", *rest}
    return [c for c in flagged.columns if c in used]


def stage_enriched(spark: SparkSession, feed: DataFrame, customers: DataFrame, products: DataFrame,
                   suppliers: DataFrame | None = None, limits: LoadLimits | None = None,
                   fact_key: Sequence[str] = FACT_KEY) -> tuple[DataFrame, DataFrame, Carriers, dict[str, int]]:
    """The flagged rows, the part of them that is staged, the masters that carry the rest, and what was counted
    on the way (see tidemart.plans.checks)."""
    path, check = shared_scratch_dir(spark, "enrich-stage"), LoadCheck()
    flagged = check.rows(enrich_flagged(check.feed(normalise_feed(feed)), customers, products, suppliers))
    carriers = _carriers(flagged, customers, products, suppliers)
    kept = flagged.select(*_staged_columns(flagged, carriers, fact_key))
    kept.write.parquet(path)
    staged = spark.read.schema(kept.schema).parquet(path)
    report = check.report(staged)
    found = breaches(report, limits or LoadLimits())
    if found:
        raise LoadStopped(found, report, path)
    return flagged, staged, carriers, report


def load_warehouse(spark: SparkSession, root: str, feed: DataFrame, customers: DataFrame,
                   products: DataFrame, suppliers: DataFrame | None = None,
                   fact_key: Sequence[str] = FACT_KEY, limits: LoadLimits | None = None,
                   view: QuarterlyView | None = None) -> WarehouseStar:
    """Load a feed; with ``view`` the quarterly table is kept up to date as well."""
    root = root.rstrip("/")
    require_unique_masters(customers, products, suppliers)
    if view is not None:
        view.finish_pending()
    flagged, staged, carriers, report = stage_enriched(spark, feed, customers, products, suppliers, limits, fact_key)
    matched = staged.where(F.col("matched"))
    schemas = {"sales": fact_rows(matched).schema}

    rejects = staged.where(~F.col("matched")).select(*REJECT_COLUMNS)

    def rejects_job() -> None:
        path = f"{root}/rejects"
        existing = read_if_exists(spark, path, rejects.schema)
        append_members(spark, absent_facts(rejects, existing, fact_key), path)

    def dimension_job(name: str, key: str, attrs) -> Callable[[], None]:
        attrs_here = [a for a in attrs if a in flagged.columns]
        schemas[name] = flagged.select(key, *attrs_here).schema

        def run() -> None:
            path = f"{root}/{name}"
            existing = read_if_exists(spark, path, schemas[name])
            if name in carriers:
                members = carried_members(matched, *carriers[name], key, attrs_here, existing, fact_key)
            else:
                members = dimension_members(matched, key, attrs_here, existing, fact_key)
            append_members(spark, members.select(*[F.col(f.name).cast(f.dataType) for f in schemas[name].fields]), path)
        return run

    day_source = staged.select("order_date", F.col("source_time_id").alias("time_id"))
    schemas["dim_time"] = time_members(day_source).schema

    known_time = read_if_exists(spark, f"{root}/dim_time", schemas["dim_time"])
    new_time = time_members(day_source, known_time)
    if view is not None:
        new_time = materialize(new_time, "new-days")  # the view needs the load's own days

    def time_job() -> None:
        append_members(spark, new_time, f"{root}/dim_time")

    # rejects and the five dimensions are independent tables: submit their
    # jobs together (Spark runs concurrent jobs of one session side by side)
    jobs = [rejects_job, time_job] + [dimension_job(n, k, a) for n, (k, a) in DIMENSIONS.items()]
    run_concurrently(jobs, max_workers=len(jobs))

    def table(name: str) -> DataFrame:
        return read_or_empty(spark, f"{root}/{name}", schemas[name])

    # facts last, once every dimension member they reference is stored
    if view is None:
        append_facts(spark, matched, f"{root}/sales", fact_key)
    else:
        load, sums_path, delta_path = uuid.uuid4().hex, shared_scratch_dir(spark, "view-sums"), shared_scratch_dir(spark, "fact-delta")
        delta_facts(spark, matched, f"{root}/sales", fact_key).write.parquet(delta_path)
        delta = spark.read.schema(schemas["sales"]).parquet(delta_path)
        stored = read_if_exists(spark, f"{root}/sales", schemas["sales"])
        view.sums(delta, stored, table("dim_time"), new_time, table("dim_store")).write.parquet(sums_path)
        view.announce(load, delta_path, sums_path)
        write_facts(delta, f"{root}/sales")
        view.apply(load, spark.read.parquet(sums_path))
    spark.createDataFrame([report]).coalesce(1).write.mode("append").parquet(f"{root}/load_reports")
    return WarehouseStar(**{
        attr: table(name)
        for attr, name in (("fact", "sales"), ("time", "dim_time"), ("product", "dim_product"),
                           ("store", "dim_store"), ("supplier", "dim_supplier"),
                           ("customer", "dim_customer"))
    })


def run_concurrently(jobs: Sequence[Callable[[], None]], max_workers: int = 4) -> None:
    """Run independent Spark actions from a small thread pool; the first
    failure is re-raised after all jobs have finished."""
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = [pool.submit(job) for job in jobs]
    for f in futures:
        f.result()


def new_warehouse_root(spark: SparkSession) -> str:
    return shared_scratch_dir(spark, "warehouse")

"""Loads: pruned appends, limits, the incremental view, the bucketed star, inputs that change."""

import shutil

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemart.operators import facts
from tidemart.plans import catalog
from tidemart.plans import reports as R
from tidemart.plans.bucketed import store_bucketed
from tidemart.plans.checks import LoadLimits, LoadStopped
from tidemart.plans.load import load_warehouse, new_warehouse_root
from tidemart.plans.quarterly import QuarterlyView
from tidemart.session import shared_scratch_dir
from tidemart.sources.fixtures import FixtureSources

from .conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _nodes(plan):
    """All nodes of an executed plan, adaptive ones opened."""
    stack, out = [plan], []
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            stack.append(node.plan())
            continue
        out.append(node)
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return out


def _ran(df):
    execution = df._jdf.queryExecution()
    plan = execution.executedPlan()
    plan.executeCollect()
    return _nodes(plan)


# ------------------------------------------------------------------ appends

def _stored(spark, orders=20_000):
    matched = spark.range(orders, numPartitions=4).select(
        F.col("id").alias("order_id"), F.lit(1).alias("line_no"), F.lit(1).alias("quantity"), F.lit(1).cast("long").alias("customer_id"),
        (F.col("id") % 50).alias("product_id"), F.lit(1).alias("store_id"), (F.col("id") % 7).alias("supplier_id"),
        (19980000 + F.col("id") % 2 * 10000 + 101).cast("int").alias("time_id"), F.lit(2).cast("decimal(10,2)").alias("total_sales"))
    path = shared_scratch_dir(spark, "facts")
    facts.append_facts(spark, matched, path)
    return matched, path


def test_an_append_reads_the_order_ranges_it_touches(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    matched, path = _stored(spark, 400_000)
    delta = matched.where("order_id between 1000 and 1100 or order_id between 390000 and 390050").withColumn("quantity", F.lit(2))
    again = matched.where("order_id between 1000 and 1020")
    rows = facts.delta_facts(spark, delta.unionByName(again), path)
    nodes = _ran(rows)
    scans = [n for n in nodes if n.nodeName().startswith("Scan parquet")]
    assert len(scans) == 1 and "PushedFilters" in scans[0].toString() and "GreaterThanOrEqual(order_id,1000)" in scans[0].toString()
    assert scans[0].metrics().apply("numOutputRows").value() < 120_000  # of 400,000: pages outside the ranges are skipped
    shuffles = [n for n in nodes if n.nodeName() == "Exchange"]
    assert len(shuffles) == 1  # repeats and known keys are found in one
    assert rows.count() == 101 + 51
    facts.write_facts(rows, path)
    assert spark.read.parquet(path).count() == 400_000 + 152


def test_ranges_hold_all_values(spark):
    rows = spark.createDataFrame([(i,) for i in [*range(50), 1000, 5000, 5001, -7, 10**12]] + [(None,)], "order_id long")
    for most in (1, 2, 4, 32):
        ranges = facts.touched_ranges(rows, "order_id", most)
        assert len(ranges) <= most and all(any(a <= r.order_id <= b for a, b in ranges) for r in rows.collect() if r.order_id is not None)
    assert facts.touched_ranges(rows.where("order_id is null"), "order_id") is None


def test_one_fact_for_a_hot_key_and_null_keys(spark):
    """Of repeated rows the last in the order of the other columns; stored keys win; NULL key parts are equal."""
    day = fx.d(1998, 3, 1)
    feed = [(1, 1, day, 10, None, 1, c, fx.tid(day)) for c in (1, 2, 3) * 50] + [(None, None, day, 13, None, 1, 1, fx.tid(day))] * 3
    root = new_warehouse_root(spark)
    star = load_warehouse(spark, root, fx.feed(spark, feed), fx.customers(spark), fx.products(spark))
    assert [(r.order_id, r.customer_id) for r in star.fact.orderBy("order_id").collect()] == [(None, 1), (1, 3)]
    feed = [(1, 1, day, 10, None, 1, 2, fx.tid(day)), (None, None, day, 13, None, 1, 2, fx.tid(day)), (2, 1, day, 10, None, 1, 2, fx.tid(day))]
    star = load_warehouse(spark, root, fx.feed(spark, feed), fx.customers(spark), fx.products(spark))
    assert [(r.order_id, r.customer_id) for r in star.fact.orderBy("order_id").collect()] == [(None, 1), (1, 3), (2, 2)]


# ------------------------------------------------------------------- limits

def test_a_bad_feed_stops_before_the_facts(spark):
    root = new_warehouse_root(spark)
    load = lambda limits: load_warehouse(spark, root, fx.feed(spark), fx.customers(spark), fx.products(spark), limits=limits)
    with pytest.raises(LoadStopped) as stopped:
        load(LoadLimits(reject_share=0.1, nulls={"order_date": 0, "quantity": 5}, flagged={"missing_customer": 1}, least_rows=100))
    assert stopped.value.breaches == ["9 rows, 100 expected", "3 of 9 rows have no fact", "1 rows without order_date", "2 rows with missing_customer"]
    report = stopped.value.report
    assert (report["rows"], report["matched"], report["null_order_date"], report["null_quantity"], report["missing_product"]) == (9, 6, 1, 1, 2)
    assert spark.read.parquet(stopped.value.staged).where("not matched").count() == 3  # the quarantine
    for table in ("sales", "rejects", "dim_time", "dim_product", "load_reports"):
        assert facts.read_if_exists(spark, f"{root}/{table}") is None
    star = load(LoadLimits(reject_share=0.5, nulls={"order_date": 1}))
    assert star.fact.count() == 6 and spark.read.parquet(f"{root}/load_reports").first().rows == 9


def test_the_feed_is_read_once_to_stage_and_check(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    feed = fx.feed(spark)
    feed = feed.mapInArrow(counted, feed.schema)
    load_warehouse(spark, new_warehouse_root(spark), feed, fx.customers(spark), fx.products(spark), limits=LoadLimits(reject_share=0.9))
    assert read.value == 9


# --------------------------------------------------------------------- view

def _view(view):
    return sorted((r.store_name, r.year, r.quarter, r.total_sales) for r in view.read().collect())


def _full(star):
    return sorted((r.store_name, r.year, r.quarter, r.total_sales) for r in R.region_store_quarterly(star).collect())


def test_view_follows_overlapping_loads(spark):
    src = FixtureSources(spark, SF_SMALL)
    root = new_warehouse_root(spark)
    view = QuarterlyView(spark, root)
    masters = (src.customers(), src.products(), src.suppliers())
    assert _view(view) == []
    feeds = [src.feed(year=1996), src.feed(year=1997).unionByName(src.feed(year=1998)), src.feed(year=1998), src.feed()]
    versions = []
    for feed in feeds:
        star = load_warehouse(spark, root, feed, *masters, view=view)
        assert _view(view) == _full(star)
        versions.append(view._version()["years"])
    assert versions[1]["1996"] == versions[0]["1996"]  # an untouched year stays where it is
    assert versions[2] == versions[1]  # a repeated load touches none


def test_view_takes_old_facts_whose_day_comes_later(spark):
    day = fx.d(1998, 5, 1)
    root = new_warehouse_root(spark)
    view = QuarterlyView(spark, root)
    for rows in ([(1, 1, None, 10, None, 1, 1, 19980501)], [(2, 1, day, 10, None, 2, 1, 19980501)]):
        star = load_warehouse(spark, root, fx.feed(spark, rows), fx.customers(spark), fx.products(spark), view=view)
        assert _view(view) == _full(star)
    assert _view(view) == [("Mill Lane", 1998, 2, 3000.0)]


@pytest.mark.parametrize("dies", ["write_facts", "apply", "announce"])
def test_a_load_that_dies_between_facts_and_view_is_finished_by_the_next(spark, monkeypatch, dies):
    from tidemart.plans import load

    root = new_warehouse_root(spark)
    view = QuarterlyView(spark, root)
    masters = (fx.customers(spark), fx.products(spark))
    first = fx.feed(spark)
    day = fx.d(1999, 8, 1)
    second = fx.feed(spark, [(900 + i, 1, day, 10, None, 1, 1, fx.tid(day)) for i in range(5)])
    load_warehouse(spark, root, first, *masters, view=view)

    def die(*args, **kw):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(*((load, "write_facts") if dies == "write_facts" else (view, dies)), die)
        with pytest.raises(RuntimeError, match="lost"):
            load_warehouse(spark, root, second, *masters, view=view)
    star = load_warehouse(spark, root, second, *masters, view=view)
    assert star.fact.count() == 6 + 5 and _view(view) == _full(star)


# ----------------------------------------------------------------- bucketed

def test_bucketed_join_and_report_by_product_need_no_shuffle(spark):
    src = FixtureSources(spark, SF_SMALL)
    star = load_warehouse(spark, new_warehouse_root(spark), src.feed(), src.customers(), src.products(), src.suppliers())
    bucketed = store_bucketed(spark, star, shared_scratch_dir(spark, "bucketed"), buckets=4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for masters of any size
    try:
        def shuffles(s):
            report = s.sales(dims=("product",)).groupBy("product_id", "product_name").agg(F.sum("total_sales").alias("x"))
            nodes = _ran(report)
            assert any(n.nodeName() == "SortMergeJoin" for n in nodes)
            return sum(n.nodeName() == "Exchange" for n in nodes), _rows(report)

        (plain, expected), (none, got) = shuffles(star), shuffles(bucketed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plain >= 2 and none == 0 and got == expected
    for report in (R.q1_top_products_daytype, R.q4_product_season, R.q9_outliers):
        assert _rows(report(bucketed)) == _rows(report(star))


# ------------------------------------------------------------------- inputs

def test_changed_input_is_seen(spark, tmp_path):
    """What is loaded once is loaded again when its files change."""
    folder = str(tmp_path / "sf")
    shutil.copytree(SF_SMALL, folder, copy_function=shutil.copyfile)
    query = catalog.all_queries()["wh_q2_store_quarter_revenue"]
    first = _rows(query(spark, folder))
    star = catalog.loaded_warehouse(spark, folder)
    assert catalog.loaded_warehouse(spark, folder) is star and first == _rows(query(spark, SF_SMALL))
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_orderkey % 2 = 0").toPandas()
    lines.to_parquet(f"{folder}/lineitem.parquet")
    assert catalog.loaded_warehouse(spark, folder) is not star and _rows(query(spark, folder)) != first


def test_names_are_not_carried_through_the_rows(spark):
    """Staged rows hold ids; members come from the masters, the first row's value where a store has two names."""
    day = fx.d(1998, 3, 1)
    suppliers = spark.createDataFrame([(1, "S1", 5, "West", "R"), (2, "S2", 5, "East", "R"), (3, "S3", 6, "North", None), (4, "S4", 8, "None", "R")],
                                      "supplier_id int, supplier_name string, store_id int, store_name string, region string")
    feed = fx.feed(spark, [(9, 1, day, 10, 1, 1, 1, 1), (3, 1, day, 10, 2, 1, 2, 1), (4, 1, day, 11, 3, 1, 2, 1), (5, 1, day, 11, 4, 1, 99, 1)])
    root = new_warehouse_root(spark)
    masters = (fx.customers(spark), fx.products(spark), suppliers)
    with pytest.raises(LoadStopped) as stopped:
        load_warehouse(spark, root, feed, *masters, limits=LoadLimits(least_rows=100))
    staged = spark.read.parquet(stopped.value.staged).columns
    assert not {"customer_name", "product_name", "supplier_name", "store_name", "region"} & set(staged)
    for _ in range(2):
        star = load_warehouse(spark, root, feed, *masters)
        assert sorted(tuple(r) for r in star.store.collect()) == [(5, "East", "R"), (6, "North", None)]
        assert sorted(tuple(r) for r in star.supplier.collect()) == [(1, "S1"), (2, "S2"), (3, "S3")]
        assert sorted(r.customer_id for r in star.customer.collect()) == [1, 2]
        assert dict(star.supplier.dtypes)["supplier_id"] == "bigint" and star.product.count() == 2

import json
import os

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemart.operators.dims import DIMENSIONS
from tidemart.operators.enrich import enrich, enrich_rejects, normalise_feed
from tidemart.plans import reports as R
from tidemart.plans.load import load_warehouse, new_warehouse_root
from tidemart.session import materialize, shared_scratch_dir
from tidemart.sources.fixtures import FixtureSources
from tidemart.sources.segments import SegmentReader, segment_stream
from tidemart.streaming import manifest
from tidemart.streaming.enrich_stream import (
    StreamedWarehouse,
    run_to_completion,
    stage_feed_files,
    start_enrichment,
)

from .conftest import SF_SMALL

KEYS = ["order_id", "line_no", "product_id", "supplier_id", "quantity"]


def _rows(df, columns=None):
    return sorted((tuple(r) for r in df.select(*(columns or sorted(df.columns))).collect()), key=repr)


class Run:
    """A landed feed, its stream and the warehouse it fills."""

    def __init__(self, spark, feed, masters, rows, files=1):
        self.spark, self.masters, self.rows = spark, masters, rows
        self.landing = shared_scratch_dir(spark, "test-landing")
        self.out = shared_scratch_dir(spark, "test-stream")
        stage_feed_files(feed.repartition(files), self.landing, rows_per_file=1500)
        self.schema = feed.schema

    def go(self, before_commit=None):
        stream = segment_stream(self.spark, self.landing, self.schema, self.rows, self.out)
        run_to_completion(start_enrichment(self.spark, stream, *self.masters, self.out, f"{self.out}/_checkpoint", before_commit=before_commit))
        return self.read()

    def read(self):
        return StreamedWarehouse(self.spark, self.out, *self.masters, feed=self.schema)


def _source(spark, restricted=False):
    src = FixtureSources(spark, SF_SMALL, restricted=restricted)
    return normalise_feed(src.feed()), (src.customers(), src.products(), src.suppliers())


def test_stream_loses_nothing_and_equals_the_batch_load(spark):
    feed, masters = _source(spark, restricted=True)
    run = Run(spark, feed, masters, rows=2000, files=3)
    got = run.go()
    facts, rejects = got.sales(), got.rejects()
    assert facts.select("batch_id").distinct().count() >= 3
    assert facts.count() + rejects.count() == feed.count() and rejects.count() > 0
    assert _rows(facts, KEYS) == _rows(enrich(feed, *masters), KEYS)
    assert _rows(rejects, KEYS) == _rows(enrich_rejects(feed, *masters), KEYS)

    batch = load_warehouse(spark, new_warehouse_root(spark), feed, *masters)
    for name in ("dim_time", *DIMENSIONS):
        expected = getattr(batch, name.removeprefix("dim_"))
        assert _rows(got.dimension(name)) == _rows(expected), name
        assert got.dimension(name).schema.simpleString() == expected.select(got.dimension(name).columns).schema.simpleString()
    for report in (R.q1_top_products_daytype, R.q2_store_quarter_revenue, R.q5_volatility, R.q8_half_year):
        assert _rows(report(got.star())) == _rows(report(batch)), report.__name__

    commits = manifest.commits(spark, run.out).count()
    run.go()  # same checkpoint: nothing new to process
    assert manifest.commits(spark, run.out).count() == commits and got.sales().count() == facts.count()


@pytest.mark.parametrize("files", [1, 7])
def test_segments_hold_exactly_so_many_rows(spark, files):
    """Batches of 200 feed rows, the last one short, however the rows lie in files."""
    feed, masters = _source(spark)
    feed = spark.createDataFrame(feed.limit(1130).collect(), feed.schema)
    run = Run(spark, feed, masters, rows=200, files=files)
    got = run.go()
    assert [r.rows for r in manifest.commits(spark, run.out).orderBy("batch_id").collect()] == [200] * 5 + [130]
    assert got.sales().count() + got.rejects().count() == 1130


def test_restart_goes_on_at_the_next_row(spark):
    """Files that land later continue the numbering; known members are not added again."""
    day = fx.d(1998, 1, 1)
    feed = lambda a, b: fx.feed(spark, [(i, 1, day, 10 + i % 2, None, 1, 1, 19980101) for i in range(a, b)])
    run = Run(spark, feed(0, 10), (fx.customers(spark), fx.products(spark), None), rows=4)
    first = run.go()
    members = {n: _rows(first.dimension(n)) for n in DIMENSIONS}
    feed(10, 25).coalesce(1).write.parquet(f"{run.landing}/z-later")
    got = run.go()
    assert [r.rows for r in manifest.commits(spark, run.out).orderBy("batch_id").collect()] == [4, 4, 2, 4, 4, 4, 3]
    assert sorted(r.order_id for r in got.sales().collect()) == list(range(25))
    assert members == {n: _rows(got.dimension(n)) for n in DIMENSIONS}


def test_a_batch_that_fails_between_tables_is_invisible_until_its_replay(spark):
    feed, masters = _source(spark, restricted=True)
    run = Run(spark, feed, masters, rows=1700, files=2)
    calls = []

    def fail():
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("killed between the tables and the manifest")

    with pytest.raises(Exception, match="killed"):
        run.go(fail)
    # the third batch has written all its tables, but none of its rows shows
    assert any(p.startswith("batch_id=2") for _, d, _ in os.walk(f"{run.out}/sales".removeprefix("file:")) for p in d)
    half = run.read()
    assert manifest.last_commit(run.out)["batch_id"] == 1
    assert half.sales().count() + half.rejects().count() == 3400
    assert half.star().product.count() == half.sales().select("product_id").distinct().count()

    got = run.go()
    assert _rows(got.sales(), KEYS) == _rows(enrich(feed, *masters), KEYS)
    batch = load_warehouse(spark, new_warehouse_root(spark), feed, *masters)
    for name in ("dim_time", *DIMENSIONS):
        assert _rows(got.dimension(name)) == _rows(getattr(batch, name.removeprefix("dim_"))), name


def test_first_wins_within_and_across_batches(spark):
    """Conflicting attributes of one key: the smallest fact key of the first batch; dates of a new time id all enter."""
    d1, d2, d3 = fx.d(1998, 1, 1), fx.d(1998, 1, 2), fx.d(1998, 1, 3)
    feed = fx.feed(spark, [
        (9, 1, d1, 10, None, 1, 1, 199801), (3, 1, d2, 20, None, 1, 2, 199801), (3, None, d2, 10, None, 1, 2, 199801),
        (1, 1, d3, 20, None, 1, 1, 199801), (2, 1, None, 20, None, 1, 1, None)])
    products = fx.products(spark)
    run = Run(spark, feed.coalesce(1), (fx.customers(spark), products, None), rows=3)
    got = run.go()
    assert {(r.time_id, r.order_date) for r in got.dimension("dim_time").collect()} == {(199801, d1), (199801, d2)}
    expected = {n: None for n in DIMENSIONS}
    batch = load_warehouse(spark, new_warehouse_root(spark), spark.read.schema(feed.schema).parquet(run.landing), fx.customers(spark), products)
    for name in expected:
        assert _rows(got.dimension(name)) == _rows(getattr(batch, name.removeprefix("dim_"))), name


def test_a_hundred_batches_do_flat_work(spark):
    """What a batch reads and writes does not depend on the batches before it."""
    day = fx.d(1998, 1, 1)
    feed = fx.feed(spark, [(i, 1, day, 10 + i % 2, None, 1, 1, 19980101) for i in range(100 * 5)])
    run = Run(spark, feed.coalesce(1), (fx.customers(spark), fx.products(spark), None), rows=5)
    stream = segment_stream(spark, run.landing, run.schema, run.rows, run.out)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "300")
    query = start_enrichment(spark, stream, *run.masters, run.out, f"{run.out}/_checkpoint", state_partitions=1)
    query.processAllAvailable()
    progress = [json.loads(p.json) for p in query.recentProgress]
    query.stop()
    worked = [p for p in progress if p["numInputRows"]]
    assert len(worked) == 100 and manifest.last_commit(run.out)["rows_upto"] == 500
    state = [p["stateOperators"][0] for p in worked]
    assert {s["numRowsTotal"] for s in state[1:]} == {state[0]["numRowsTotal"]}  # all members came with the first batch
    assert {s["numRowsUpdated"] for s in state[1:]} == {0}
    took = [p["durationMs"]["addBatch"] for p in worked]
    early, late = sorted(took[5:35])[15], sorted(took[65:95])[15]
    assert late < 1.6 * early + 100


def test_segment_offsets(tmp_path, spark):
    feed = fx.feed(spark, [(i, 1, fx.d(1998, 1, 1), 10, None, 1, 1, 19980101) for i in range(10)])
    path = str(tmp_path / "landing")
    feed.coalesce(1).write.option("maxRecordsPerFile", 4).parquet(path)
    reader = SegmentReader(feed.schema, {"path": path, "rows": "3", "warehouse": str(tmp_path / "out")})
    assert reader.initialOffset() == {"row": 0} and reader.latestOffset() == {"row": 3} == reader.latestOffset()
    slices = reader.partitions({"row": 3}, {"row": 9})
    assert [(s.first, s.n) for s in slices] == [(3, 1), (0, 4), (0, 1)] and reader.latestOffset() == {"row": 10}
    got = [r["order_id"] for s in slices for b in reader.read(s) for r in b.to_pylist()]
    assert got == list(range(3, 9)) and reader.partitions({"row": 10}, {"row": 10}) == []
    with pytest.raises(ValueError, match="were planned"):
        reader.partitions({"row": 9}, {"row": 12})
    os.rename(os.path.join(path, sorted(f for f in os.listdir(path) if f.endswith(".parquet"))[0]), os.path.join(path, "zzz.parquet"))
    with pytest.raises(ValueError, match="files came before"):
        reader.latestOffset()


def test_manifest(tmp_path, spark):
    root = str(tmp_path / "wh")
    assert manifest.last_commit(root) is None and manifest.committed_rows(root) == 0
    with pytest.raises(RuntimeError, match="has not been committed"):
        manifest.commit(root, 1, 5)
    for i in range(21):
        manifest.commit(root, i, 10 + i)
        assert manifest.last_commit(root)["batch_id"] == i
    assert manifest.committed_rows(root) == sum(range(10, 31))
    assert manifest.commit(root, 20, 30)["rows_upto"] == sum(range(10, 31))  # a replay
    with pytest.raises(RuntimeError, match="its replay"):
        manifest.commit(root, 20, 31)
    assert manifest.commits(spark, root).count() == 21


def test_members_are_admitted_by_sparks_own_state_and_few_files(spark):
    """No Python call for each key; names with line breaks stay whole, all days of a new time id enter; a batch
    writes as many files as its rows need."""
    d1, d2 = fx.d(1998, 1, 1), fx.d(1998, 1, 2)
    feed = fx.feed(spark, [(i, 1, (d1, d2)[i % 2], 10 + i % 2, None, 1, 1, 199801) for i in range(40)])
    customers = fx.customers(spark).withColumn("customer_name", F.concat("customer_name", F.lit("\n\\n|\r\nb")))
    run = Run(spark, feed.coalesce(1), (customers, fx.products(spark), None), rows=20)
    stream = segment_stream(spark, run.landing, run.schema, run.rows, run.out)
    query = start_enrichment(spark, stream, *run.masters, run.out, f"{run.out}/_checkpoint")
    query.processAllAvailable()
    worked = [p for p in (json.loads(p.json) for p in query.recentProgress) if p["numInputRows"]]
    query.stop()
    assert {s["operatorName"] for p in worked for s in p["stateOperators"]} == {"dedupe"}
    got = run.read()
    assert {(r.time_id, r.order_date) for r in got.dimension("dim_time").collect()} == {(199801, d1), (199801, d2)}
    names = {r.customer_id: r.customer_name for r in customers.collect()}
    assert [(r.customer_id, r.customer_name) for r in got.dimension("dim_customer").collect()] == [(1, names[1])]
    for table in ("sales", "members"):
        for folder, _, files in os.walk(f"{run.out}/{table}".removeprefix("file:")):
            assert sum(f.endswith(".parquet") for f in files) <= 1, folder


def test_a_batch_does_not_hash_large_masters_in_the_driver(spark):
    """Every micro-batch joins the masters anew: 600,000 products in a few MB of files are not broadcast for each."""
    many = spark.range(600_000).select(
        F.col("id").alias("product_id"), F.lit("Laptop").alias("product_name"), F.lit(2).cast("decimal(10,2)").alias("product_price"),
        F.lit(7).cast("long").alias("supplier_id"), F.lit("Alder Optics").alias("supplier_name"), F.lit(1).alias("store_id"), F.lit("Mill Lane").alias("store_name"))
    products = materialize(many.coalesce(1), "test-products")
    day = fx.d(1998, 1, 1)
    run = Run(spark, fx.feed(spark, [(i, 1, day, 10 + i, None, 1, 1, 19980101) for i in range(6)]), (fx.customers(spark), products, None), rows=4)
    query = start_enrichment(spark, segment_stream(spark, run.landing, run.schema, 4, run.out), *run.masters, run.out, f"{run.out}/_checkpoint")
    query.processAllAvailable()
    plan = query._jsq.explainInternal(False)
    run_to_completion(query)
    assert "SortMergeJoin [product_id" in plan
    assert run.read().sales().count() == 6 and _rows(run.read().dimension("dim_product"), ["product_id"]) == [(10 + i,) for i in range(6)]

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from tidemart.operators.dims import dimension_members, first_wins, time_members
from tidemart.operators.enrich import DuplicateMasterKeys, enrich
from tidemart.operators.facts import read_if_exists
from tidemart.plans import reports as R
from tidemart.plans.load import load_warehouse, new_warehouse_root
from tidemart.plans.star import FeedStar
from tidemart.sources.fixtures import FixtureSources

from .conftest import SF_SMALL


def test_first_wins_takes_smallest_fact_key(spark):
    matched = enrich(fx.feed(spark), fx.customers(spark), fx.products(spark))
    sup = {r.supplier_id: r.supplier_name for r in
           dimension_members(matched, "supplier_id", ["supplier_name"]).collect()}
    # supplier 7 appears first (order 100, line 1) as Alder Optics
    assert sup[7] == "Alder Optics"
    assert set(sup) == {7, 8, 9}


def test_dimension_members_skip_existing(spark):
    matched = enrich(fx.feed(spark), fx.customers(spark), fx.products(spark))
    existing = spark.createDataFrame([(10, "Old name", Decimal("1.00"))],
                                     "product_id long, product_name string, product_price decimal(10,2)")
    new = dimension_members(matched, "product_id", ["product_name", "product_price"], existing)
    assert sorted(r.product_id for r in new.collect()) == [11, 12, 13]


def test_time_members_rules(spark):
    a, b = fx.d(1998, 1, 15), fx.d(1998, 1, 16)
    rows = [
        (1, 1, a, 10, None, 1, 1, 555),   # one new time id ...
        (2, 1, b, 10, None, 1, 1, 555),   # ... with two dates: both enter
        (3, 1, None, 10, None, 1, 1, 556),  # no date: ignored
        (4, 1, b, 10, None, 1, 1, None),  # no time id: ignored
        (5, 1, b, 10, None, 1, 1, 777),   # known id with a new date: ignored
    ]
    feed = fx.feed(spark, rows)
    existing = spark.createDataFrame([(777,)], "time_id int")
    got = sorted((r.time_id, str(r.order_date)) for r in time_members(feed, existing).collect())
    assert got == [(555, "1998-01-15"), (555, "1998-01-16")]


def test_first_wins_is_skew_safe_plan(spark):
    rows = spark.range(0, 1000).select(
        F.lit(1).cast("long").alias("k"), F.col("id").cast("string").alias("v"), F.col("id").alias("o"))
    out = first_wins(rows, "k", ["v"], ["o"])
    assert [tuple(r) for r in out.collect()] == [(1, "0")]
    plan = rows.select("k", "v").distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2   # partial before the shuffle, final behind it


def test_load_is_idempotent_and_keeps_equal_line_numbers(spark):
    root = new_warehouse_root(spark)
    a = fx.d(1998, 3, 1)
    rows = fx.feed_rows() + [
        # same (order_id, line_no), different product: both are facts
        (300, 1, a, 10, None, 1, 1, fx.tid(a)),
        (300, 1, a, 13, None, 1, 1, fx.tid(a)),
    ]
    feed = fx.feed(spark, rows)
    star = load_warehouse(spark, root, feed, fx.customers(spark), fx.products(spark))
    n1 = star.fact.count()
    assert n1 == 8   # incl. order 203 (no date: a fact, but no time row)
    assert star.fact.where("order_id = 300").count() == 2
    star = load_warehouse(spark, root, feed, fx.customers(spark), fx.products(spark))
    assert star.fact.count() == n1
    assert spark.read.parquet(f"{root}/rejects").count() == 3
    assert star.time.count() == 3       # 3 distinct dates, NULL date ignored
    assert star.supplier.where("supplier_id = 7").collect()[0].supplier_name == "Alder Optics"


def test_warehouse_reports_equal_feed_reports(spark):
    src = FixtureSources(spark, SF_SMALL)
    root = new_warehouse_root(spark)
    wh = load_warehouse(spark, root, src.feed(), src.customers(), src.products(), src.suppliers())
    fs = FeedStar.from_fixtures(src)
    for fn in (R.q1_top_products_daytype, R.q2_store_quarter_revenue, R.q3_store_supplier_product,
               R.q4_product_season, R.q5_volatility, R.q6_affinity, R.q7_rollup, R.q8_half_year,
               R.q9_outliers):
        a = sorted(map(tuple, fn(wh).collect()), key=repr)
        b = sorted(map(tuple, fn(fs).collect()), key=repr)
        assert a == b, fn.__name__
    a = sorted(map(tuple, R.q10_store_quarter_view(spark, wh).collect()))
    b = sorted(map(tuple, R.q10_store_quarter_view(spark, fs).collect()))
    assert a == b


def test_empty_load_gives_empty_tables_with_schema(spark):
    root = new_warehouse_root(spark)
    star = load_warehouse(spark, root, fx.feed(spark, []), fx.customers(spark).limit(0),
                          fx.products(spark).limit(0))
    assert star.fact.count() == 0 and "total_sales" in star.fact.columns
    assert star.time.count() == 0 and "week" in star.time.columns
    assert star.product.count() == 0
    assert R.q2_store_quarter_revenue(star).count() == 0


def _load(spark, rows, products=None):
    root = new_warehouse_root(spark)
    products = products if products is not None else fx.products(spark)
    return root, load_warehouse(spark, root, fx.feed(spark, rows), fx.customers(spark), products)


def test_stars_agree_where_a_time_id_has_several_dates(spark):
    """A date across the year's end and a NULL id: both stars join on time_id."""
    a, b = fx.d(1998, 12, 31), fx.d(1999, 1, 1)
    rows = [(1, 1, a, 10, None, 1, 1, 7), (2, 1, b, 10, None, 1, 1, 7), (3, 1, a, 13, None, 1, 2, None)]
    _, loaded = _load(spark, rows)
    feed = FeedStar.from_frames(fx.feed(spark, rows), fx.customers(spark), fx.products(spark))
    for star in (loaded, feed):
        assert {r.quarters: r.totalrevenue for r in R.q2_store_quarter_revenue(star, year=1998).collect()} == {4: 2000.0}
        assert {r.quarters: r.totalrevenue for r in R.q2_store_quarter_revenue(star, year=1999).collect()} == {1: 2000.0}
        assert [(r.year, r.month, r.current_revenue) for r in R.q5_volatility(star).collect()] == [(1998, 12, 2000.0), (1999, 1, 2000.0)]


def test_one_fact_per_key_within_and_across_loads(spark):
    a, b = fx.d(1998, 3, 1), fx.d(1999, 3, 1)
    row = (1, 1, a, 10, None, 1, 1, fx.tid(a))
    root, star = _load(spark, [row, row, row])
    assert star.fact.count() == 1
    moved = (1, 1, b, 10, None, 1, 1, fx.tid(b))   # the same key, a date in another year
    star = load_warehouse(spark, root, fx.feed(spark, [moved]), fx.customers(spark), fx.products(spark))
    assert [r.time_id for r in star.fact.collect()] == [fx.tid(a)]


def test_a_master_that_repeats_a_key_stops_the_load(spark):
    products = fx.products(spark)
    with pytest.raises(DuplicateMasterKeys, match="product_id"):
        _load(spark, fx.feed_rows(), products.union(products.where("product_id = 10")))


def test_an_unreadable_table_is_no_empty_table(spark, tmp_path):
    assert read_if_exists(spark, f"{tmp_path}/none") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        read_if_exists(spark, f"{tmp_path}/bad").count()


def test_an_amount_beyond_the_money_type_is_a_reject(spark):
    a = fx.d(1998, 3, 1)
    root, star = _load(spark, [(1, 1, a, 10, None, 2_000_000, 1, fx.tid(a)), (2, 1, a, 10, None, 1, 1, fx.tid(a))])
    assert [r.order_id for r in star.fact.collect()] == [2]
    assert [(r.order_id, r.bad_amount) for r in spark.read.parquet(f"{root}/rejects").collect()] == [(1, True)]


def test_time_days_of_a_known_id_are_ignored_null_ids_too(spark):
    """Insert-if-absent on an id, not on a date; NULL ids never enter."""
    a, b = fx.d(1998, 3, 1), fx.d(1998, 3, 2)
    root, star = _load(spark, [(1, 1, a, 10, None, 1, 1, 5), (2, 1, a, 10, None, 1, 1, None)])
    star = load_warehouse(spark, root, fx.feed(spark, [(3, 1, b, 10, None, 1, 1, 5), (4, 1, b, 10, None, 1, 1, 6)]), fx.customers(spark), fx.products(spark))
    assert sorted((r.time_id, r.order_date) for r in star.time.collect()) == [(5, a), (6, b)]

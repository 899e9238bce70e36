from decimal import Decimal

from tests import fixtures as fx
from tidemart.operators.enrich import enrich, enrich_flagged, enrich_rejects
from tidemart.sources.fixtures import FixtureSources

from .conftest import SF_SMALL


def test_matched_rows_and_amounts(spark):
    out = enrich(fx.feed(spark), fx.customers(spark), fx.products(spark))
    got = {(r.order_id, r.line_no): r for r in out.collect()}
    assert set(got) == {(100, 1), (100, 2), (101, 1), (102, 1), (103, 1), (203, 1)}
    assert got[(100, 1)].total_sales == Decimal("2000.00")
    assert got[(100, 1)].supplier_id == 7 and got[(100, 1)].store_name == "Mill Lane"
    assert got[(102, 1)].total_sales == Decimal("0.00")   # NULL price
    assert got[(103, 1)].total_sales == Decimal("0.00")   # NULL quantity
    assert got[(103, 1)].quantity == 0


def test_rejects_flag_missing_sides(spark):
    rej = {r.order_id: r for r in enrich_rejects(fx.feed(spark), fx.customers(spark), fx.products(spark)).collect()}
    assert set(rej) == {200, 201, 202}
    assert (rej[200].missing_customer, rej[200].missing_product) == (True, False)
    assert (rej[201].missing_customer, rej[201].missing_product) == (False, True)
    assert (rej[202].missing_customer, rej[202].missing_product) == (True, True)


def test_row_with_null_date_is_matched_not_dropped(spark):
    # order 203 has no date: it enriches; only the time dimension ignores it
    out = enrich(fx.feed(spark), fx.customers(spark), fx.products(spark))
    r = [x for x in out.collect() if x.order_id == 203][0]
    assert r.time_id == 0 and r.order_date is None


def test_flagged_one_pass_equals_split(spark):
    f, c, p = fx.feed(spark), fx.customers(spark), fx.products(spark)
    flagged = enrich_flagged(f, c, p)
    matched = {r.order_id for r in flagged.where("matched").collect()}
    rejected = {r.order_id for r in flagged.where("not matched").collect()}
    assert matched == {r.order_id for r in enrich(f, c, p).collect()}
    assert rejected == {r.order_id for r in enrich_rejects(f, c, p).collect()}


def test_matched_plus_rejects_is_whole_feed_on_fixtures(spark):
    src = FixtureSources(spark, SF_SMALL, restricted=True)
    f = src.feed()
    m = enrich(f, src.customers(), src.products(), src.suppliers()).count()
    r = enrich_rejects(f, src.customers(), src.products(), src.suppliers()).count()
    assert m + r == f.count()
    assert r > 0


def test_empty_inputs_give_empty_outputs_with_schema(spark):
    empty = fx.feed(spark, [])
    out = enrich(empty, fx.customers(spark).limit(0), fx.products(spark).limit(0))
    assert out.count() == 0
    assert "total_sales" in out.columns
    assert enrich_rejects(empty, fx.customers(spark), fx.products(spark)).count() == 0

"""Report semantics on hand-made stars (traps of the specification)."""

import itertools
from decimal import Decimal

from tests import fixtures as fx
from tidemart.operators.affinity import pair_frequencies, top_pairs
from tidemart.plans import reports as R
from tidemart.plans import variants as V
from tidemart.plans.star import FeedStar

CUST = [(1, "Ann", "F")]


def _star(spark, lines, prices):
    """lines: (order_id, line_no, date, product_id, qty); one customer, one
    supplier/store per product as in the product-row layout."""
    feed = fx.feed(spark, [(o, ln, d, p, None, q, 1, fx.tid(d) if d else None) for o, ln, d, p, q in lines])
    products = spark.createDataFrame(
        [(p, f"P{p}", Decimal(price), 1, "Sup", 1, "Store") for p, price in prices.items()],
        fx.PRODUCT_SCHEMA)
    customers = spark.createDataFrame(CUST, fx.CUSTOMER_SCHEMA)
    return FeedStar.from_frames(feed, customers, products)


def test_volatility_month_gap_and_zero_previous(spark):
    d = fx.d
    lines = [
        (1, 1, d(1998, 1, 5), 10, 1),   # Jan: 100
        (2, 1, d(1998, 3, 5), 10, 2),   # Mar: 200 (Feb missing)
        (3, 1, d(1998, 4, 5), 11, 5),   # Apr: 0 (free product)
        (4, 1, d(1998, 5, 5), 10, 1),   # May: 100 after a zero month
    ]
    star = _star(spark, lines, {10: "100.00", 11: "0.00"})
    q5 = {(r.month): (r.previous_revenue, r.percentage_change) for r in R.q5_volatility(star).collect()}
    assert q5[1] == (None, None)
    assert q5[3] == (100.0, 100.0)      # previous *existing* month (Jan)
    assert q5[4] == (200.0, -100.0)
    assert q5[5] == (0.0, None)         # zero previous -> no percentage
    v5 = {(r.month): (r.previous_revenue, r.percentage_change) for r in V.v5_volatility_calendar(star).collect()}
    assert v5[3] == (None, None)        # February had no sales
    assert v5[4] == (200.0, -100.0)


def test_affinity_counts_line_pairs_and_distinct_variant(spark):
    d = fx.d(1998, 1, 1)
    lines = [(1, 1, d, 10, 1), (1, 2, d, 10, 1), (1, 3, d, 11, 1), (2, 1, d, 10, 1), (2, 2, d, 12, 1)]
    star = _star(spark, lines, {10: "1.00", 11: "1.00", 12: "1.00"})
    q6 = {(r.product1, r.product2): r.frequency for r in R.q6_affinity(star).collect()}
    assert q6 == {(10, 11): 2, (10, 12): 1}
    v6 = {(r.product1, r.product2): r.frequency for r in V.v6_affinity_distinct(star).collect()}
    assert v6 == {(10, 11): 1, (10, 12): 1}


def test_hot_basket_cell_split_equals_brute_force(spark):
    # one basket holds most lines; tiny cells force the split path
    rows = [(1, p % 37) for p in range(300)] + [(o, p) for o in range(2, 40) for p in (o % 5, o % 7 + 3)]
    lines = spark.createDataFrame(rows, "order_id long, product_id long")
    got = {(r.item_a, r.item_b): r.frequency for r in
           pair_frequencies(lines, cell_items=8).collect()}
    brute: dict = {}
    by_order: dict = {}
    for o, p in rows:
        by_order.setdefault(o, []).append(p)
    for items in by_order.values():
        for a, b in itertools.product(items, items):
            if a < b:
                brute[(a, b)] = brute.get((a, b), 0) + 1
    assert got == brute
    top = top_pairs(lines, k=3).collect()
    expect = sorted(brute.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [((r.product1, r.product2), r.frequency) for r in top] == expect


def test_rollup_total_and_half_year_split(spark):
    d = fx.d
    lines = [(1, 1, d(1998, 2, 1), 10, 2), (2, 1, d(1998, 8, 1), 10, 1), (3, 1, d(1999, 1, 1), 11, 3)]
    star = _star(spark, lines, {10: "10.50", 11: "2.00"})
    roll = R.q7_rollup(star).collect()
    grand = [r for r in roll if r.gid == 15]
    assert len(grand) == 1 and grand[0].total_revenue == 37.5
    for r in R.q8_half_year(star).collect():
        assert r.first_half_revenue + r.second_half_revenue == r.total_revenue
        assert r.first_half_quantity + r.second_half_quantity == r.total_quantity


def test_outliers_flag(spark):
    d = fx.d(1998, 1, 1)
    lines = [(1, 1, d, 10, 1), (2, 1, d, 10, 1), (3, 1, d, 10, 1), (4, 1, d, 10, 10), (5, 1, d, 11, 1)]
    star = _star(spark, lines, {10: "1.00", 11: "5.00"})
    out = {r.product_id: r for r in R.q9_outliers(star).collect()}
    assert out[10].daily_sales == 10.0 and out[10].avg_daily_sales == 13.0 / 4
    assert out[10].outliers == "Yes"    # 10 > 2 * 3.25
    assert out[11].outliers == "No"


def test_top_products_is_global_and_v1_per_group(spark):
    d = fx.d
    lines = [(i, 1, d(1998, 1 + (i % 2), 3), 10 + i % 6, i) for i in range(1, 30)]
    star = _star(spark, lines, {p: "1.00" for p in range(10, 16)})
    q1 = R.q1_top_products_daytype(star).collect()
    assert len(q1) == 5
    v1 = V.v1_top5_per_month_daytype(star, k=2).collect()
    groups = {}
    for r in v1:
        groups.setdefault((r.month, r.day_type), []).append(r.rank)
    assert all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 2 for v in groups.values())


def test_window_group_limit_in_plan(spark):
    d = fx.d
    lines = [(i, 1, d(1998, 1, 3), 10 + i % 6, i) for i in range(1, 30)]
    star = _star(spark, lines, {p: "1.00" for p in range(10, 16)})
    df = V.v1_top5_per_month_daytype(star)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # a partial per-partition top-k runs before the shuffle of the window
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_empty_feed_reports_have_schema(spark):
    star = _star(spark, [], {10: "1.00"})
    for fn in (R.q2_store_quarter_revenue, R.q5_volatility, R.q6_affinity, R.q7_rollup, R.q9_outliers):
        out = fn(star)
        assert out.count() == 0, fn.__name__  # ROLLUP over no rows: no grand total row either
        assert len(out.columns) >= 3

"""A single order key holding a third of all lines must give the same
answers, with AQE allowed to split its partitions."""

import datetime as dt
from decimal import Decimal

import pytest

from tests import fixtures as fx
from tidemart.plans import reports as R
from tidemart.plans.star import FeedStar

N = 3000


@pytest.fixture()
def skew_conf(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _rows():
    day = dt.date(1998, 6, 1)
    rows = []
    for i in range(N):
        order = 1 if i % 3 == 0 else 1000 + i          # order 1: a third of all lines
        rows.append((order, i, day, 10 + i % 50, None, 1 + i % 4, 1, 19980601))
    return rows


def test_hot_order_gives_exact_results(spark, skew_conf):
    rows = _rows()
    feed = fx.feed(spark, rows)
    products = spark.createDataFrame(
        [(p, f"P{p}", Decimal("2.50"), 1 + p % 3, f"S{1 + p % 3}", 1, "Store") for p in range(10, 60)],
        fx.PRODUCT_SCHEMA)
    customers = spark.createDataFrame([(1, "Ann", "F")], fx.CUSTOMER_SCHEMA)
    star = FeedStar.from_frames(feed, customers, products)

    q9 = {r.product_id: r.daily_sales for r in R.q9_outliers(star).collect()}
    expect = {}
    for _, _, _, p, _, q, _, _ in rows:
        expect[p] = max(expect.get(p, 0.0), 2.5 * q)
    assert q9 == expect

    top = R.q6_affinity(star, k=3).collect()
    hot = [r[3] for r in rows if r[0] == 1]
    counts = {}
    for a in hot:
        for b in hot:
            if a < b:
                counts[(a, b)] = counts.get((a, b), 0) + 1
    best = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [((r.product1, r.product2), r.frequency) for r in top] == best

"""Top pairs by thresholds against the count of all pairs."""

import random

import pytest

from tidemart.operators import affinity
from tidemart.operators.affinity import pair_frequencies, top_pairs, top_pairs_pruned


def _lines(spark, rows):
    return spark.createDataFrame(rows, "order_id long, product_id long").repartition(3)


def _skewed(n=3000, items=3000, seed=1):
    """Baskets of a few items, most of them rare, some very common."""
    rng = random.Random(seed)
    return [(b, int(items * rng.random() ** 6) + 1) for b in range(n) for _ in range(rng.randrange(1, 8))]


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("k", [1, 5, 12])
def test_equals_the_full_count(spark, k, distinct):
    lines = _lines(spark, _skewed(800, 900, seed=k))
    got = top_pairs_pruned(lines, k, distinct_per_basket=distinct)
    assert [tuple(r) for r in got.top.collect()] == [tuple(r) for r in top_pairs(lines, k, distinct_per_basket=distinct).collect()]


def test_far_fewer_pairs_are_made_of_skewed_sales(spark, monkeypatch):
    monkeypatch.setattr(affinity, "HEADS", 4)
    lines = _lines(spark, _skewed())
    got = top_pairs_pruned(lines, 5)
    everything = pair_frequencies(lines)
    items = lines.distinct().count()
    all_pairs = affinity.basket_pairs(affinity.basket_items(lines, "order_id", "product_id", False), "order_id", "product_id").count()
    assert [tuple(r) for r in got.top.collect()] == [tuple(r) for r in top_pairs(lines, 5).collect()]
    assert everything.count() <= all_pairs and got.pairs < all_pairs / 3 and got.counted < got.items / 5 and items


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, 1), (1, 1)], [(1, 1), (1, 2)], [(1, None), (None, 2), (1, 3), (1, 4)]])
def test_few_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(affinity, "HEADS", 1)
    lines = _lines(spark, rows)
    assert [tuple(r) for r in top_pairs_pruned(lines, 1).top.collect()] == [tuple(r) for r in top_pairs(lines, 1).collect()]


def test_ties_at_the_floor_keep_the_smallest_ids(spark, monkeypatch):
    monkeypatch.setattr(affinity, "HEADS", 2)
    lines = _lines(spark, [(b, x) for b in range(40) for x in (b % 20, 100 + b % 20)])
    assert [tuple(r) for r in top_pairs_pruned(lines, 3).top.collect()] == [(0, 100, 2), (1, 101, 2), (2, 102, 2)]

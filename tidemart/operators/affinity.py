"""Co-purchase pair counting (product affinity).

frequency(a, b) = number of (line, line) pairs of one basket with items
a < b.  With per-basket multiplicities m this is sum over baskets of
m_a * m_b, so lines are first folded to one row per (basket, item): repeated
items never multiply the join input.

Skew: one basket may hold a huge share of all lines.  Baskets wider than
``cell_items`` distinct items are cut into s = ceil(width / cell_items)
hash cells and their pairs are produced in s x (s + 1) / 2 independent pairs of
cells (each line is copied about s / 2 times per side), so no task ever holds
the whole basket.  Small baskets keep s = 1: a plain self-join.  The pair
output is the query's definition; it is folded with map-side partial
aggregation before the final shuffle.

The folded baskets feed three branches (basket widths, both join sides);
they are written once to the shared checkpoint folder so that the sources
are scanned and shuffled once, not once per branch.

``top_pairs_pruned`` finds the same top k without counting all pairs.  An item's
*bound* is the sum over its baskets of its multiplicity times the basket's
largest one; no pair is more frequent than the bound of either item.  The exact
pair counts of the items with the largest bounds give a floor of the k-th
frequency, and items whose bound is below the floor are in no pair that matters.
Baskets without them are smaller, so the bounds are taken again until hardly any
item drops out, and only the pairs of the items left are counted.  On skewed
sales that is a small part of all pairs; where all items are alike nothing can be
pruned and the count is the full one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.session import materialize

#: Items of the largest bounds whose pairs set the floor, for each pair asked for.
HEADS = 40
#: Bounds are taken again while a round drops this share of the items.
SHRINK = 0.1


def basket_items(lines: DataFrame, basket: str, item: str, distinct_per_basket: bool) -> DataFrame:
    folded = lines.where(F.col(item).isNotNull() & F.col(basket).isNotNull()).groupBy(basket, item)
    if distinct_per_basket:
        return folded.agg(F.lit(1).cast("long").alias("m"))
    return folded.agg(F.count(F.lit(1)).alias("m"))


def pair_frequencies(lines: DataFrame, basket: str = "order_id", item: str = "product_id",
                     distinct_per_basket: bool = False, cell_items: int = 4096) -> DataFrame:
    """(item_a, item_b, frequency) for every co-occurring pair, item_a < item_b."""
    items = basket_items(lines, basket, item, distinct_per_basket)
    if not items.isStreaming:
        items = materialize(items, "basket-items")
    pairs = basket_pairs(items, basket, item, cell_items)
    return pairs.groupBy("item_a", "item_b").agg(F.sum("m").alias("frequency"))


def basket_pairs(items: DataFrame, basket: str, item: str, cell_items: int = 4096) -> DataFrame:
    """(item_a, item_b, m) of each basket, item_a < item_b; ``items``: (basket, item, m), one row each."""
    widths = items.groupBy(basket).agg(F.count(F.lit(1)).alias("_width"))
    cells = F.greatest(F.lit(1), F.ceil(F.col("_width") / F.lit(cell_items))).cast("int")
    sized = (
        items.join(widths, basket, "inner")
        .withColumn("_s", cells)
        .withColumn("_cell", F.pmod(F.xxhash64(F.col(item)), F.col("_s")).cast("int"))
    )
    # a pair of cells meets once, the smaller cell on the left; inside one cell
    # the smaller item is on the left, across cells either one may be
    left = sized.select(
        F.col(basket), F.col(item).alias("_x"), F.col("m").alias("m_a"),
        F.col("_cell").alias("_ca"), F.explode(F.sequence(F.col("_cell"), F.col("_s") - 1)).alias("_cb"))
    right = sized.select(
        F.col(basket), F.col(item).alias("_y"), F.col("m").alias("m_b"),
        F.explode(F.sequence(F.lit(0), F.col("_cell"))).alias("_ca"), F.col("_cell").alias("_cb"))
    pairs = left.join(right, [basket, "_ca", "_cb"], "inner").where((F.col("_ca") < F.col("_cb")) | (F.col("_x") < F.col("_y")))
    return pairs.select(F.least("_x", "_y").alias("item_a"), F.greatest("_x", "_y").alias("item_b"), (F.col("m_a") * F.col("m_b")).alias("m"))


def top_pairs(lines: DataFrame, k: int = 5, basket: str = "order_id", item: str = "product_id",
              distinct_per_basket: bool = False) -> DataFrame:
    """The k most frequent pairs; ties broken by the item ids."""
    return _top(pair_frequencies(lines, basket, item, distinct_per_basket), k)


def _top(freq: DataFrame, k: int) -> DataFrame:
    return (
        freq.select(F.col("item_a").alias("product1"), F.col("item_b").alias("product2"),
                    F.col("frequency").cast("long").alias("frequency"))
        .orderBy(F.desc("frequency"), "product1", "product2")
        .limit(k)
    )


class PrunedPairs(NamedTuple):
    """``top``: as ``top_pairs``; ``pairs`` rows were made for it, of ``items`` items ``counted`` were paired."""

    top: DataFrame
    pairs: int
    items: int
    counted: int


def _bounds(items: DataFrame, basket: str, item: str) -> DataFrame:
    """item, bound: what no pair of the item can exceed."""
    top = items.groupBy(basket).agg(F.max("m").alias("_most"), F.count(F.lit(1)).alias("_width")).where("_width > 1")
    return items.join(top, basket).groupBy(item).agg(F.sum(F.col("m") * F.col("_most")).alias("bound"))


def top_pairs_pruned(lines: DataFrame, k: int = 5, basket: str = "order_id", item: str = "product_id",
                     distinct_per_basket: bool = False) -> PrunedPairs:
    """The k most frequent pairs by thresholds; ties broken by the item ids."""
    items = materialize(basket_items(lines, basket, item, distinct_per_basket), "basket-items")
    bounds = materialize(_bounds(items, basket, item), "pair-bounds")
    n = left = bounds.count()
    made = 0
    floor = 0

    def counted(rows: DataFrame, label: str) -> tuple[DataFrame, int]:
        pairs = basket_pairs(rows, basket, item)
        top = materialize(_top(pairs.groupBy("item_a", "item_b").agg(F.sum("m").alias("frequency")), k), label)
        width = rows.groupBy(basket).agg(F.count(F.lit(1)).alias("w"))
        return top, width.agg(F.sum(F.expr("w * (w - 1) div 2"))).first()[0] or 0

    if n > HEADS * k:
        heads = bounds.orderBy(F.desc("bound"), item).limit(HEADS * k).select(item)
        top, made = counted(items.join(heads, item, "left_semi"), "pair-heads")
        found = top.agg(F.count(F.lit(1)), F.min("frequency")).first()
        floor = found[1] if found[0] == k else 0
    while floor:
        kept = bounds.where(F.col("bound") >= floor).select(item)
        items = materialize(items.join(kept, item, "left_semi"), "basket-items")
        bounds = materialize(_bounds(items, basket, item), "pair-bounds")
        before, left = left, bounds.where(F.col("bound") >= floor).count()
        if left > (1 - SHRINK) * before:
            items = items.join(bounds.where(F.col("bound") >= floor).select(item), item, "left_semi")
            break
    top, more = counted(items, "pair-top")
    return PrunedPairs(top.orderBy(F.desc("frequency"), "product1", "product2"), made + more, n, left)

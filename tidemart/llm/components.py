"""Connected components of a link table, as rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for all nodes of links (a, b).

    Rounds of large-star and small-star steps: every node is linked to the
    smallest node it knows, until each component is a star.  A round is written
    to the shared scratch folder, and only two numbers come to the driver.  The
    links of one node are never gathered: its smallest neighbour is a
    pre-aggregated minimum that a join brings back.  Both sides of these joins are
    stored tables, so they are joins of plain exchanges, and Spark splits the
    rows of a hub over several tasks.  Null ends and loops are left out.
    """
    edges = common.stored(links.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        # large star: larger neighbours of a node go to the smallest one it knows
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = common.stored(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "links-low")
        large = common.stored(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), "links-large")
        # small star: the smaller neighbours of a node, and itself, go to the smallest
        low = common.stored(large.groupBy("a").agg(F.min("b").alias("m")), "links-low")
        pairs = large.join(low, "a")
        small = pairs.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.toDF("a", "b"))
        edges = common.stored(small.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.toDF("node", "component")
    return stars.union(stars.select("component", "component").distinct())

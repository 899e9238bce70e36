"""A co-partitioned copy of the star: facts and the product master bucketed and sorted by product.

Of the star's dimensions only the product (and customer) master grows with the
business; stores, suppliers and days are size-checked broadcasts.  Stored in as
many buckets of the product id as the facts, the join reads bucket n of both
sides in one task and shuffles neither, however large both are, and a report by
product is grouped where it was joined.  Year filters prune as in the plain
star: buckets lie within the time buckets' partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemart.operators.facts import TIME_BUCKET
from tidemart.plans.star import WarehouseStar

KEY = "product_id"


def _stored(df: DataFrame, path: str, buckets: int, *partitions: str) -> DataFrame:
    """Write a bucketed external table and read it by a name of its own."""
    name = f"tidemart_bucketed_{uuid.uuid4().hex}"
    # rows of a bucket meet in one task, so a bucket is one file (in each partition)
    writer = df.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def store_bucketed(spark: SparkSession, star: WarehouseStar, root: str, buckets: int = 16) -> WarehouseStar:
    """The star with facts and products bucketed by product; about one task's data a bucket (facts / 128 MB)."""
    root = root.rstrip("/")
    return WarehouseStar(
        fact=_stored(star.fact, f"{root}/sales", buckets, TIME_BUCKET),
        product=_stored(star.product, f"{root}/dim_product", buckets),
        time=star.time, store=star.store, supplier=star.supplier, customer=star.customer,
    )

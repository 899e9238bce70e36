"""Streaming enrichment: feed segments -> micro-batches -> star tables.

* ST1 segmentation: ``segment_stream`` (tidemart.sources.segments) makes a
  micro-batch of exactly ``rows`` feed rows, whatever the landed files' sizes;
  only the last one is shorter.  Any other streaming feed works too.
* ST2 enrichment: stream-static left joins against the master tables with
  match flags, declared on the streaming DataFrame itself.  No feed row is
  lost: unmatched ones go to the rejects.
* ST3 commit: ``foreachBatch`` overwrites the partitions ``batch_id=N`` of every
  table (dynamic partition overwrite), then writes the batch's entry into the
  commit manifest.  Readers (``StreamedWarehouse``) see batches with an entry
  only, so all tables of a batch appear at once; a micro-batch replayed after a
  failure replaces its own output, and the checkpoint makes a restart resume
  after the last batch.
* ST4 dimensions: new members come out of a stateful operator keyed by
  (dimension, key) (tidemart.streaming.members), so no batch reads what earlier
  ones wrote and its work does not grow with their number.

Facts are partitioned by time bucket and batch, so reports prune them as in a
batch-loaded warehouse; the members of all dimensions are one table partitioned
by dimension and batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.operators.dims import DIMENSIONS
from tidemart.operators.enrich import enrich_flagged, require_unique_masters
from tidemart.operators.facts import TIME_BUCKET, fact_rows
from tidemart.plans.load import REJECT_COLUMNS, run_concurrently
from tidemart.plans.star import WarehouseStar
from tidemart.session import ship_library
from tidemart.sources.segments import TASK_ROWS
from tidemart.streaming import manifest
from tidemart.streaming.members import TIME, as_columns, member_schemas, new_members, time_rows

ROWS_PER_SEGMENT = 50_000
#: Keys of a growing dimension are kept on disk, with changes written per batch (whole files in the background).
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_MEMBER = ["dimension", "key", "rank", "attributes"]


def stage_feed_files(feed: DataFrame, landing: str, rows_per_file: int = 100_000) -> None:
    """Land a batch feed as parquet files of at most ``rows_per_file`` rows."""
    feed.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(landing)


def _overwrite_batch(df: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    (df.withColumn("batch_id", F.lit(batch_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions, "batch_id").parquet(path))


def commit_batch(batch: DataFrame, batch_id: int, out_root: str, flagged: T.StructType,
                 before_commit: Callable[[], None] | None = None) -> None:
    """Write one micro-batch - flagged rows and new members - into ``batch_id=N`` of the tables, then its
    manifest entry.  ``before_commit`` runs between the two."""
    out_root = out_root.rstrip("/")
    batch.persist()  # feeds every write below
    try:
        rows = batch.where("dimension is null")
        n = rows.count()  # fills the cache once, before several jobs read it
        # a file for each task and partition: as few tasks as the rows need, not as many as the state has parts
        tasks = -(-n // TASK_ROWS) or 1
        members, rows = batch.where("dimension is not null").coalesce(tasks), rows.coalesce(tasks)
        run_concurrently([
            lambda: _overwrite_batch(rows.where("not matched").select(*REJECT_COLUMNS), f"{out_root}/rejects", batch_id),
            lambda: _overwrite_batch(as_columns(members, flagged), f"{out_root}/members", batch_id, "dimension"),
            lambda: _overwrite_batch(fact_rows(rows.where("matched")), f"{out_root}/sales", batch_id, TIME_BUCKET),
        ])
        if before_commit is not None:
            before_commit()
        manifest.commit(out_root, batch_id, n)
    finally:
        batch.unpersist()


def with_members(flagged: DataFrame) -> DataFrame:
    """The flagged rows of a stream and, as rows of their own, the members they add."""
    members = new_members(flagged)
    return flagged.unionByName(members, allowMissingColumns=True)


def start_enrichment(spark: SparkSession, stream: DataFrame, customers: DataFrame,
                     products: DataFrame, suppliers: DataFrame | None, out_root: str,
                     checkpoint: str, processing_time: str | None = None,
                     before_commit: Callable[[], None] | None = None,
                     state_partitions: int | None = None) -> StreamingQuery:
    """Start the enrichment stream: ``sales``, ``rejects`` and ``members`` below ``out_root``, all partitioned
    by batch, and the manifest of committed batches.

    ``state_partitions``: parts of the member state, fixed by the first start (a
    task and a store of its own each; by default as many as tasks run at once)."""
    out_root = out_root.rstrip("/")
    ship_library(spark)
    require_unique_masters(customers, products, suppliers)
    flagged = enrich_flagged(stream, customers, products, suppliers)
    schema = flagged.schema
    parts = state_partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    settings = {**STATE_STORE, "spark.sql.shuffle.partitions": str(parts)}

    def commit(batch: DataFrame, batch_id: int) -> None:
        commit_batch(batch, batch_id, out_root, schema, before_commit)

    writer = with_members(flagged).writeStream.outputMode("append").foreachBatch(commit).option("checkpointLocation", checkpoint)
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    before = {k: spark.conf.get(k, None) for k in settings}
    try:  # the query takes the session's settings as they are when it starts
        for k, v in settings.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_to_completion(query: StreamingQuery) -> None:
    """Process all segments that are there, then stop."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


class StreamedWarehouse:
    """The committed batches of a streamed warehouse."""

    def __init__(self, spark: SparkSession, root: str, customers: DataFrame, products: DataFrame,
                 suppliers: DataFrame | None = None, feed: T.StructType | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        empty = spark.createDataFrame([], feed)
        self.flagged = enrich_flagged(empty, customers, products, suppliers)

    def _read(self, table: str, schema: T.StructType, *partitions: T.StructField) -> DataFrame:
        full = T.StructType([*schema.fields, *partitions, T.StructField("batch_id", T.IntegerType())])
        return manifest.committed(self.spark, self.root, table, full)

    def sales(self) -> DataFrame:
        return self._read("sales", fact_rows(self.flagged).schema)

    def rejects(self) -> DataFrame:
        return self._read("rejects", self.flagged.select(*REJECT_COLUMNS).schema)

    def dimension(self, name: str) -> DataFrame:
        """A dimension (with batch_id of the batch that added the member)."""
        members = self.spark.createDataFrame([], "dimension string, key long, rank string, attributes string")
        fields = [f for f in as_columns(members, self.flagged.schema).schema.fields if f.name != "dimension"]
        rows = self._read("members", T.StructType(fields), T.StructField("dimension", T.StringType()))
        rows = rows.where(F.col("dimension") == name)
        if name == TIME:
            return time_rows(rows)
        return rows.select(*member_schemas(self.flagged.schema)[name].fieldNames())

    def star(self) -> WarehouseStar:
        return WarehouseStar(fact=self.sales().drop("batch_id"), time=self.dimension(TIME), **{
            d.removeprefix("dim_"): self.dimension(d) for d in DIMENSIONS})

"""Session construction and the shared scratch folder.

Scratch output (staged feeds, loaded warehouse tables, stream checkpoints)
always goes below the cluster's shared ``spark.checkpoint.dir`` so that it
survives the loss of an executor and is visible to every node.  A session on a
cluster without that setting is an error; only a single-machine ``local``
session gets a folder of its own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

BROADCAST, MEASURED_BROADCAST = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"

# Settings every tidemart job relies on.  AQE re-plans joins from runtime
# sizes (broadcast only what really is small, split skewed partitions,
# coalesce tiny shuffle partitions); no master table is broadcast on faith.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # split a hot key's join partition even when that costs a shuffle later
    # (downstream aggregations otherwise pin the whole key to one task)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a broadcast is collected and hashed in the driver's memory.  Before a join runs Spark
    # knows the stored bytes only, and a master's row takes 10 to 20 times those as a hashed
    # row (part: 9 bytes stored, over 100 hashed); a finished stage has counted its rows' bytes
    BROADCAST: str(1024 * 1024),
    MEASURED_BROADCAST: str(16 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # a stored fact takes some 20 bytes and its entry in a task's hash map or sort
    # ten times that (a rollup five entries, a basket join one for each pair), so
    # Spark's own 128 MB of scan and 64 MB of shuffle a task do not fit its memory
    "spark.sql.files.maxPartitionBytes": str(16 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "tidemart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    checkpoint_dir: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # a limit that the caller sets later holds for measured sizes too
    conf = {k: v for k, v in SESSION_DEFAULTS.items() if k != MEASURED_BROADCAST}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def app_id(spark: SparkSession) -> str:
    """What caches of plans and loaded tables are keyed by: a new application
    (or a restarted one) never sees another one's entries."""
    return spark.sparkContext.applicationId


_APPLIED: set[str] = set()


def apply_sql_defaults(spark: SparkSession) -> None:
    """Set the SQL-level defaults that the caller left unset (once)."""
    if app_id(spark) in _APPLIED:
        return
    _APPLIED.add(app_id(spark))
    chosen = spark._jsparkSession.sessionState().conf().settings()
    limited = chosen.containsKey(BROADCAST)
    for key, value in SESSION_DEFAULTS.items():
        if key == MEASURED_BROADCAST and limited:
            continue  # the caller's limit holds for both
        if key.startswith("spark.sql.") and not chosen.containsKey(key) and spark.conf.isModifiable(key):
            spark.conf.set(key, value)


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes of source files for each partition that a shuffle starts with (AQE joins small ones up to the advisory size).
SHUFFLE_INPUT = 4 * 1024 * 1024
_SIZED: dict[str, str] = {}


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Let shuffles start with partitions in step with the input, so that a task's share does not grow with it;
    a number that the caller has set stays."""
    chosen = spark.conf.get(INITIAL_PARTITIONS, None)
    if chosen is not None and chosen != _SIZED.get(app_id(spark)):
        return
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _SIZED[app_id(spark)] = str(max(least, -(-input_bytes // SHUFFLE_INPUT)))
    spark.conf.set(INITIAL_PARTITIONS, _SIZED[app_id(spark)])


_SHIPPED: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Make the library importable in Python workers (once for each application)."""
    if app_id(spark) in _SHIPPED:
        return
    _SHIPPED.add(app_id(spark))
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemart-lib-"), "tidemart_lib.zip")  # code, no data: Spark hands it out
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in (n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.join("tidemart", os.path.relpath(full, package)))
    spark.sparkContext.addPyFile(path)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemart-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def shared_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tidemart/{label}-{uuid.uuid4().hex}"


def materialize(df, label: str = "materialized"):
    """Cut the lineage of a DataFrame that several branches of one plan read:
    write it once as a parquet table in a fresh folder below the shared
    checkpoint folder and read it back (columnar, compressed; never a local
    checkpoint).  Each branch then reads the stored rows instead of
    recomputing - and re-shuffling - the sources, and a lost executor does
    not force a recomputation either."""
    path = shared_scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)

import pytest

from tidemart.session import apply_sql_defaults, checkpoint_root, materialize, shared_scratch_dir


def test_scratch_goes_under_the_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        assert conf_dir.rstrip("/").split(":")[-1] in root
    a, b = shared_scratch_dir(spark, "x"), shared_scratch_dir(spark, "x")
    assert a.startswith(root) and b.startswith(root) and a != b


def test_materialize_writes_a_table_under_the_checkpoint_dir(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    out = materialize(df, "test-mat")
    assert sorted(tuple(r) for r in out.collect()) == [(i, 2 * i) for i in range(100)]
    root = checkpoint_root(spark).split(":")[-1]
    assert out.inputFiles() and all(root in f for f in out.inputFiles())


class _Cluster:
    """A session on a cluster that has no checkpoint folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

        class getConf:
            get = staticmethod(lambda key, default=None: default)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Cluster())


def test_settings_of_the_caller_stay(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "1234")
    from tidemart import session

    session._APPLIED.discard(session.app_id(own))
    apply_sql_defaults(own)
    assert own.conf.get("spark.sql.autoBroadcastJoinThreshold") == "1234"


def test_a_callers_broadcast_limit_holds_for_measured_sizes_too(spark):
    from tidemart import session

    own = spark.newSession()
    for key in (session.BROADCAST, session.MEASURED_BROADCAST):
        own.conf.unset(key)
    for limit, measured in (("1234", None), (None, session.SESSION_DEFAULTS[session.MEASURED_BROADCAST])):
        own.conf.unset(session.BROADCAST) if limit is None else own.conf.set(session.BROADCAST, limit)
        session._APPLIED.discard(session.app_id(own))
        apply_sql_defaults(own)
        assert own.conf.get(session.BROADCAST) == (limit or session.SESSION_DEFAULTS[session.BROADCAST])
        assert own._jsparkSession.sessionState().conf().settings().get(session.MEASURED_BROADCAST) == measured


def test_masters_whose_rows_are_many_for_their_bytes_are_not_broadcast(spark):
    """600,000 products in a few MB of files would fill tens of MB of the driver; 100,000 suppliers
    are measured and broadcast."""
    from pyspark.sql import functions as F

    from tidemart import session

    spark = spark.newSession()
    for key in (session.BROADCAST, session.MEASURED_BROADCAST):
        spark.conf.set(key, session.SESSION_DEFAULTS[key])
    rows = spark.range(600_000).select(F.col("id").alias("product_id"), F.lit("a name that all share").alias("product_name"))
    products = materialize(rows.coalesce(1), "test-products")
    feed = materialize(spark.range(1000).select((F.col("id") * 7).alias("product_id"), (F.col("id") % 5).alias("supplier_id")), "test-feed")
    suppliers = spark.range(100_000).select(F.col("id").alias("supplier_id"), F.md5(F.col("id").cast("string")).alias("supplier_name"))
    suppliers = materialize(suppliers, "test-suppliers").select("supplier_id", F.substring("supplier_name", 1, 8).alias("supplier_name"))
    joined = feed.join(products, "product_id", "left").join(suppliers, "supplier_id", "left")
    assert joined.count() == 1000 and joined.where("product_name is null").count() == 0
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert "SortMergeJoin [product_id" in plan and "BroadcastHashJoin [supplier_id" in plan


def test_shuffles_start_in_step_with_the_input(spark):
    """Partitions grow with the input's files, never below the caller's number; a number the caller set stays."""
    from tidemart import session

    own = spark.newSession()
    least = int(own.conf.get("spark.sql.shuffle.partitions"))
    kept = session._SIZED.pop(session.app_id(own), None)
    try:
        found = []
        for size in (1, 1 << 30, 6 << 30):
            session.size_shuffles(own, size)
            found.append(int(own.conf.get(session.INITIAL_PARTITIONS)))
        assert found[0] == least and found[2] == 6 * found[1] > 6 * least
        own.conf.set(session.INITIAL_PARTITIONS, "7")
        session.size_shuffles(own, 6 << 30)
        assert own.conf.get(session.INITIAL_PARTITIONS) == "7"
    finally:
        session._SIZED.pop(session.app_id(own), None)
        if kept is not None:
            session._SIZED[session.app_id(own)] = kept


def test_size_of_the_star_counts_its_tables_only(spark, tmp_path):
    from tidemart.sources.fixtures import star_bytes

    for name in ("lineitem", "orders", "documents"):
        (tmp_path / f"{name}.parquet").write_bytes(b"x" * 100)
    (tmp_path / "part.parquet").mkdir()
    (tmp_path / "part.parquet" / "a.parquet").write_bytes(b"x" * 11)
    assert star_bytes(spark, str(tmp_path)) == 211


def test_a_task_reads_small_shares_of_stored_rows(spark, tmp_path):
    """A task's memory is bound by its share of a scan: what a scan hands to one task is 16 MB at most."""
    spark.range(6_000_000).selectExpr("id", "xxhash64(id) as h").coalesce(1).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    largest = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    own = spark.newSession()
    apply_sql_defaults(own)
    assert largest > 40 << 20 and int(own.conf.get("spark.sql.files.maxPartitionBytes")) <= 16 << 20
    assert stored.rdd.getNumPartitions() >= largest / (16 << 20)

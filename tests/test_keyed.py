import pytest

from tidemart.session import shared_scratch_dir
from tidemart.sources.keyed import KeyedReader, read_master_ranges, write_sorted_master

from .conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ranges_cover_the_master_once(spark):
    path, columns = f"{SF_SMALL}/part.parquet", ["p_partkey", "p_name", "p_retailprice"]
    whole = spark.read.parquet(path).select(*columns)
    got = read_master_ranges(spark, path, "p_partkey", columns, rows=30)
    assert got.rdd.getNumPartitions() == -(-whole.count() // 30)
    assert got.schema.simpleString() == whole.schema.simpleString() and _rows(got) == _rows(whole)


@pytest.mark.parametrize("where", ["k >= 40 and k < 55", "k = 7", "k in (3, 90, 12)", "k > 95 or k < 2", "k is null", "k is not null", "k > 1000", "name = 'n5'", "k <= -5", "k > 20 and name like 'n3%'"])
def test_predicates(spark, where):
    path = shared_scratch_dir(spark, "test-master")
    rows = [(i, f"n{i}") for i in range(-10, 100)] + [(None, "none"), (None, None), (50, "again")]
    master = spark.createDataFrame(rows, "k long, name string")
    write_sorted_master(master, path, "k", files=4)
    assert _rows(read_master_ranges(spark, path, "k", ["k", "name"], rows=10).where(where)) == _rows(master.where(where))


def test_a_pushed_range_plans_its_ranges_only(spark, capsys):
    path = shared_scratch_dir(spark, "test-master")
    write_sorted_master(spark.range(1000).selectExpr("id as k", "id * 2 as v"), path, "k")
    got = read_master_ranges(spark, path, "k", ["k", "v"], rows=100).where("k between 250 and 420")
    assert got.rdd.getNumPartitions() == 3 and got.count() == 171
    capsys.readouterr()
    got.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,250), LessThanOrEqual(k,420)]" in plan
    assert "Filter (" not in plan  # nothing is left for Spark to filter

    reader = KeyedReader(got.schema, {"path": path, "key": "k", "rows": "100"})
    cuts = [(p.low, p.high) for p in reader.partitions()]
    assert cuts == [(i, i + 99) for i in range(0, 1000, 100)]  # each range once, no gap


def test_empty_master(spark):
    path = shared_scratch_dir(spark, "test-master")
    spark.createDataFrame([], "k long, v string").write.parquet(path)
    assert read_master_ranges(spark, path, "k", ["k", "v"]).collect() == []

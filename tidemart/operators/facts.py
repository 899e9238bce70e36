"""Idempotent sales-fact appends.

A plain INSERT aborts (or duplicates) when a load is repeated.  Here new
fact rows are the enriched rows whose fact key is not stored yet, one row per
key.  Delta rows and stored keys meet in one shuffle on the key: of each key the
first of its rows is taken, stored ones first, and only delta rows are kept, so
finding repeats and finding known keys is the same step.  A task sends on one
row of each key at most (the rank limit is applied before the shuffle).

Only stored keys that a delta can repeat are read: the delta names the ranges of
order ids that it touches (at most ``RANGES``), and these are pushed into the
scan of the stored facts.  Facts are stored in order of the order id within a
file, so row groups and pages outside the ranges are skipped.  (The time bucket
cannot serve for this: a repeated key may come with another date.)

Facts are appended as parquet partitioned by ``time_bucket``, a column derived
from ``time_id`` only, so that a filter on the time dimension can prune files
without assuming anything about dates.  Re-running a load, or running an
overlapping one, adds nothing twice; a task retried after an executor loss
rewrites only its own files through Spark's commit protocol.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.schemas import FACT_COLUMNS, FACT_KEY

TIME_BUCKET, ORDER = "time_bucket", "order_id"
#: Ranges of order ids that an append looks up in the stored facts.
RANGES = 32


def _is_absent(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The stored table, or None when it does not exist yet.  With a known
    schema no parquet footer is read to infer it.  Any other error is raised:
    an unreadable table is not an empty one."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if not _is_absent(error):
            raise
        return None


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a table with a known schema; a table that holds no rows yet (an
    empty load writes no data files) reads as an empty DataFrame."""
    found = read_if_exists(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def new_rows(rows: DataFrame, existing: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``existing``; NULL key parts compare equal."""
    if existing is None:
        return rows
    known = existing.select(*[F.col(k).alias(f"_k_{k}") for k in key])
    cond = [rows[k].eqNullSafe(known[f"_k_{k}"]) for k in key]
    return rows.join(known, cond, "left_anti")


def time_bucket(time_id: str = "time_id") -> Column:
    """Storage bucket of a time id: its first digits (of yyyymmdd the year)."""
    return F.floor(F.col(time_id) / F.lit(10000)).cast("int")


def fact_rows(matched: DataFrame) -> DataFrame:
    """Fact columns plus the storage partition column."""
    return matched.select(*FACT_COLUMNS, time_bucket().alias(TIME_BUCKET))


def touched_ranges(rows: DataFrame, column: str, most: int = RANGES) -> list[tuple[int, int]] | None:
    """At most ``most`` ranges that hold all non-NULL values of a whole-number column; None if there are none.

    The span of the column is cut into ``16 * most`` cells; one pass counts the
    cells in use, so a few numbers come to the driver.  Ranges with the smallest
    gaps between them are joined until few enough are left."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return None
    width = (high - low) // (16 * most) + 1
    cells = rows.where(F.col(column).isNotNull()).groupBy(F.expr(f"({column} - {low}L) div {width}L").alias("cell"))
    found = sorted(tuple(r) for r in cells.agg(F.min(column).alias("a"), F.max(column).alias("b")).select("a", "b").collect())
    gaps = sorted(((b[0] - a[1], i) for i, (a, b) in enumerate(zip(found, found[1:], strict=False))), reverse=True)
    cuts = sorted(i for gap, i in gaps[: most - 1] if gap > width)
    starts, ends = [0, *(i + 1 for i in cuts)], [*cuts, len(found) - 1]
    return [(found[a][0], found[b][1]) for a, b in zip(starts, ends, strict=True)]


def _within(column: str, ranges: list[tuple[int, int]] | None, nulls: bool) -> Column:
    found = F.col(column).isNull() if nulls else F.lit(False)
    for a, b in ranges or ():
        found = found | F.col(column).between(a, b)
    return found


def absent_facts(rows: DataFrame, existing: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """One row for each key that is not in ``existing``; of several the last one in the order of all other
    columns, as when a later record overwrites an earlier one.  NULL key parts compare equal."""
    rest = [c for c in rows.columns if c not in key]
    both = rows.withColumn("_stored", F.lit(False))
    if existing is not None:
        both = both.unionByName(existing.select(*key).withColumn("_stored", F.lit(True)), allowMissingColumns=True)
    order = [F.col("_stored").desc(), *(F.col(c).desc_nulls_last() for c in rest)]
    first = both.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_nth = 1")
    return first.where("not _stored").select(*rows.columns)


def delta_facts(spark: SparkSession, matched: DataFrame, path: str, key: Sequence[str] = FACT_KEY) -> DataFrame:
    """The fact rows of a load that are not stored yet."""
    rows = fact_rows(matched)
    existing = read_if_exists(spark, path, rows.schema)
    if existing is not None and ORDER in key:
        known = rows.agg(F.count(F.when(F.col(ORDER).isNull(), 1))).first()[0] > 0
        existing = existing.where(_within(ORDER, touched_ranges(rows, ORDER), known))
    return absent_facts(rows, existing, key)


def write_facts(delta: DataFrame, path: str) -> None:
    delta.sortWithinPartitions(TIME_BUCKET, ORDER).write.mode("append").partitionBy(TIME_BUCKET).parquet(path)


def append_facts(spark: SparkSession, matched: DataFrame, path: str,
                 key: Sequence[str] = FACT_KEY) -> None:
    """Append the not-yet-stored fact rows, one for each key, in one
    distributed write (no count, no cache: the delta can be as large as the
    feed)."""
    write_facts(delta_facts(spark, matched, path, key), path)


def append_members(spark: SparkSession, members: DataFrame, path: str) -> None:
    """Append dimension members (already filtered against the stored ones)."""
    members.write.mode("append").parquet(path)

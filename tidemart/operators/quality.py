"""Set-based data-quality checks (the constraints a database would enforce).

Each check is one aggregation (with map-side partial aggregation) or an
anti-join against a per-key aggregate, never a per-row probe, and returns
the offending keys with counts - an empty result means the rule holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Primary-key check: key values held by more than one row."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def key_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Primary-key check over several tables at once: (table_name,
    key_value, n_rows) for every key value held by more than one row.
    NULL keys are the NOT NULL check's business (:func:`null_counts`)."""
    out = None
    for name, (df, key) in tables.items():
        keys = df.select(F.col(key).cast("long").alias("key_value")).where(F.col("key_value").isNotNull())
        part = duplicate_keys(keys, ["key_value"])
        part = part.select(F.lit(name).alias("table_name"), "key_value", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def one_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row that is last in ``order_by`` (arrival order;
    all other columns by default) wins, as when a later record of the same
    key overwrites an earlier one.  NULL key parts compare equal.

    A hash count finds the repeated keys; only their rows are ordered, the
    others pass as they are.  Both steps aggregate on the map side, so a key
    repeated millions of times costs one partial row per task."""
    rest = [c for c in df.columns if c not in key]
    order = list(order_by) if order_by is not None else rest
    repeated = duplicate_keys(df, key).select(*[F.col(k).alias(f"_r_{k}") for k in key])
    same = [df[k].eqNullSafe(repeated[f"_r_{k}"]) for k in key]
    last = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    resolved = df.join(repeated, same, "left_semi").groupBy(*key).agg(last.alias("_last"))
    resolved = resolved.select(*[F.col(c) if c in key else F.col(f"_last.{c}").alias(c) for c in df.columns])
    return df.join(repeated, same, "left_anti").unionByName(resolved)


def orphan_report(df: DataFrame, checks: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Foreign-key check: non-NULL values absent from their parent, for several
    foreign keys in one pass over ``df``.

    Every row is unpivoted to (foreign_key, key_value) pairs, counted in one
    aggregation and anti-joined once against the parents' keys tagged with
    the same foreign-key name - the child (the large side) is read once
    however many references are checked."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(fk).alias("foreign_key"), F.col(fk).cast("long").alias("key_value"))
        for fk, _, _ in checks]))
    per_key = (
        df.select(pairs.alias("_p")).select("_p.*")
        .where(F.col("key_value").isNotNull())
        .groupBy("foreign_key", "key_value").agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = None
    for fk, parent, pk in checks:
        keys = parent.select(F.lit(fk).alias("foreign_key"), F.col(pk).cast("long").alias("key_value"))
        parents = keys if parents is None else parents.unionByName(keys)
    parents = parents.where(F.col("key_value").isNotNull())
    return per_key.join(parents, ["foreign_key", "key_value"], "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NOT NULL check: one row with the row count and NULLs per column."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(f"null_{c}") for c in columns]
    return df.agg(*aggs)


def dependency_violations(df: DataFrame, key: str, attr: str) -> DataFrame:
    """Keys mapped to more than one distinct value of ``attr``.

    Used for time-key fan-out (time_id -> date) and for conflicting
    dimension attributes (supplier id -> name, product -> supplier).  Two
    grouped passes (distinct pairs, then count) instead of a count-distinct
    keep each step a partial aggregation."""
    pairs = df.where(F.col(key).isNotNull()).select(key, attr).distinct()
    return (
        pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n_values"))
        .where(F.col("n_values") > 1)
    )

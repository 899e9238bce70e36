"""Dimension members of a stream as keyed state.

Every enriched feed row proposes the members of the dimensions it names.  Spark's
streaming de-duplication on (dimension, key) lets the first proposal of a key
through and remembers the key, so "insert if absent" is a look-up in Spark's
state store: a micro-batch touches the state of its own keys, however many
batches and members came before.  The state is versioned by batch, so a replayed
batch finds the state it found the first time, and a restart goes on with it.

Within a batch the proposal with the smallest fact key wins (first wins, as in
the batch load).  The time dimension is different, as specified: all dates of a
new time id enter, later dates of a known id do not.  So before the state the
proposals of a batch are brought to one row for each key, of a time id with all
its dates.

Before the shuffle a task reduces what it read to the best proposal of each
distinct (dimension, key, attributes), so a key that a third of the rows carry
sends a few rows per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.dates import time_attributes
from tidemart.operators.dims import DIMENSIONS
from tidemart.schemas import FACT_KEY

TIME = "dim_time"
_PROPOSAL = "dimension string, key long, rank string, attributes string"
_LOWEST = -(2**63)


def _rank(columns: tuple[str, ...]) -> Column:
    """Text that sorts as the columns do (whole numbers, NULL first)."""
    parts = []
    for c in columns:
        digits = F.lpad(F.hex(F.col(c).cast("long").bitwiseXOR(F.lit(_LOWEST))), 16, "0")
        parts.append(F.when(F.col(c).isNull(), F.lit("0" * 17)).otherwise(F.concat(F.lit("1"), digits)))
    return F.concat(*parts)


def proposals(flagged: DataFrame) -> DataFrame:
    """dimension, key, rank, attributes (JSON) that the rows propose: of matched rows the members of the four
    dimensions, of all rows with a date and a time id that day."""
    def one(dimension: str, key: str, attributes: list[str], when: Column) -> Column:
        row = F.struct(
            F.lit(dimension).alias("dimension"), F.col(key).cast("long").alias("key"), F.lit("").alias("rank"),
            F.to_json(F.struct(*[F.col(a) for a in attributes])).alias("attributes"))
        return F.when(when & F.col(key).isNotNull(), row)

    wanted = [one(n, k, [a for a in attrs if a in flagged.columns], F.col("matched")) for n, (k, attrs) in DIMENSIONS.items()]
    wanted.append(one(TIME, "source_time_id", ["order_date"], F.col("order_date").isNotNull()))
    rows = flagged.select(_rank(FACT_KEY).alias("_rank"), F.explode(F.filter(F.array(*wanted), lambda x: x.isNotNull())).alias("_p"))
    return rows.select("_p.dimension", "_p.key", F.col("_rank").alias("rank"), "_p.attributes")


def _best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each (dimension, key, attributes) the proposal with the smallest rank."""
    for rows in batches:
        yield rows.sort_values("rank").drop_duplicates(["dimension", "key", "attributes"])


def _one_per_key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each (dimension, key) of a batch one row: the proposal with the smallest rank, of a time id all its days
    (one JSON text a line, so a line break separates them).  All proposals of a key are in one partition."""
    found = list(batches)
    if not found:
        return
    rows = pd.concat(found, ignore_index=True).sort_values(["rank", "attributes"])
    timed = rows["dimension"] == TIME
    yield rows[~timed].drop_duplicates(["dimension", "key"])
    days = rows[timed].drop_duplicates(["key", "attributes"]).sort_values("attributes")
    if len(days):
        yield days.groupby(["dimension", "key"], as_index=False).agg({"rank": "min", "attributes": "\n".join})


def new_members(flagged: DataFrame) -> DataFrame:
    """dimension, key, rank, attributes of the members that a stream of flagged rows adds."""
    reduced = proposals(flagged).mapInPandas(_best, _PROPOSAL)
    single = reduced.repartition("dimension", "key").mapInPandas(_one_per_key, _PROPOSAL)
    added = single.dropDuplicates(["dimension", "key"])  # JSON text holds no line break
    return added.select("dimension", "key", F.lit("").alias("rank"), F.explode(F.split("attributes", "\n")).alias("attributes"))


def member_schemas(flagged: T.StructType) -> dict[str, T.StructType]:
    """The columns of each dimension, given those of the flagged rows."""
    out = {}
    for name, (key, attrs) in DIMENSIONS.items():
        out[name] = T.StructType([flagged[c] for c in (key, *attrs) if c in flagged.fieldNames()])
    return out


def as_columns(members: DataFrame, flagged: T.StructType) -> DataFrame:
    """Members with the columns of all dimensions (those of other dimensions are NULL), decoded from JSON."""
    schemas = member_schemas(flagged)
    fields = {f.name: f for s in schemas.values() for f in s.fields} | {"order_date": flagged["order_date"]}
    keys = {name: s.fieldNames()[0] for name, s in schemas.items()}
    parsed = F.from_json("attributes", T.StructType([f for n, f in fields.items() if n not in keys.values()]))
    rows = members.select("dimension", "key", parsed.alias("_a"))
    columns = [F.col("dimension")]
    for name, f in fields.items():
        own = [d for d, k in keys.items() if k == name]
        columns.append(F.when(F.col("dimension") == own[0], F.col("key")).cast(f.dataType).alias(name) if own else F.col(f"_a.{name}").alias(name))
    columns.append(F.when(F.col("dimension") == TIME, F.col("key")).cast("int").alias("time_id"))
    return rows.select(*columns)


def time_rows(days: DataFrame) -> DataFrame:
    """The time dimension's columns of days (time_id, order_date)."""
    parts = time_attributes("order_date")
    return days.select("time_id", "order_date", *(parts[c].alias(c) for c in ("day", "week", "month", "year", "quarter")))

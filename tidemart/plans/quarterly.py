"""The quarterly store view as a table that loads keep up to date (D3).

The view holds exact revenue by store name, year and quarter, partitioned by
year.  A load adds the sums of what it changes and nothing else is read:

* its new facts, joined to the time and store dimensions (old and new members);
* facts stored before whose time id gets its first date with this load - only
  the time buckets of new ids are read for them.

The years in those sums are merged with their old rows and written under a new
version; the other years stay in the version that last wrote them.  A version
counts once its manifest is there, which is written last.

The facts and the view are two tables, so a load notes what it is about to do
(``pending``: the staged delta and its sums) before it writes facts.  If it dies
in between, the next load finishes it first; both steps can be repeated.
"""

from __future__ import annotations

import json
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.measures import as_double
from tidemart.operators.facts import TIME_BUCKET, absent_facts, read_if_exists, time_bucket, write_facts
from tidemart.schemas import FACT_KEY
from tidemart.sources.files import filesystem

_KEYS = ("store_name", "year", "quarter")
_SCHEMA = "store_name string, quarter int, revenue decimal(38,2), year int"


def _put(uri: str, content: dict) -> None:
    """Write a small JSON file in one move."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(part) as f:
        f.write(json.dumps(content).encode())
    fs.move(part, path)


def _get(uri: str) -> dict | None:
    fs, path = filesystem(uri)
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


class QuarterlyView:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.sales = f"{self.root}/sales"
        self.path = f"{self.root}/store_quarter"

    # ------------------------------------------------------------- reading

    def _version(self) -> dict:
        fs, path = filesystem(f"{self.path}/versions")
        if fs.get_file_info(path).type != pafs.FileType.Directory:
            return {"version": 0, "years": {}, "loads": []}
        names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(path)) if f.base_name.endswith(".json")]
        return _get(f"{self.path}/versions/{max(names)}") if names else {"version": 0, "years": {}, "loads": []}

    def _rows(self, years: dict[str, int]) -> DataFrame:
        """The rows of the given years, each in the version that wrote it last."""
        out = self.spark.createDataFrame([], _SCHEMA)
        for version in sorted(set(years.values())):
            own = [int(y) for y, v in years.items() if v == version]
            out = out.unionByName(self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/v{version:09d}").where(F.col("year").isin(own)))
        return out

    def read(self) -> DataFrame:
        rows = self._rows(self._version()["years"])
        return rows.select("store_name", "year", "quarter", as_double("revenue").alias("total_sales"))

    # ----------------------------------------------------------- maintaining

    def sums(self, delta: DataFrame, stored: DataFrame | None, time: DataFrame, new_time: DataFrame, store: DataFrame) -> DataFrame:
        """What a load adds: ``delta`` its facts, ``stored`` those before it; ``time`` all days and ``new_time``
        its own; ``store`` all stores."""
        def joined(facts: DataFrame, days: DataFrame) -> DataFrame:
            days = days.select("time_id", "year", "quarter").withColumn(TIME_BUCKET, time_bucket())
            return facts.select("time_id", TIME_BUCKET, "store_id", "total_sales").join(days, ["time_id", TIME_BUCKET])

        rows = joined(delta, time)
        if stored is not None:
            rows = rows.unionByName(joined(stored, new_time))
        rows = rows.join(store.select("store_id", "store_name"), "store_id")
        return rows.groupBy(*_KEYS).agg(F.sum("total_sales").cast("decimal(38,2)").alias("revenue"))

    def announce(self, load: str, delta: str, sums: str) -> None:
        _put(f"{self.path}/pending.json", {"load": load, "delta": delta, "sums": sums})

    def apply(self, load: str, sums: DataFrame) -> None:
        """Merge a load's sums into the years they touch."""
        now = self._version()
        if load in now["loads"]:
            return
        touched = [str(r[0]) for r in sums.select("year").distinct().collect()]  # calendar years
        version = now["version"] + 1
        years = dict(now["years"])
        if touched:
            old = self._rows({y: v for y, v in years.items() if y in touched})
            merged = old.unionByName(sums).groupBy(*_KEYS).agg(F.sum("revenue").cast("decimal(38,2)").alias("revenue"))
            merged.write.mode("overwrite").partitionBy("year").parquet(f"{self.path}/v{version:09d}")
            years |= dict.fromkeys(touched, version)
        _put(f"{self.path}/versions/{version:09d}.json", {"version": version, "years": years, "loads": [*now["loads"][-99:], load]})

    def finish_pending(self) -> bool:
        """Complete a load that died between its facts and the view; whether there was one."""
        pending = _get(f"{self.path}/pending.json")
        if pending is None or pending["load"] in self._version()["loads"]:
            return False
        delta = self.spark.read.parquet(pending["delta"])
        write_facts(absent_facts(delta, read_if_exists(self.spark, self.sales, delta.schema), FACT_KEY), self.sales)
        self.apply(pending["load"], self.spark.read.parquet(pending["sums"]))
        return True

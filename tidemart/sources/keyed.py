"""Masters read by key ranges: a partitioned batch data source with pushed predicates.

A master table is dealt into ranges of its key of about ``rows`` rows each, from
the smallest and largest key in the footers; each range is one task, rows
without a key are one more.  A task opens the row groups whose key statistics
meet its range and keeps the rows inside, so every row is read by exactly one
range.  A master stored in key order (``write_sorted_master``) has row groups
that meet one or two ranges only.

Comparisons of the key with constants (=, <, <=, >, >=, IN) are pushed down:
they narrow the ranges before any is planned, and the plan shows them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from tidemart.session import ship_library
from tidemart.sources.files import filesystem, footer, parquet_files

FORMAT = "tidemart_keyed"
ROWS_PER_RANGE = 1_000_000


class KeyRange(InputPartition):
    """Keys low .. high (both included); None: the rows without a key."""

    def __init__(self, low: int | None, high: int | None) -> None:
        self.low, self.high = low, high


class KeyedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.columns, self.path, self.key = schema.fieldNames(), options["path"], options["key"]
        self.rows = int(options.get("rows", ROWS_PER_RANGE))
        self.low: int | None = None
        self.high: int | None = None
        self.nulls, self.empty = True, False

    def _narrow(self, low: int | None, high: int | None) -> None:
        self.nulls = False
        if low is not None:
            self.low = low if self.low is None else max(self.low, low)
        if high is not None:
            self.high = high if self.high is None else min(self.high, high)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Take the comparisons of the key; what is returned Spark applies itself."""
        for f in filters:
            value = getattr(f, "value", None)
            if getattr(f, "attribute", None) != (self.key,):
                yield f
            elif isinstance(f, IsNotNull):
                self.nulls = False
            elif isinstance(f, In) and f.value and all(isinstance(v, int) for v in f.value):
                self._narrow(min(f.value), max(f.value))
                yield f  # the range holds more keys than those asked for
            elif not isinstance(value, int):
                yield f
            elif isinstance(f, EqualTo):
                self._narrow(value, value)
            elif isinstance(f, GreaterThan):
                self._narrow(value + 1, None)
            elif isinstance(f, GreaterThanOrEqual):
                self._narrow(value, None)
            elif isinstance(f, LessThan):
                self._narrow(None, value - 1)
            elif isinstance(f, LessThanOrEqual):
                self._narrow(None, value)
            else:
                yield f

    def _extent(self) -> tuple[int, int, int, int] | None:
        """Smallest and largest key, rows and rows without key, from the footers."""
        lows, highs, rows, nulls = [], [], 0, 0
        for file in parquet_files(self.path):
            meta = footer(self.path, file)
            at = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == self.key)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                rows += meta.row_group(g).num_rows
                if stats is None or not stats.has_null_count:
                    raise ValueError(f"{file}: no statistics of {self.key}")
                nulls += stats.null_count
                if stats.has_min_max:
                    lows.append(stats.min)
                    highs.append(stats.max)
        return (min(lows), max(highs), rows, nulls) if lows else ((0, -1, rows, nulls) if rows else None)

    def partitions(self) -> list[KeyRange]:
        extent = self._extent()
        if extent is None:
            return [KeyRange(0, -1)]
        first, last, rows, nulls = extent
        n = max(1, -(-rows // self.rows))
        width = max(1, -(-(last - first + 1) // n))
        low = first if self.low is None else max(first, self.low)
        high = last if self.high is None else min(last, self.high)
        out = []
        start = first + (low - first) // width * width
        while start <= high:  # the ranges' cuts do not depend on the predicates
            out.append(KeyRange(max(low, start), min(high, start + width - 1)))
            start += width
        out += [KeyRange(None, None)] * (nulls > 0 and self.nulls)
        return out or [KeyRange(0, -1)]  # Spark asks for one partition at least

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        if partition.low is not None and partition.low > partition.high:
            return
        fs, _ = filesystem(self.path)
        key = pc.field(self.key)
        inside = key.is_null() if partition.low is None else (key >= partition.low) & (key <= partition.high)
        files = ds.dataset(parquet_files(self.path), filesystem=fs, format="parquet")
        yield from (b for b in files.to_batches(columns=self.columns, filter=inside, batch_size=10_000) if b.num_rows)


class KeyedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: StructType) -> KeyedReader:
        return KeyedReader(schema, dict(self.options))


def read_master_ranges(spark: SparkSession, path: str, key: str, columns: list[str], rows: int = ROWS_PER_RANGE) -> DataFrame:
    """The columns of a master, one task for each range of about ``rows`` keys."""
    ship_library(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(KeyedSource)
    schema = spark.read.parquet(path).select(*columns).schema
    return spark.read.format(FORMAT).schema(schema).option("key", key).option("rows", rows).load(path)


def write_sorted_master(master: DataFrame, path: str, key: str, files: int = 8) -> None:
    """Store a master in key order, so that a range meets few row groups."""
    master.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(path)

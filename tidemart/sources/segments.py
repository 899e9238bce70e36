"""Row-exact segments of a landed feed: a streaming data source whose offset is a row number.

The landed files are read in the order of their names; row numbers run through
all of them.  A micro-batch is the next ``rows`` rows, however they are spread
over files and row groups; only the last one of the feed is shorter.  New files
must sort behind those already read (a landing folder whose names carry their
time); a file that shrinks or a gap in the order is an error, not a silent loss.

Spark's checkpoint holds the range of the batch that is running, and the
stream's commit manifest (``tidemart.streaming.manifest``) says how many rows
are done, so a restarted stream goes on at the next row.  The driver reads
footers only; rows are read by tasks, as Arrow batches, from the row groups
that hold them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidemart.session import ship_library
from tidemart.sources.files import footer, parquet_files, read_rows
from tidemart.streaming.manifest import committed_rows

FORMAT = "tidemart_segments"
#: Rows of one segment that a single task reads.
TASK_ROWS = 25_000


class Slice(InputPartition):
    def __init__(self, file: str, first: int, n: int) -> None:
        self.file, self.first, self.n = file, first, n


class SegmentReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict) -> None:
        self.columns, self.path = schema.fieldNames(), options["path"]
        self.rows, self.root = int(options["rows"]), options["warehouse"]
        self.known: dict[str, int] = {}
        self.done: int | None = None

    def _files(self) -> list[tuple[str, int]]:
        """(file, rows) in order; footers are read once."""
        files = parquet_files(self.path)
        if files[: len(self.known)] != list(self.known):
            raise ValueError(f"{self.path}: files came before those already read, or are gone")
        for name in files[len(self.known):]:
            self.known[name] = footer(self.path, name).num_rows
        return list(self.known.items())

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        if self.done is None:
            self.done = committed_rows(self.root)
        return {"row": min(self.done + self.rows, sum(n for _, n in self._files()))}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        """A batch begins: what lies before its end is done or about to be."""
        self.done = end["row"]
        out, at = [], 0
        for name, n in self._files():
            low, high = max(start["row"], at), min(end["row"], at + n)
            out += [Slice(name, i - at, min(TASK_ROWS, high - i)) for i in range(low, high, TASK_ROWS)]
            at += n
        if at < end["row"]:
            raise ValueError(f"{self.path}: rows up to {end['row']} were planned, {at} are there")
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return read_rows(self.path, partition.file, partition.first, partition.n, self.columns)


class SegmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> SegmentReader:
        return SegmentReader(schema, dict(self.options))


def segment_stream(spark: SparkSession, landing: str, schema: StructType, rows: int, warehouse: str) -> DataFrame:
    """The landed feed as a stream of segments of ``rows`` rows; ``warehouse`` is where the stream commits."""
    ship_library(spark)
    spark.dataSource.register(SegmentSource)
    return spark.readStream.format(FORMAT).schema(schema).option("rows", rows).option("warehouse", warehouse).load(landing)

"""Shared helpers: table reading, code shipping, shared scratch tables and files."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, StructField, StructType

from tidemart.session import shared_scratch_dir

_SHIPPED: set[str] = set()

#: Rows of one Arrow batch: a batch is held whole by a Python worker, so with
#: the longest texts (about 120 KB) a worker holds some tens of MB.
BATCH_ROWS = 500
#: Groups of rows that a task reads before it works on them, in bytes.
GROUP_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Make the library importable on executors and bound the Arrow batches."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="tidemart-code-"), "tidemart_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("tidemart", os.path.relpath(full, package)))
        spark.sparkContext.addPyFile(path)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # Spark's default: the caller chose nothing
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared scratch folder and read back (cuts lineage)."""
    spark = df.sparkSession
    path = shared_scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, label: str) -> str:
    return shared_scratch_dir(spark, label)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a URI; used inside tasks for own formats."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:") and not uri.startswith("file://"):
            uri = "file://" + uri[len("file:"):]
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


class TaskFile:
    """A file written by one task: readers see it only whole.

    Bytes go to a name of this attempt; ``close`` renames it to the final,
    deterministic name, so a retried or speculative task replaces its twin's
    file by an equal one.
    """

    def __init__(self, folder: str, name: str) -> None:
        self.fs, base = filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.final = f"{base}/_{name}.{uuid.uuid4().hex}", f"{base}/{name}"
        self.uri = f"{folder.rstrip('/')}/{name}"
        self.out = self.fs.open_output_stream(self.path)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.path, self.final)


def open_input(uri: str) -> pa.NativeFile:
    fs, path = filesystem(uri)
    return fs.open_input_file(path)


def extended(df: DataFrame, **fields: str) -> StructType:
    """The schema of df with more fields, given as name=type."""
    return StructType([*df.schema.fields, *(StructField(n, DataType.fromDDL(t)) for n, t in fields.items())])


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], least: int) -> Iterator[pa.Table]:
    """Tables of whole groups of rows sorted by ``keys``, of ``least`` bytes or more but the last.

    Holds no more than that, one group and one batch.
    """
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for b in batches:
        if not b.num_rows:
            continue
        columns = [column(b, k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = last is not None and last != [c[0] for c in columns]
        last = [c[-1] for c in columns]
        size += b.nbytes
        if size >= least and new.any():
            cut = int(np.flatnonzero(new)[-1])
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            b = b.slice(cut)
            held, size = [], b.nbytes
        held.append(b)
    if held:
        yield pa.Table.from_batches(held)


def emit(rows: list[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(rows), size):
        part = rows[i : i + size]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema, strict=True)], schema=schema)

"""Commit manifest of a streamed warehouse: a batch counts once its entry is there.

A micro-batch writes several tables (facts, rejects, dimension members).  Each
write is atomic by itself, together they are not; so the batch's manifest entry
is written last, under one name, in one move.  Readers take the rows of batches
that have an entry and nothing else: a batch that fails between two tables is
invisible until its replay has written all of them.

Batches commit in order, so the entries' numbers are 0 .. n and a reader needs
the last one only.  An entry holds the batch's rows and those of all batches up
to it.
"""

from __future__ import annotations

import json
import re
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.facts import read_or_empty
from tidemart.sources.files import filesystem

_ENTRY = re.compile(r"batch-(\d{12})\.json$")


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def _entry(root: str, batch_id: int) -> dict | None:
    fs, path = filesystem(f"{_folder(root)}/batch-{batch_id:012d}.json")
    if fs.get_file_info(path).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def last_commit(root: str) -> dict | None:
    """The newest entry: batch_id, rows, rows_upto.

    Entries are numbered without gaps, so it is found by doubling and halving:
    a look-up costs the logarithm of the number of batches, no listing."""
    if _entry(root, 0) is None:
        return None
    step = 1
    while _entry(root, step) is not None:
        step *= 2
    low, high = step // 2, step
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if _entry(root, mid) is not None else (low, mid)
    return _entry(root, low)


def committed_rows(root: str) -> int:
    last = last_commit(root)
    return last["rows_upto"] if last else 0


def commit(root: str, batch_id: int, rows: int) -> dict:
    """Make a batch visible.  A replay of a batch writes the same entry again."""
    before = _entry(root, batch_id - 1) if batch_id else {"rows_upto": 0}
    if before is None:
        raise RuntimeError(f"batch {batch_id} follows a batch that has not been committed")
    entry = {"batch_id": batch_id, "rows": rows, "rows_upto": before["rows_upto"] + rows}
    there = _entry(root, batch_id)
    if there is not None:
        if there != entry:
            raise RuntimeError(f"batch {batch_id} was committed with {there['rows']} rows, its replay has {rows}")
        return there
    fs, folder = filesystem(_folder(root))
    fs.create_dir(folder, recursive=True)
    part = f"{folder}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as f:
        f.write(json.dumps(entry).encode())
    fs.move(part, f"{folder}/batch-{batch_id:012d}.json")
    return entry


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All entries as a table: batch_id, rows, rows_upto."""
    return spark.read.schema("batch_id long, rows long, rows_upto long").json(_folder(root))


def committed(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    """The rows of a table of all committed batches (``schema`` with batch_id)."""
    last = last_commit(root)
    rows = read_or_empty(spark, f"{root.rstrip('/')}/{table}", schema)
    return rows.where(F.col("batch_id") <= F.lit(last["batch_id"] if last else -1))

"""Parquet files of a folder, seen from Python data sources: names, footers and row ranges.

Used where a data source of this library reads files itself (row segments of a
stream, key ranges of a master).  ``pyarrow.fs`` opens local and shared paths,
hdfs, s3 and gs by their URI.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a URI; a path without scheme is local."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def parquet_files(uri: str) -> list[str]:
    """The data files below a folder (or the file itself), by name."""
    fs, path = filesystem(uri)
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type == pafs.FileType.NotFound:
        return []
    found = fs.get_file_info(pafs.FileSelector(path, recursive=True))
    names = (f.path for f in found if f.type == pafs.FileType.File and f.path.endswith(".parquet"))
    return sorted(n for n in names if not any(p[:1] in "._" for p in n[len(path):].strip("/").split("/")))


def footer(uri: str, file: str) -> pq.FileMetaData:
    fs, _ = filesystem(uri)
    with fs.open_input_file(file) as f:
        return pq.read_metadata(f)


def read_rows(uri: str, file: str, first: int, n: int, columns: list[str], batch_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Rows first .. first + n - 1 of a file; only the row groups that hold them are decoded."""
    fs, _ = filesystem(uri)
    with fs.open_input_file(file) as f:
        reader = pq.ParquetFile(f)
        at, groups, skip = 0, [], 0
        for g in range(reader.metadata.num_row_groups):
            size = reader.metadata.row_group(g).num_rows
            if at + size > first and at < first + n:
                if not groups:
                    skip = first - at
                groups.append(g)
            at += size
        left = n
        for batch in reader.iter_batches(batch_rows, groups, columns):
            if skip >= batch.num_rows:
                skip -= batch.num_rows
                continue
            batch = batch.slice(skip, left)
            skip, left = 0, left - batch.num_rows
            yield batch
            if not left:
                return

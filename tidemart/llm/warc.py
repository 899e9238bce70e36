"""WARC archives compressed record by record with a zstandard dictionary.

File layout (as public tools for ``.warc.zst`` read it): a leading skippable
frame (magic 0x184D2A5D) holds the dictionary; each record is a frame of its
own that needs it, so any record can be read alone.  The dictionary is trained
once for an archive set, from the records - header and block - of at most
``TRAIN_RECORDS`` pages (of each the first ``TRAIN_BYTES`` characters of the
payload), chosen by a hash over the whole table; what it holds changes sizes
only, never what is read back.

A task writes files of about ``FILE_BYTES`` and starts a new one beyond.  Of the
records with equal payloads (by SHA-1) the one with the largest page_id is a
response, the others revisit it; the largest id of each payload is a
pre-aggregated maximum, and the join that brings it back to the pages is one
that Spark splits when a payload is very frequent.

Defined results: a null html is an empty payload; a null url is written as an
empty target; a null page_id never becomes the response that others revisit,
unless all records of its payload lack an id: then all are responses; rows with
one page_id and payload are equal: if it is the largest id, all of them are
responses; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common

MAGIC = 0x184D2A5D
DICT_BYTES = 64 << 10
TRAIN_RECORDS, TRAIN_BYTES = 1000, 8 << 10
FILE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Archives of one table are equal in every run, so the date is a parameter.
DATE = "2000-01-01T00:00:00Z"


def train(payloads: list[bytes], size: int = DICT_BYTES, urls: list[str | None] | None = None, date: str = DATE) -> bytes:
    """A dictionary of at most ``size`` bytes from the records that archive these payloads; of too few, their plain content."""
    urls = urls or [None] * len(payloads)
    samples = [record(i, u, p, None, False, date) for i, (p, u) in enumerate(zip(payloads, urls, strict=True)) if p]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too short to train on
        return b"".join(samples)[:size]


def sample(pages: DataFrame, html_col: str = "html") -> tuple[list[bytes], list[str | None]]:
    """Bounded sample for ``train``, payloads and urls: beginnings of the pages with the smallest hashes of their id."""
    chosen = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(TRAIN_RECORDS)
    read = pages.select("page_id", "url", F.substring(html_col, 1, TRAIN_BYTES).alias("html")).where("html <> ''")
    rows = read.join(F.broadcast(chosen), "page_id").select("html", "url").distinct().limit(TRAIN_RECORDS).collect()
    rows = sorted((r["html"].encode(), r["url"] or "") for r in rows)
    return [p for p, _ in rows], [u for _, u in rows]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(text: str) -> int | None:
    inner = text.strip()[len("<urn:x-page:") : -1]
    return int(inner) if inner else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", urn(page_id)), ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", "sha1:" + digest(payload))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


class Writer:
    """Writes one archive; the dictionary comes first."""

    def __init__(self, folder: str, name: str, dictionary: bytes, level: int = 3) -> None:
        self.file, self.records = common.TaskFile(folder, name), 0
        self.file.write(struct.pack("<II", MAGIC, len(dictionary)) + dictionary)
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if data is not None:
            data.precompute_compress(level=level)
        self.packer = zstandard.ZstdCompressor(dict_data=data) if data is not None else zstandard.ZstdCompressor(level=level)

    def add(self, raw: bytes) -> None:
        self.file.write(self.packer.compress(raw))
        self.records += 1

    def close(self) -> None:
        self.file.close()


def frame_end(data: memoryview, at: int) -> int:
    """Where the zstandard frame that begins at ``at`` ends: its blocks say how long they are."""
    p = at + zstandard.frame_header_size(data[at : at + 18])
    while True:
        head = int.from_bytes(data[p : p + 3], "little")
        p += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return p + 4 * zstandard.get_frame_parameters(data[at : at + 18]).has_checksum


def records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of an archive."""
    with common.open_input(uri) as f:
        data = memoryview(f.read())
    magic, size = struct.unpack("<II", data[:8])
    if magic != MAGIC:
        raise ValueError(f"{uri} has no leading dictionary frame")
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[8 : 8 + size])) if size else None)
    at = 8 + size
    while at < len(data):
        end = frame_end(data, at)
        raw = unpack.decompress(data[at:end])
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
        length = int(fields["Content-Length"])
        if version != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
            raise ValueError(f"{uri}: damaged record at {at}")
        yield fields, rest[:length]
        at = end


def write(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = DATE, html_col: str = "html") -> DataFrame:
    """Archive all pages; the manifest: uri, n_records, n_bytes."""
    spark = pages.sparkSession
    common.prepare(spark)
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    payloads, urls = sample(read)
    dictionary = train(payloads, urls=urls, date=date)
    keyed = read.withColumn("digest", F.unhex(F.sha1("html")))
    many = (
        keyed.where(F.octet_length("html") >= min_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done, part = None, [], TaskContext.get().partitionId()

        def close() -> None:
            out.close()
            done.append((out.file.uri, out.records, out.file.size))

        for b in batches:
            for page_id, url, html, response in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if out is None:
                    out = Writer(folder, f"pages-{part:06d}-{len(done):04d}.warc.zst", dictionary)
                revisit = response is not None and response != page_id
                out.add(record(page_id, url, html.encode(), response if revisit else None, revisit, date))
                if out.file.size >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield from common.emit(done, pa.schema([("uri", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())]))

    dealt = keyed.join(many, "digest", "left").select("page_id", "url", "html", "response_id")
    return common.stored(dealt.mapInArrow(run, "uri string, n_records long, n_bytes long"), "warc-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload: every record of the archives.

    A response's payload is held against its digest; a revisit has none (null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for uri in (u for b in batches for u in b.column(0).to_pylist()):
            rows = []
            for fields, block in records(uri):
                http, _, payload = block.partition(b"\r\n\r\n")
                length = int(http.rpartition(b"Content-Length: ")[2])
                named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                kind, target = fields["WARC-Type"], fields.get("WARC-Refers-To")
                if kind == "response" and (digest(payload) != named or len(payload) != length):
                    raise ValueError(f"{uri}: the payload of {fields['WARC-Record-ID']} is not what its digest says")
                rows.append((page_of(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], length, named, kind, page_of(target) if target else None, payload if kind == "response" else None))
                if len(rows) == common.BATCH_ROWS:
                    yield from common.emit(rows, schema)
                    rows = []
            yield from common.emit(rows, schema)

    each = manifest.select("uri").repartition(common.parts(manifest.sparkSession), "uri")
    return each.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")

"""Suffix-array dedup: every byte covered by a long string that also starts elsewhere.

1. *Segments.*  Every window of ``k`` bytes contains ``k - GRAM + 1`` grams; its
   leftmost smallest gram (by hash) is its anchor.  Equal windows have equal
   anchors at equal offsets, and consecutive windows with one anchor form a
   segment of at most ``2 * k`` bytes.  A segment is a row (anchor, digest, text,
   start, length); no window is left out, and windows can only be equal within
   one segment text or between segments of one anchor.
2. *Equal segments* are counted by digest, pre-aggregated: a passage or a copy
   that a third of the documents share is one row for each task.  A segment that
   occurs twice is repeated whole.
3. *Contested anchors* have several different segments.  One instance of each is
   brought together by anchor in shards of about ``SHARD_BYTES``, and each shard
   is sorted: ``induced`` builds its suffix array with common-prefix values by
   external induced sorting, in bounded memory.  A suffix that shares ``k`` bytes
   with a neighbour starts a repeated window.
4. *Hot anchors*, whose different segments exceed ``HOT_BYTES``, would make one
   shard grow with the data.  Their windows are counted one by one instead, by
   128-bit digests, pre-aggregated and spread over all tasks.
5. The covered bytes of the segments are brought back to all their occurrences.

Segments are told apart by 128-bit digests, texts by MD5.

Defined results: a null text is empty; texts shorter than ``k`` bytes lose
nothing; equal texts, repeated rows and rows without ``doc_id`` count as
occurrences like all others; overlapping occurrences within one text count; a
removed run may end inside a character, so ``kept`` is binary; empty tables give
no rows; other columns pass through unchanged, but the result's own columns
replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common, induced, textops

K, GRAM = 400, 64
#: Bytes of different segments in a shard, under one anchor of a shard, and of the sort's queues in memory.
SHARD_BYTES, HOT_BYTES, QUEUE_BYTES = 4 << 20, 32 << 20, 96 << 20
#: Bytes of texts cut into segments at once: the arrays of a slice stay in the processor's cache.
SLICE = 1 << 16
_TEXT, _KEY, _CUTS = "__td_text", "__td_key", "__td_cuts"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each position on; gram is a power of two, 8 or more."""
    n = len(data) - 7
    h = np.empty(n, np.uint64)
    for r in range(8):  # the eight bytes from r, r + 8, ... on
        part = h[r::8]
        part[:] = np.frombuffer(data[r : r + 8 * len(part)].tobytes(), np.uint64)
    h *= _A
    h ^= h >> np.uint64(29)
    have = 8
    while have < gram:
        x = h[:-have] * _A
        x ^= h[have:] * _B
        x ^= x >> np.uint64(32)
        h, have = x, 2 * have
    return textops.mix(h)


def _segments(data: np.ndarray, offsets: np.ndarray, k: int, gram: int):
    """(text, anchor, first byte in the text, bytes) of all segments."""
    at, text = textops.inside(offsets, k)
    if not len(at):
        return None
    h = _gram_hashes(data, gram)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, have = k - gram + 1, 1
    while have < width:  # sliding minimum by doubling
        step = min(have, width - have)
        key = np.minimum(key[:-step], key[step:])
        have += step
    anchor = (key[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    lo, hi = at[new], at[np.append(new[1:], len(at)) - 1]
    return text[new], h[anchor[new]].view(np.int64), lo - offsets[text[new]], hi + k - lo


def segments(docs: DataFrame, k: int = K, gram: int = GRAM) -> DataFrame:
    """doc_id, key, lo, n, anchor, digest of each segment of each text."""
    schema = "doc_id long, key binary, lo int, n int, anchor long, digest binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(common.column(b, _TEXT))
            ids, keys = common.column(b, "doc_id"), common.column(b, _KEY)
            for i, j in textops.slices(offsets, SLICE):
                part, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                if (found := _segments(part, o, k, gram)) is None:
                    continue
                text, anchor, lo, n = found
                raw, start = part.tobytes(), (lo + o[text]).tolist()
                digests = [hashlib.blake2b(raw[s : s + m], digest_size=16).digest() for s, m in zip(start, n.tolist(), strict=True)]
                at = pa.array(text + i)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), keys.take(at), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(anchor), pa.array(digests, pa.binary())],
                    ["doc_id", "key", "lo", "n", "anchor", "digest"],
                )

    return docs.select("doc_id", _KEY, _TEXT).mapInArrow(run, schema)


def _instances(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """anchor, digest, body: the bytes of the segments asked for (their source: doc_id, key, lo, n)."""
    schema = "anchor long, digest binary, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(common.column(b, _TEXT))
            lists = common.column(b, _CUTS)
            flat, size = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
            start = np.repeat(offsets[:-1], size) + flat.field("lo").to_numpy()
            n = flat.field("n").to_numpy()
            for i in range(0, len(start), 2000):
                body = [data[s : s + m].tobytes() for s, m in zip(start[i : i + 2000].tolist(), n[i : i + 2000].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([flat.field("anchor")[i : i + 2000], flat.field("digest")[i : i + 2000], pa.array(body, pa.binary())], ["anchor", "digest", "body"])

    by_text = asked.groupBy("doc_id", "key").agg(F.collect_list(F.struct("lo", "n", "anchor", "digest")).alias(_CUTS))
    by_text = common.stored(by_text.select(F.col("doc_id").alias("__td_id"), F.col("key").alias(_KEY), _CUTS), "segments-asked")
    read = docs.select("doc_id", _KEY, _TEXT)
    joined = read.join(by_text, (read[_KEY] == by_text[_KEY]) & read["doc_id"].eqNullSafe(by_text["__td_id"])).select(_TEXT, _CUTS)
    return joined.mapInArrow(run, schema).dropDuplicates(["anchor", "digest"])


_COVERS = pa.schema([("anchor", pa.int64()), ("digest", pa.binary()), ("lo", pa.int32()), ("n", pa.int32())])


def _runs_of(starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, bytes) of the runs that windows of k bytes cover; starts ascend."""
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > starts[:-1] + k
    lo = starts[new]
    return lo, starts[np.append(np.flatnonzero(new)[1:], len(starts)) - 1] + k - lo


def sorted_shards(bodies: DataFrame, k: int, folder: str) -> DataFrame:
    """anchor, digest, lo, n: covered runs of segments; rows of a ``shard`` are sorted together."""

    def covers(rows: list[tuple[int, bytes, bytes]]) -> list[tuple]:
        sizes = np.array([len(r[2]) for r in rows])
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        text = np.ones(int(first[-1]) + 1, np.uint16)  # 1 between segments, 0 at the end
        text[-1] = 0
        for (_, _, body), at in zip(rows, first.tolist(), strict=False):
            text[at : at + len(body)] = np.frombuffer(body, np.uint8)
            text[at : at + len(body)] += 2
        spill = induced.Spill(f"{folder}/{uuid.uuid4().hex}", QUEUE_BYTES)  # of this attempt alone
        try:
            starts = np.flatnonzero(induced.shared_with_another(text, k, spill))
        finally:
            spill.close()
        whose = np.searchsorted(first, starts, "right") - 1
        inside = starts + k <= first[whose] + sizes[np.minimum(whose, len(sizes) - 1)]  # else a separator is in the window
        starts, whose = starts[inside], whose[inside]
        out = []
        cut = np.append(np.flatnonzero(np.diff(whose, prepend=-1)), len(whose))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            r = rows[int(whose[a])]
            lo, n = _runs_of(starts[a:b] - first[whose[a]], k)
            out += [(r[0], r[1], x, y) for x, y in zip(lo.tolist(), n.tolist(), strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for b in batches:
            for s, anchor, digest, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != shard and rows:
                    yield from common.emit(covers(rows), _COVERS)
                    rows = []
                shard = s
                rows.append((anchor, digest, body))
        if rows:
            yield from common.emit(covers(rows), _COVERS)

    n = common.parts(bodies.sparkSession)  # shards take turns: by a hash, several would meet in one task
    placed = bodies.select("shard", "anchor", "digest", "body").repartitionById(n, F.col("shard").cast("int")).sortWithinPartitions("shard")
    return placed.mapInArrow(run, "anchor long, digest binary, lo int, n int")


def counted_windows(bodies: DataFrame, k: int) -> DataFrame:
    """The same for hot anchors, window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for anchor, digest, body in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                windows = [hashlib.blake2b(body[i : i + k], digest_size=16).digest() for i in range(len(body) - k + 1)]
                m = len(windows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, anchor)), pa.array([digest] * m, pa.binary()), pa.array(np.arange(m, dtype=np.int32)), pa.array(windows, pa.binary())],
                    ["anchor", "digest", "lo", "window"],
                )

    windows = common.stored(bodies.select("anchor", "digest", "body").mapInArrow(run, "anchor long, digest binary, lo int, window binary"), "hot-windows")
    repeated = common.stored(windows.groupBy("window").count().where("count > 1").select("window"), "hot-windows-repeated")
    return windows.join(repeated, "window").select("anchor", "digest", "lo", F.lit(k).alias("n"))


def covers(docs: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """anchor, digest, lo, n: repeated runs of bytes of the distinct segments."""
    spark = docs.sparkSession
    distinct = rows.groupBy("anchor", "digest").agg(F.count("*").alias("times"), F.min(F.struct("doc_id", "key", "lo", "n")).alias("source"))
    distinct = common.stored(distinct.select("anchor", "digest", "times", "source.*"), "segments-distinct")
    whole = distinct.where("times > 1").select("anchor", "digest", F.lit(0).alias("lo"), "n")
    anchors = distinct.groupBy("anchor").agg(F.count("*").alias("texts"), F.sum("n").alias("bytes")).where("texts > 1")
    anchors = common.stored(anchors.select("anchor", "bytes"), "anchors-contested")
    normal, hot = F.col("bytes") <= HOT_BYTES, F.col("bytes") > HOT_BYTES
    size, n_hot = anchors.agg(F.sum(F.when(normal, F.col("bytes"))), F.count(F.when(hot, 1))).first()
    if size is None and not n_hot:
        return whole
    shards = int((size or 0) // SHARD_BYTES) + 1
    asked = distinct.join(anchors, "anchor").select("doc_id", "key", "lo", "n", "anchor", "digest")
    bodies = common.stored(_instances(docs, asked), "segments-contested").join(anchors, "anchor")
    found = whole
    if size is not None:
        shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
        found = found.union(sorted_shards(bodies.where(normal).select("*", shard), k, common.scratch(spark, "suffix-queues")))
    if n_hot:
        found = found.union(counted_windows(bodies.where(hot), k))
    return found


def remove_repeats(docs: DataFrame, text_col: str = "text", k: int = K, gram: int = GRAM) -> DataFrame:
    """The documents with n_bytes, n_removed, n_spans (maximal removed runs) and kept (the bytes left)."""
    common.prepare(docs.sparkSession)
    own = ["n_bytes", "n_removed", "n_spans", "kept"]
    base = docs.drop(*own).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = base.withColumn(_TEXT, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    keyed = keyed.withColumn(_KEY, F.unhex(F.md5(F.col(_TEXT).cast("binary"))))
    rows = common.stored(segments(keyed, k, gram), "segments")
    found = common.stored(covers(keyed, rows, k).toDF("anchor", "digest", "at", "bytes"), "covers")
    cuts = rows.join(found, ["anchor", "digest"]).select("key", (F.col("lo") + F.col("at")).alias("lo"), F.col("bytes").alias("n")).distinct()
    cuts = common.stored(cuts.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("lo", "n"))).alias(_CUTS)).withColumnRenamed("key", _KEY), "cuts")
    joined = keyed.join(cuts, _KEY, "left").select(*base.columns, _TEXT, _CUTS)
    out = common.extended(base, n_bytes="long", n_removed="long", n_spans="long", kept="binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(common.column(b, _TEXT))
            lists = common.column(b, _CUTS)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            at, flat = np.concatenate([[0], np.cumsum(size)]), lists.flatten()
            lo, n = (flat.field(c).to_numpy().astype(np.int64) for c in ("lo", "n"))
            removed, spans, kept = [], [], []
            for i in range(b.num_rows):
                body = data[offsets[i] : offsets[i + 1]]
                a, e = lo[at[i] : at[i + 1]], (lo + n)[at[i] : at[i + 1]]
                if len(a):  # a run starts where no earlier one reaches
                    reach = np.maximum.accumulate(e)
                    new = np.flatnonzero(np.append(True, a[1:] > reach[:-1]))
                    a, e = a[new], reach[np.append(new[1:], len(reach)) - 1]
                    edges = np.concatenate([[0], np.stack([a, e], 1).ravel(), [len(body)]])
                    kept.append(b"".join(body[x:y].tobytes() for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)))
                else:
                    kept.append(body.tobytes())
                removed.append(int((e - a).sum()))
                spans.append(len(a))
            cols = [b.column(x) for x in range(b.num_columns - 2)]
            more = [pa.array(x, pa.int64()) for x in (np.diff(offsets), removed, spans)]
            yield pa.RecordBatch.from_arrays([*cols, *more, pa.array(kept, pa.binary())], names=[f.name for f in out])

    return joined.mapInArrow(run, out)

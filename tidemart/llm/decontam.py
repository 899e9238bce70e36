"""Benchmark decontamination: a distributed positional inverted index.

``build`` stores an index of the training texts, sharded by document: each row
holds a few MB of text as sorted term hashes (64 bits), the offsets of their
postings and the postings (positions in the shard, ascending for each term).
Phrases lie within one document, so shards answer alone and building needs no
shuffle; a hot term is split over all shards.

Test phrases are looked up in every shard.  For each phrase the terms are
ordered by the length of their posting lists; the rarest list, moved back by
the term's offset, gives the candidate starts, and the other lists are
intersected one by one at their own offsets by binary search.  Phrases with a
term that the shard lacks cost nothing.  The test items are read in blocks of
bounded size (``BLOCK_BYTES``), each block in one pass over the stored index,
so any number of items can be searched.

Defined results: null text and null items have no words; an item of fewer
words than the window is one phrase, an item without words none; items with a
null id mark hit words but are not listed; repeated rows give equal rows; the
tables' other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common, textops

WINDOW = 10
SHARD_BYTES = 8 << 20
#: Text of the test items that one pass over the index looks up.  Driver and tasks hold about 20 bytes of
#: windows for each byte of it.
BLOCK_BYTES = 4 << 20

_INDEX = "shard long, doc_ids array<long>, first binary, terms binary, offsets binary, postings binary"


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and each text's first word (n + 1)."""
    data, offsets = textops.buffers(texts)
    starts, ends, first = textops.scan(data, offsets, textops.ALNUM)
    return textops.hashes(data, starts, ends, textops.FOLD), first


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: term -> positions, by shards of about SHARD_BYTES of text."""
    common.prepare(docs.sparkSession)

    def shard(number: int, ids: list[pa.Array], texts: list[pa.Array]) -> pa.RecordBatch:
        h, first = words_of(pa.concat_arrays(texts))
        order = np.argsort(h, kind="stable")
        terms, at = np.unique(h[order], return_index=True)
        cols = [
            pa.array([number]), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())), pa.array([first.astype(np.int32).tobytes()]),
            pa.array([terms.tobytes()]), pa.array([np.append(at, len(h)).astype(np.int32).tobytes()]), pa.array([order.astype(np.uint32).tobytes()]),
        ]
        return pa.RecordBatch.from_arrays(cols, ["shard", "doc_ids", "first", "terms", "offsets", "postings"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, number = [], [], 0, TaskContext.get().partitionId() << 32
        for b in batches:
            ids.append(b.column(0))
            texts.append(b.column(1))
            size += b.column(1).nbytes
            if size >= SHARD_BYTES:
                yield shard(number, ids, texts)
                ids, texts, size, number = [], [], 0, number + 1
        if texts:
            yield shard(number, ids, texts)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return common.stored(read.mapInArrow(run, _INDEX), "positional-index")


class _Shard:
    """One row of the index."""

    def __init__(self, row: dict) -> None:
        self.number, self.doc_ids = row["shard"], row["doc_ids"]
        self.first = np.frombuffer(row["first"], np.int32).astype(np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.offsets = np.frombuffer(row["offsets"], np.int32).astype(np.int64)
        self.postings = np.frombuffer(row["postings"], np.uint32)
        # (term, position) ascending: one binary search finds a posting of any term
        self.keys = (np.repeat(np.arange(len(self.terms), dtype=np.uint64), np.diff(self.offsets)) << np.uint64(32)) | self.postings

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each term here, and the length of its list (0: absent)."""
        at = np.minimum(np.searchsorted(self.terms, terms), max(0, len(self.terms) - 1))
        if not len(self.terms):
            return at, np.zeros(terms.shape, np.int64)
        return at, np.where(self.terms[at] == terms, self.offsets[at + 1] - self.offsets[at], 0)

    def phrases(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrase number and start of each occurrence of phrases of one length."""
        term, size = self.lists(phrases)
        alive = np.flatnonzero(size.all(axis=1))
        if not len(alive):
            return alive, alive
        rare = np.argsort(size[alive], axis=1, kind="stable")
        term, count = term[alive], np.take_along_axis(size[alive], rare[:, :1], 1)[:, 0]
        phrase = np.repeat(np.arange(len(alive)), count)
        lead = np.take_along_axis(term, rare[:, :1], 1)[:, 0]
        nth = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
        start = self.postings[self.offsets[lead][phrase] + nth].astype(np.int64) - rare[phrase, 0]
        doc = np.searchsorted(self.first, start, "right") - 1
        ok = (start >= 0) & (start + phrases.shape[1] <= self.first[np.minimum(doc + 1, len(self.first) - 1)])
        phrase, start = phrase[ok], start[ok]
        for j in range(1, phrases.shape[1]):
            at = rare[phrase, j]
            want = (term[phrase, at].astype(np.uint64) << np.uint64(32)) | (start + at).astype(np.uint64)
            found = self.keys[np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)] == want
            phrase, start = phrase[found], start[found]
        return alive[phrase], start

    def near(self, terms: np.ndarray, slop: int) -> list[tuple[int, int]]:
        """(first, last) position of each shortest run of at most ``slop`` words of one text with all terms."""
        terms = np.unique(terms)
        at, size = self.lists(terms)
        if not len(terms) or not size.all():
            return []
        lead = int(np.argmin(size))
        rare = self.postings[self.offsets[at[lead]] : self.offsets[at[lead] + 1]].astype(np.int64)
        pos, label = [], []
        for n, t in enumerate(at):
            p = self.postings[self.offsets[t] : self.offsets[t + 1]].astype(np.int64)
            i = np.searchsorted(rare, p)
            gap = np.minimum(np.abs(p - rare[np.maximum(i - 1, 0)]), np.abs(p - rare[np.minimum(i, len(rare) - 1)]))
            pos.append(p[gap < slop])
            label.append(np.full(int((gap < slop).sum()), n))
        pos, label = np.concatenate(pos), np.concatenate(label)
        order = np.argsort(pos, kind="stable")
        pos, label = pos[order].tolist(), label[order].tolist()
        doc = (np.searchsorted(self.first, pos, "right") - 1).tolist()
        last: dict[int, int] = {}
        out: list[tuple[int, int]] = []
        for p, l, d in zip(pos, label, doc, strict=True):
            last[l] = p
            if len(last) == len(terms):
                a = min(last.values())
                if p - a < slop and a >= self.first[d]:
                    while out and out[-1][0] <= a and out[-1][1] >= p:
                        out.pop()
                    if not out or not (out[-1][0] >= a and out[-1][1] <= p):
                        out.append((a, p))
        return out


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, str]]]:
    """The items as (id, text), in blocks of about BLOCK_BYTES; equal items once."""
    read = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    read = common.stored(read.distinct(), "benchmark-items")
    size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // BLOCK_BYTES) + 1
    for i in range(n):
        yield [(r[0], r[1]) for r in read.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i).collect()]


class Phrases(NamedTuple):
    """Distinct windows of one length (a row each); those of row r come from the items ``item[at[r] : at[r + 1]]``."""

    windows: np.ndarray
    at: np.ndarray
    item: np.ndarray


def phrases_of(texts: list[str], window: int) -> list[Phrases]:
    """The distinct windows of all texts by length; a text of fewer words is one window, of none has none."""
    h, first = words_of(pa.array(texts, pa.string()))
    size = np.minimum(np.diff(first), window)
    out = []
    for n in np.unique(size[size > 0]).tolist():
        own = np.flatnonzero(size == n)
        count = first[own + 1] - first[own] - n + 1
        item = np.repeat(own, count)
        start = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[own], count)
        rows = np.ascontiguousarray(h[start[:, None] + np.arange(n)])
        _, lead, which = np.unique(rows.view(f"V{8 * n}").ravel(), return_index=True, return_inverse=True)
        pair = np.unique(which.astype(np.int64) * len(texts) + item)
        out.append(Phrases(rows[lead], np.searchsorted(pair // len(texts), np.arange(len(lead) + 1)), (pair % len(texts)).astype(np.int32)))
    return out


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """shard, nth, items, spans: the documents (nth of the shard) in which phrases occur.

    spans are the hit words [lo, hi) of the document, merged."""
    schema = "shard long, nth int, items array<string>, spans array<struct<lo:int,hi:int>>"
    found = None
    for block in _blocks(items, id_col, text_col):
        ids = [name for name, _ in block]
        phrases = phrases_of([text for _, text in block], window)

        def run(batches: Iterator[pa.RecordBatch], phrases=phrases, ids=ids) -> Iterator[pa.RecordBatch]:
            for row in (r for b in batches for r in b.to_pylist()):
                s = _Shard(row)
                spans, names = defaultdict(list), defaultdict(set)
                for what in phrases:
                    n = what.windows.shape[1]
                    which, start = s.phrases(what.windows)
                    doc = np.searchsorted(s.first, start, "right") - 1
                    for w, a, d in sorted(zip(which.tolist(), (start - s.first[doc]).tolist(), doc.tolist(), strict=True), key=lambda x: x[1]):
                        names[d].update(ids[i] for i in what.item[what.at[w] : what.at[w + 1]] if ids[i] is not None)
                        spans[d].append((a, a + n))
                out = []
                for d, runs in spans.items():
                    merged: list[list[int]] = []
                    for a, b in sorted(runs):
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    out.append((s.number, d, sorted(names[d]), [{"lo": a, "hi": b} for a, b in merged]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES, strict=True)], ["shard", "nth", "items", "spans"])

        part = index.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return found


_TYPES = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))]


def proximity_matches(index: DataFrame, queries: dict[str, str], slop: int) -> DataFrame:
    """query, doc_id, lo, hi: runs of at most ``slop`` words that hold all words of a query."""
    names = list(queries)
    h, first = words_of(pa.array([queries[n] for n in names], pa.string()))
    asked = [(n, h[a:b]) for n, a, b in zip(names, first[:-1], first[1:], strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query", pa.string()), ("doc_id", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
        for row in (r for b in batches for r in b.to_pylist()):
            s, out = _Shard(row), []
            for name, terms in asked:
                for a, b in s.near(terms, slop):
                    d = int(np.searchsorted(s.first, a, "right")) - 1
                    out.append((name, s.doc_ids[d], a - int(s.first[d]), b + 1 - int(s.first[d])))
            yield from common.emit(out, schema)

    return index.mapInArrow(run, "query string, doc_id long, lo int, hi int")


def documents_of(index: DataFrame) -> DataFrame:
    """shard, nth, doc_id, n_words of every indexed document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, ids, first in zip(*(b.column(i) for i in range(3)), strict=True):
                n = np.diff(np.frombuffer(first.as_py(), np.int32)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), shard.as_py())), pa.array(np.arange(len(n), dtype=np.int32)), pa.array(ids.as_py(), pa.int64()), pa.array(n)], ["shard", "nth", "doc_id", "n_words"])

    return index.select("shard", "doc_ids", "first").mapInArrow(run, "shard long, nth int, doc_id long, n_words long")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted ids of items that occur), contaminated."""
    index = build(docs)
    found = phrase_matches(index, items, window).groupBy("shard", "nth").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    covered = F.expr("aggregate(spans, struct(0L as n, 0 as e), (x, s) -> struct(x.n + greatest(0, s.hi - greatest(s.lo, x.e)) as n, greatest(x.e, s.hi) as e), x -> x.n)")
    hits = found.select("shard", "nth", "items", covered.alias("hit"))
    out = documents_of(index).join(hits, ["shard", "nth"], "left")
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))

"""Ranked lexical search: best-first document intervals under range-maximum bounds.

``build`` stores an index of the documents, sharded by document: a row holds a
few MB of text as sorted term hashes (64 bits), the offsets of their posting
lists and the postings (document of the shard, occurrences).  Building needs no
shuffle, and a hot term is split over all shards.

``search`` reads each shard and, for the posting lists of the items' terms,
computes every posting's impact (the addend of the score) and a sparse table of
range maxima.  An interval of documents is bounded by the sum, over the item's
terms, of the largest impact in the interval - two look-ups for each term.  The
intervals of highest bound are opened first: the document of the largest single
impact is scored (an interval of one document is bounded by its own score), and
the documents left and right of it become two intervals with bounds of their
own.  An interval whose bound is below the item's tenth score is never opened.
Many intervals of many items are opened at once, so that a step is a few array
operations.

Two passes read the index: the first opens a few intervals of every shard and
yields a floor of each item's tenth score; the second searches to the end and
returns only documents that reach the floor, so what is ranked at last is small.

Scores are the 64-bit integers of the module's ``impacts``; terms are runs of
ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased.

Defined results: null text and null items have no terms; documents without
terms count nowhere; an item without terms, or whose terms occur nowhere, has no
rows; equal items (id and text) are ranked once, items of one id with several
texts each for themselves; rows with a null ``doc_id`` are ranked behind equal
scores; repeated documents are documents of their own; empty tables give no
rows; the tables' other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm import common, textops

TOP = 10
SHARD_BYTES = 16 << 20
#: Text of the items that one pass over the index looks up.
BLOCK_BYTES = 4 << 20
#: Intervals that one step opens for an item; smaller ones than LEAF documents
#: are opened into single documents.
WIDTH, LEAF = 48, 6
#: Steps of the first pass.
PROBES = 2
#: (interval, term) pairs that are bounded at once.
PAIRS = 1 << 20

_INDEX = "shard long, doc_ids array<long>, sizes binary, terms binary, offsets binary, docs binary, counts binary"
_FOUND = "item long, doc_id long, score long"
_LAST = np.iinfo(np.int64).max


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms and each text's first term (n + 1)."""
    data, offsets = textops.buffers(texts)
    starts, ends, first = textops.scan(data, offsets, textops.ALNUM)
    return textops.hashes(data, starts, ends, textops.FOLD), first


def impacts(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Addend of a term that occurs ``counts`` times in a document of norm ``lengths``."""
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * lengths))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _runs(first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run first .. first + n - 1: the run's number and the values, flat."""
    whose = np.repeat(np.arange(len(n)), n)
    return whose, np.arange(len(whose)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: term -> (document, occurrences), by shards of about SHARD_BYTES of text."""
    common.prepare(docs.sparkSession)

    def shard(number: int, ids: list[pa.Array], texts: list[pa.Array]) -> pa.RecordBatch:
        h, first = terms_of(pa.concat_arrays(texts))
        sizes = np.diff(first)
        order = np.argsort(h, kind="stable")
        h, doc = h[order], np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)[order]
        new_term = np.ones(len(h), bool)
        new_term[1:] = h[1:] != h[:-1]
        new = new_term.copy()
        new[1:] |= doc[1:] != doc[:-1]
        at = np.flatnonzero(new)
        cols = [
            pa.array([number]), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())), pa.array([sizes.astype(np.int64).tobytes()]),
            pa.array([h[new_term].tobytes()]), pa.array([np.append(np.flatnonzero(new_term[at]), len(at)).astype(np.int64).tobytes()]),
            pa.array([doc[at].tobytes()]), pa.array([np.diff(np.append(at, len(h))).astype(np.uint32).tobytes()]),
        ]
        return pa.RecordBatch.from_arrays(cols, ["shard", "doc_ids", "sizes", "terms", "offsets", "docs", "counts"])

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

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return common.stored(read.mapInArrow(run, _INDEX), "ranked-index")


class Items(NamedTuple):
    """A block of items: ``number[i]`` has the terms ``terms[term[at[i] : at[i + 1]]]``."""

    number: np.ndarray
    at: np.ndarray
    term: np.ndarray
    terms: np.ndarray


class _Shard:
    """One row of the index."""

    def __init__(self, row: dict) -> None:
        ids = pa.array(row["doc_ids"], pa.int64())
        self.null = ids.is_null().to_numpy(zero_copy_only=False)
        self.doc_ids = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.docs = np.frombuffer(row["docs"], np.uint32)
        self.counts = np.frombuffer(row["counts"], np.uint32)

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First posting of each term's list, and the list's length (0: absent)."""
        if not len(self.terms):
            return np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return self.offsets[at], np.where(self.terms[at] == terms, self.offsets[at + 1] - self.offsets[at], 0)


class _Search:
    """The items' posting lists of one shard with their sparse tables."""

    def __init__(self, shard: _Shard, items: Items, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.n = len(shard.sizes)
        first, size = shard.lists(items.terms)
        term, posting = _runs(first, size)
        doc = shard.docs[posting].astype(np.int64)
        norm = 10 + (90 * shard.sizes[doc] * n_docs) // n_terms
        self.impact = impacts(weights[term], shard.counts[posting].astype(np.int64), norm)
        self.doc = doc
        self.key = (term << 32) | doc  # ascending
        levels = [np.arange(len(doc), dtype=np.int32)]
        while 1 << len(levels) <= size.max(initial=0):
            half, last = 1 << (len(levels) - 1), levels[-1]
            a, b = last[:-half], last[half:]
            level = last.copy()
            level[: len(a)] = np.where(self.impact[a] >= self.impact[b], a, b)
            levels.append(level)
        self.best = np.stack(levels)
        # terms that the shard lacks bound nothing
        here = size[items.term] > 0
        self.term = items.term[here]
        self.at = np.concatenate([[0], np.cumsum(here)])[items.at]

    def bounds(self, item: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the terms' largest impacts in documents lo .. hi - 1, and the document of the largest one."""
        total, split = np.zeros(len(item), np.int64), np.full(len(item), -1)
        n = self.at[item + 1] - self.at[item]
        i, done = 0, np.cumsum(n)
        while i < len(item):  # pieces of about PAIRS (interval, term) pairs
            j = max(i + 1, int(np.searchsorted(done, (done[i - 1] if i else 0) + PAIRS, "right")))
            whose, at = _runs(self.at[item[i:j]], n[i:j])
            term = self.term[at].astype(np.int64) << 32
            a, b = np.searchsorted(self.key, term | lo[i:j][whose]), np.searchsorted(self.key, term | hi[i:j][whose])
            some = b > a
            whose, a, b = whose[some], a[some], b[some]
            if len(whose):
                level = np.frexp(b - a)[1] - 1
                x, y = self.best[level, a], self.best[level, b - (1 << level)]
                top = np.where(self.impact[x] >= self.impact[y], x, y)
                value = self.impact[top]
                start = np.flatnonzero(np.diff(whose, prepend=-1))
                own = whose[start]
                total[i + own] = np.add.reduceat(value, start)
                most = np.maximum.reduceat(value, start)
                at_most = np.flatnonzero(value == np.repeat(most, np.diff(np.append(start, len(value)))))
                split[i + own] = self.doc[top[at_most[np.searchsorted(at_most, start)]]]
            i = j
        return total, split


def _best(item: np.ndarray, score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k highest scores of each item (ties: smallest ``order``), and of all items' in item order."""
    by = np.lexsort((order, -score, item))
    start = np.flatnonzero(np.diff(item[by], prepend=-1))
    nth = np.arange(len(by)) - np.repeat(start, np.diff(np.append(start, len(by))))
    return by[nth < k]


def search_shard(shard: _Shard, items: Items, weights: np.ndarray, n_docs: int, n_terms: int, floor: np.ndarray, k: int, steps: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, document, score) of the shard's k best documents of each item that reach its floor."""
    s = _Search(shard, items, weights, n_docs, n_terms)
    count = len(items.number)
    item = np.arange(count)
    lo, hi = np.zeros(count, np.int64), np.full(count, s.n)
    bound, split = s.bounds(item, lo, hi)
    least = np.maximum(floor, 1)
    got = [np.zeros(0, np.int64)] * 3
    while steps is None or steps:
        steps = None if steps is None else steps - 1
        alive = bound >= least[item]
        item, lo, hi, bound, split = item[alive], lo[alive], hi[alive], bound[alive], split[alive]
        if not len(item):
            break
        opened = _best(item, bound, lo, WIDTH)
        rest = np.ones(len(item), bool)
        rest[opened] = False
        i, a, b, d = item[opened], lo[opened], hi[opened], split[opened]
        leaf = b - a <= LEAF
        whose, doc = _runs(a[leaf], (b - a)[leaf])
        one_item, one = np.concatenate([i[leaf][whose], i[~leaf]]), np.concatenate([doc, d[~leaf]])
        score, _ = s.bounds(one_item, one, one + 1)
        good = score >= least[one_item]
        got = [np.concatenate([x, y[good]]) for x, y in zip(got, (one_item, one, score), strict=True)]
        keep = _best(got[0], got[2], shard.doc_ids[got[1]], k)
        got = [x[keep] for x in got]
        full = np.flatnonzero(np.bincount(got[0], minlength=count) >= k)
        if len(full):
            last = np.searchsorted(got[0], full, "right") - 1
            least[full] = np.maximum(least[full], got[2][last])
        i, a, b, d = i[~leaf], a[~leaf], b[~leaf], d[~leaf]
        i, a, b = np.concatenate([i, i]), np.concatenate([a, d + 1]), np.concatenate([d, b])
        some = b > a
        i, a, b = i[some], a[some], b[some]
        more, where = s.bounds(i, a, b)
        item, lo, hi = np.concatenate([item[rest], i]), np.concatenate([lo[rest], a]), np.concatenate([hi[rest], b])
        bound, split = np.concatenate([bound[rest], more]), np.concatenate([split[rest], where])
    return got[0], got[1], got[2]


def _read_items(rows: list) -> Items:
    h, first = terms_of(pa.array([r["text"] for r in rows], pa.string()))
    own = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    terms, term = np.unique(np.concatenate([*own, np.zeros(0, np.uint64)]), return_inverse=True)
    at = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
    return Items(np.array([r["item"] for r in rows], np.int64), at, term.astype(np.int64), terms)


def _corpus(index: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0):
                sizes = np.frombuffer(x.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int((sizes > 0).sum())]), pa.array([int(sizes.sum())])], ["docs", "terms"])

    row = index.select("sizes").mapInArrow(run, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def _frequencies(index: DataFrame, items: Items) -> np.ndarray:
    """Documents that hold each term of the block; at most one number a term comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.terms), np.int64)
        for row in (r for b in batches for r in b.to_pylist()):
            terms, offsets = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["offsets"], np.int64)
            if len(terms):
                at = np.minimum(np.searchsorted(terms, items.terms), len(terms) - 1)
                total += np.where(terms[at] == items.terms, offsets[at + 1] - offsets[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    found = index.select("terms", "offsets").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(len(items.terms), np.int64)
    for r in found:
        out[r["term"]] = r["df"]
    return out


def _search(index: DataFrame, items: Items, weights: np.ndarray, n_docs: int, n_terms: int, floor: np.ndarray, k: int, steps: int | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            shard = _Shard(row)
            item, doc, score = search_shard(shard, items, weights, n_docs, n_terms, floor, k, steps)
            if len(item):
                ids = pa.array(shard.doc_ids[doc], mask=shard.null[doc])
                yield pa.RecordBatch.from_arrays([pa.array(items.number[item]), ids, pa.array(score)], ["item", "doc_id", "score"])

    return index.mapInArrow(run, _FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    distinct = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text")).distinct()
    named = common.stored(distinct.withColumn("item", F.monotonically_increasing_id()), "ranked-items")
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(size // BLOCK_BYTES) + 1
    n_docs, n_terms = _corpus(index)
    found = None
    for i in range(blocks):
        rows = named.where("text is not null").where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == i).select("item", "text").collect()
        block = _read_items(rows)
        weights = np.array([weight(n_docs, int(df)) for df in _frequencies(index, block)], np.int64)
        floor = np.zeros(len(block.number), np.int64)
        if n_terms:
            probed = _top(_search(index, block, weights, n_docs, n_terms, floor, k, PROBES), k).where(F.col("rank") == k).select("item", "score").collect()
            where = {int(n): j for j, n in enumerate(block.number)}
            for r in probed:
                floor[where[r["item"]]] = r["score"]
        part = _search(index, block, weights, n_docs, max(1, n_terms), floor, k, None)
        found = part if found is None else found.union(part)
    return _top(common.stored(found, "ranked-found"), k).join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

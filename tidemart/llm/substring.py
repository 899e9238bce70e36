"""Substring dedup: a de Bruijn graph of token windows, compacted and verified.

An edge of the graph is a window of ``k`` consecutive words.  Following the
edges through a document gives a walk; this module finds the edges that start
in two documents or more and removes each word covered by an edge that also
starts in a document with a smaller ``doc_id``.

1. *Paths instead of edges.*  Every window contains ``k - seed + 1`` seeds (runs
   of ``seed`` words); its leftmost smallest seed is its anchor.  Equal windows
   have equal anchors at equal offsets, so windows can only be equal below the
   same anchor, and consecutive windows with one anchor form one short walk:
   a row (seed, span, document, start, length) for about 20 windows.  No window
   is left out.
2. *Nonbranching paths.*  A span that starts in a smaller document is repeated
   whole.  Its rows are linked to their successors (the next row of the
   document that runs on in the same source document) by an equi-join, and
   linked rows are compacted into one long path.
3. *Branching paths.*  Where one anchor has several spans, the walks branch
   inside them.  Only there, and only for the first document of each distinct
   span (for the others the span itself is repeated), single edges are listed
   and matched by 128-bit hashes.
4. *Source coordinates.*  Each compacted path is verified: digests of the words
   at the document's and at the source's coordinates must agree.

All groupings are on hashes and pre-aggregated, so a passage that a third of
the documents share costs one row per task and key.

Defined results: null text has no words; texts shorter than ``k`` words lose
nothing; a null ``doc_id`` is never compared (nothing is removed, and it is no
source); rows with one ``doc_id`` never count as sources of each other, and
equal rows get equal results; other columns pass through unchanged, but the
result's own columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm import common, textops

K, SEED = 50, 10
_TEXT, _KEY, _CUTS = "__td_text", "__td_key", "__td_cuts"
SLICE = 2 << 20


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _walks(data: np.ndarray, offsets: np.ndarray, k: int, seed: int):
    """(text, seed hash, span hash, first word in the text, words) of all short walks."""
    starts, ends, first = textops.scan(data, offsets, textops.SPACED)
    at, text = textops.inside(first, k)
    if not len(at):
        return None
    sums = textops.prefix(textops.hashes(data, starts, ends))
    begin = np.arange(len(starts) - seed + 1)
    seeds = textops.spans(sums, begin, begin + seed)
    key = (seeds & np.uint64(0xFFFFFFFF00000000)) | begin.astype(np.uint64)
    width, have = k - seed + 1, 1
    while have < width:  # sliding minimum by doubling
        step = min(have, width - have)
        key = np.minimum(key[:-step], key[step:])
        have += step
    anchor = (key[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    lo, hi = at[new], at[np.append(new[1:], len(at)) - 1]
    return text[new], seeds[anchor[new]], textops.spans(sums, lo, hi + k), lo - first[text[new]], hi + k - lo


def walks(docs: DataFrame, k: int = K, seed: int = SEED) -> DataFrame:
    """doc_id, key, seed, span, lo, n: a row for each short walk of each text."""
    schema = "doc_id long, key long, seed long, span long, lo int, n int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(common.column(b, _TEXT))
            ids, keys = common.column(b, "doc_id"), common.column(b, _KEY)
            for i, j in textops.slices(offsets, SLICE):
                o = offsets[i : j + 1]
                if (w := _walks(data[o[0] : o[-1]], o - o[0], k, seed)) is None:
                    continue
                at = pa.array(w[0] + i)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), keys.take(at), _signed(w[1]), _signed(w[2]), pa.array(w[3].astype(np.int32)), pa.array(w[4].astype(np.int32))],
                    ["doc_id", "key", "seed", "span", "lo", "n"],
                )

    return docs.where("doc_id is not null").select("doc_id", _KEY, _TEXT).mapInArrow(run, schema)


def _asked(batch: pa.RecordBatch, fields: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets and flat fields of the list column of requests."""
    lists = common.column(batch, _CUTS)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    return np.concatenate([[0], np.cumsum(sizes)]), [flat.field(f).to_numpy(zero_copy_only=False) for f in fields]


def _digest(data: np.ndarray, a: int, b: int) -> tuple[int, int]:
    d = hashlib.blake2b(b" ".join(data[a:b].tobytes().split()), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _looked_up(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Answers from the texts: edges = true lists the windows of [lo, lo + n), else its digest."""
    schema = "edges boolean, doc_id long, key long, lo int, n int, h long, h2 long"
    names = ["edges", "doc_id", "key", "lo", "n", "h", "h2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(common.column(b, _TEXT))
            ids, keys = common.column(b, "doc_id"), common.column(b, _KEY)
            at, (lo, n, edges) = _asked(b, ("lo", "n", "edges"))
            for i, j in textops.slices(offsets, SLICE):
                o = offsets[i : j + 1]
                part = data[o[0] : o[-1]]
                starts, ends, first = textops.scan(part, o - o[0], textops.SPACED)
                text = np.repeat(np.arange(j - i), np.diff(at[i : j + 1]))
                l, m, e = lo[at[i] : at[j]] + first[text], n[at[i] : at[j]], edges[at[i] : at[j]].astype(bool)
                if e.any():
                    h = textops.hashes(part, starts, ends)
                    sums, sums2 = textops.prefix(h), textops.prefix(h, textops._P)
                    count = m[e] - k + 1
                    pos = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(l[e], count)
                    whose = np.repeat(text[e], count)
                    t = pa.array(whose + i)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.ones(len(pos), bool)), ids.take(t), keys.take(t), pa.array((pos - first[whose]).astype(np.int32)), pa.array(np.full(len(pos), k, np.int32)), _signed(textops.spans(sums, pos, pos + k)), _signed(textops.spans(sums2, pos, pos + k, textops._P))],
                        names,
                    )
                if not e.all():
                    rest = np.flatnonzero(~e)
                    found = np.array([_digest(part, starts[l[r]], ends[l[r] + m[r] - 1]) for r in rest], np.int64)
                    t = pa.array(text[rest] + i)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.zeros(len(rest), bool)), ids.take(t), keys.take(t), pa.array((l[rest] - first[text[rest]]).astype(np.int32)), pa.array(m[rest].astype(np.int32)), pa.array(found[:, 0]), pa.array(found[:, 1])],
                        names,
                    )

    by_doc = asked.groupBy("doc_id", "key").agg(F.collect_list(F.struct("lo", "n", "edges")).alias(_CUTS))
    joined = docs.select("doc_id", _KEY, _TEXT).join(by_doc.withColumnRenamed("key", _KEY), ["doc_id", _KEY])
    return joined.mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, k: int = K, seed: int = SEED) -> DataFrame:
    """doc_id, key, lo, n: verified runs of words covered by a repeated window."""
    rows = common.stored(walks(docs, k, seed), "walks")
    spans = rows.groupBy("seed", "span").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    seeds = spans.groupBy("seed").agg(F.min("source").alias("low"), F.max("last").alias("high"), F.count("*").alias("n_spans")).where("low <> high").drop("low", "high")
    shared = spans.join(seeds, "seed").where("source <> last or n_spans > 1").drop("last")
    hits = common.stored(rows.join(shared, ["seed", "span"]), "hits")

    # Small sides of joins with a hot source or span are stored first: a join of
    # plain exchanges is one that Spark splits.
    origin = common.stored(hits.where("doc_id = source").groupBy("seed", "span").agg(F.min(F.struct("key", "lo")).alias("o")), "origins")
    whole = (
        hits.where("doc_id > source").join(origin, ["seed", "span"])
        .select("doc_id", "key", "lo", "n", "source", F.col("o.key").alias("source_key"), F.col("o.lo").alias("source_lo"))
        .dropDuplicates(["doc_id", "key", "lo"])
    )
    whole = common.stored(whole.withColumn("shift", F.col("source_lo") - F.col("lo")), "whole")
    same = ["doc_id", "key", "source", "source_key", "shift"]
    before = whole.select(*same, (F.col("lo") + F.col("n") - (k - 1)).alias("lo"), F.lit(1).alias("runs_on"))
    order = Window.partitionBy("doc_id", "key").orderBy("lo")
    paths = (
        whole.join(before, [*same, "lo"], "left")
        .withColumn("path", F.sum(F.when(F.col("runs_on").isNull(), 1).otherwise(0)).over(order))
        .groupBy(*same, "path").agg(F.min("lo").alias("lo"), F.max(F.col("lo") + F.col("n")).alias("end"))
        .select("doc_id", "key", "lo", (F.col("end") - F.col("lo")).cast("int").alias("n"), "source", "source_key", (F.col("lo") + F.col("shift")).cast("int").alias("source_lo"))
    )
    paths = common.stored(paths, "paths")

    branching = hits.where("doc_id = source and n_spans > 1").select("doc_id", "key", "lo", "n").distinct()
    asked = (
        branching.withColumn("edges", F.lit(True))
        .union(paths.select("doc_id", "key", "lo", "n", F.lit(False)))
        .union(paths.select("source", "source_key", "source_lo", "n", F.lit(False)).distinct())
    )
    answers = common.stored(_looked_up(docs, asked, k), "answers")
    edges = answers.where("edges")
    first = edges.groupBy("h", "h2").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last")).where("source <> last").drop("last")
    single = edges.join(first, ["h", "h2"]).where("doc_id > source").select("doc_id", "key", "lo", "n")
    digests = common.stored(answers.where("not edges").select("doc_id", "key", "lo", "n", "h", "h2").distinct(), "digests")
    verified = (
        paths.join(digests, ["doc_id", "key", "lo", "n"])
        .join(digests.toDF("source", "source_key", "source_lo", "n", "h", "h2"), ["source", "source_key", "source_lo", "n", "h", "h2"])
        .select("doc_id", "key", "lo", "n")
    )
    return verified.union(single)


def remove_repeats(docs: DataFrame, text_col: str = "text", k: int = K, seed: int = SEED) -> DataFrame:
    """The documents with n_words, n_removed and kept_text (kept words joined by a space)."""
    spark = docs.sparkSession
    common.prepare(spark)
    own = ["n_words", "n_removed", "kept_text"]
    base = docs.drop(*own).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = base.withColumn(_TEXT, F.coalesce(F.col(text_col), F.lit(""))).withColumn(_KEY, F.xxhash64(_TEXT))
    cuts = repeated_spans(keyed, k, seed).groupBy("doc_id", "key").agg(F.collect_list(F.struct("lo", "n")).alias(_CUTS))
    joined = keyed.join(cuts.withColumnRenamed("key", _KEY), ["doc_id", _KEY], "left").select(*base.columns, _TEXT, _CUTS)
    out = common.extended(base, n_words="long", n_removed="long", kept_text="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(common.column(b, _TEXT))
            at, (lo, n) = _asked(b, ("lo", "n"))
            words, removed, kept = [], [], []
            for i in range(b.num_rows):
                own = data[offsets[i] : offsets[i + 1]].tobytes().split()
                words.append(len(own))
                if at[i + 1] > at[i]:
                    cover = np.zeros(len(own) + 1, np.int64)
                    l = lo[at[i] : at[i + 1]]
                    np.add.at(cover, l, 1)
                    np.add.at(cover, l + n[at[i] : at[i + 1]], -1)
                    gone = np.cumsum(cover[:-1]) > 0
                    removed.append(int(gone.sum()))
                    own = [w for w, g in zip(own, gone.tolist(), strict=True) if not g]
                else:
                    removed.append(0)
                kept.append(b" ".join(own))
            cols = [b.column(x) for x in range(b.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=[f.name for f in out])

    return joined.mapInArrow(run, out)

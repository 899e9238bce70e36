"""Embedding near-dedup with randomised-rotation binary codes.

A vector o (of length 1) is rotated at random; its code x holds the signs of
the coordinates, as a unit vector, and its correction factor is f = <x, o>.
For another vector q, <x, q> / f is an unbiased estimate of <o, q>: what the
code adds is f times o and a part orthogonal to o whose direction is random.
For a pair of cosine c that error has scale sqrt(1 - f**2) / f * sqrt(1 - c**2) /
sqrt(d - 1), so with ``sigmas`` = 5 of it as a confidence bound a pair whose
estimate stays below the threshold by more cannot be a link, but for a chance
of about 1e-6.  Only the other pairs are computed exactly, in double precision.

Pairs are met in tables: the signs of ``tables`` x ``bits`` rotated coordinates
are cut into keys, and vectors that share a key of a table are compared.  Two
vectors of cosine c agree in a bit with probability 1 - acos(c) / pi; the
number of bits follows the number of vectors (so that a bucket of random
vectors stays small) and the number of tables follows from ``miss``, the
chance that a pair at the threshold itself meets in no table (1e-4).

A pair counts in the first table in which it meets, which both keys tell, so no
list of pairs is made or deduplicated: each task returns, for each vector, its
number of new links and the smallest vector it is connected with there.  A
bucket of more than ``BLOCK`` vectors is dealt out as pairs of blocks; tasks
read their groups sorted and hold few at a time.  Equal
vectors are compared once, with their number.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing and are their own component; so are
vectors of different lengths with each other, and vectors without id (their
component is null); repeated rows count as other vectors; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common
from tidemart.llm.components import components

THRESHOLD, MISS, SIGMAS, BLOCK = 0.95, 1e-4, 5.0, 2048
#: Vectors that a task compares, with their copies in other tables and pairs of blocks, in bytes.
TASK_BYTES = 16 << 20
#: Hot buckets that may be broadcast (of 20 bytes); more are joined.
HOT_ROWS = 100_000
SEED = 0x0B17
CHUNK = 1 << 18


def shape(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """Bits of a key and number of tables for n vectors."""
    bits = min(30, max(6, math.ceil(math.log2(max(2, n))) - 4))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-meet))


@lru_cache(maxsize=8)
def rotation(d: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, d, number]).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def encode(x: np.ndarray, bits: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (a row each, 32 bits a table), packed code and correction factor of unit vectors."""
    d = x.shape[1]
    signs, factor, code = [], None, None
    for r in range(-(-tables * bits // d)):
        y = x @ rotation(d, r).T
        if r == 0:
            code, factor = np.packbits(y > 0, axis=1), np.abs(y).sum(axis=1) / math.sqrt(d)
        signs.append(y > 0)
    flat = np.concatenate(signs, axis=1)[:, : tables * bits].reshape(len(x), tables, bits)
    return (flat @ (1 << np.arange(bits, dtype=np.int64))).astype(np.int32), code, factor


def coded(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """rep, copies, d, x (the components as they are stored, floats or doubles), keys, code, factor of each distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == d))
                raw = b.column(2).take(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, int(d))
                keys, code, factor = encode(unit(raw.astype(np.float64)), bits, tables)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1, dtype=np.int32) * tables), pa.array(keys.reshape(-1)))
                rows = lambda m: pa.array([v.tobytes() for v in m], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(np.full(len(raw), d, np.int32)), rows(raw), flat, rows(keys), rows(code), pa.array(factor)], ["rep", "copies", "d", "x", "keys", "packed", "code", "factor"])

    return vectors.select("rep", "copies", "embedding").mapInArrow(run, "rep long, copies long, d int, x binary, keys array<int>, packed binary, code binary, factor double")


def _pairs(group: np.ndarray, cross: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group, in chunks; of a cross group, pairs of its two sides only."""
    last = np.searchsorted(group, group, "right")
    left = np.searchsorted(group, group)
    split = left + np.add.reduceat(side == 0, np.flatnonzero(np.diff(group, prepend=-1)))[np.cumsum(np.diff(group, prepend=-1) != 0) - 1] if len(group) else left
    row = np.arange(len(group))
    begin = np.where(cross, np.where(side == 0, split, last), row + 1)  # sides are sorted: the first one's rows meet the second's
    count = last - begin
    upto = np.concatenate([[0], np.cumsum(count)])
    i = 0
    while i < len(row):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + CHUNK, "right")) - 1)
        c = count[i:j]
        a = np.repeat(row[i:j], c)
        yield a, np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(begin[i:j], c)
        i = j


def linked(x: np.ndarray, code: np.ndarray, factor: np.ndarray, a: np.ndarray, b: np.ndarray, turned: np.ndarray, threshold: float, sigmas: float) -> tuple[np.ndarray, np.ndarray]:
    """(near, exact): which pairs the bounds leave, and which of those are links."""
    d = x.shape[1]
    estimate = np.einsum("ij,ij->i", code[b], turned[a]) / (math.sqrt(d) * factor[b])
    f = np.minimum(factor[b], 1.0)
    bound = sigmas * np.sqrt(1 - f * f) / f * math.sqrt(1 - threshold**2) / math.sqrt(max(1, d - 1))
    near = np.flatnonzero(estimate + bound + 1e-6 >= threshold)
    return near, np.einsum("ij,ij->i", x[a[near]], x[b[near]]) >= threshold


def _roots(a: np.ndarray, b: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The smallest of ``low`` among the rows connected with each row by pairs (a, b)."""
    low = low.copy()
    while len(a):
        before = low.copy()
        m = np.minimum(low[a], low[b])
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        if (low == before).all():
            break
    return low


def _compare(rows: pa.Table, threshold: float, sigmas: float, kind: type = np.float64) -> Iterator[pa.RecordBatch]:
    number = {name: rows.column(name).to_numpy() for name in ("rep", "copies", "d", "t", "key", "i", "j", "side", "factor")}
    for d in np.unique(number["d"]):
        at = np.flatnonzero(number["d"] == d)
        at = at[np.lexsort([number[c][at] for c in ("rep", "side", "j", "i", "key", "t")])]
        n = {name: v[at] for name, v in number.items()}
        pick = rows.take(pa.array(at))
        blob = lambda name: b"".join(pick.column(name).to_pylist())
        x = unit(np.frombuffer(blob("x"), kind).reshape(len(at), -1).astype(np.float64))
        keys = np.frombuffer(blob("packed"), np.int32).reshape(len(at), -1)
        code = np.where(np.unpackbits(np.frombuffer(blob("code"), np.uint8).reshape(len(at), -1), axis=1, count=int(d)), np.float32(1), np.float32(-1))
        turned = (x @ rotation(int(d), 0).T).astype(np.float32)
        change = np.zeros(len(at), bool)
        change[0] = True
        for c in ("t", "key", "i", "j"):
            change[1:] |= n[c][1:] != n[c][:-1]
        group = np.cumsum(change) - 1
        links = np.zeros(len(at), np.int64)
        found, kept = [], 0
        for a, b in _pairs(group, n["i"] != n["j"], n["side"]):
            near, exact = linked(x, code, n["factor"], a, b, turned, threshold, sigmas)
            a, b = a[near[exact]], b[near[exact]]
            # met in an earlier table: counted there
            t = n["t"][a]
            fresh = ~((keys[a] == keys[b]) & (np.arange(keys.shape[1]) < t[:, None])).any(axis=1)
            a, b = a[fresh], b[fresh]
            np.add.at(links, a, n["copies"][b])
            np.add.at(links, b, n["copies"][a])
            found.append((a, b))
            kept += len(a)
            if kept > CHUNK:  # one pair a row tells as much
                root = _roots(*(np.concatenate(f) for f in zip(*found)), np.arange(len(at)))
                joined = np.flatnonzero(root != np.arange(len(at)))
                found, kept = [(joined, root[joined])], 0
        low = _roots(*(np.concatenate(f) for f in zip(*found)), n["rep"]) if found else n["rep"]
        has = links > 0
        yield pa.RecordBatch.from_arrays([pa.array(n["rep"][has]), pa.array(links[has]), pa.array(low[has])], ["rep", "n", "low"])


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, miss: float = MISS, sigmas: float = SIGMAS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every vector."""
    spark = table.sparkSession
    common.prepare(spark)
    # components travel as they are stored, and become doubles in the task
    narrow = table.schema[vector_col].dataType.simpleString() == "array<float>"
    kind, width = (np.float32, 4) if narrow else (np.float64, 8)
    read = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>" if narrow else "array<double>").alias("embedding"))
    bad = "exists(embedding, v -> v is null or isnan(v) or abs(v) = double('infinity'))"
    usable = F.expr(f"vec_id is not null and size(embedding) > 0 and not {bad} and exists(embedding, v -> v <> 0)")
    keyed = read.withColumn("usable", F.coalesce(usable, F.lit(False))).withColumn("h", F.xxhash64("embedding"))
    vectors = common.stored(keyed.where("usable").groupBy("h", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors")
    n, numbers = vectors.agg(F.count("*"), F.sum(F.size("embedding"))).first()
    bits, tables = shape(n, threshold, miss)
    codes = common.stored(coded(vectors, bits, tables), "codes")
    in_tables = codes.select("rep", "copies", "d", "x", "packed", "code", "factor", F.posexplode("keys").alias("t", "key"))

    # buckets of more than BLOCK vectors meet as pairs of blocks
    hot = codes.select(F.posexplode("keys").alias("t", "key"), "d").groupBy("t", "key", "d").agg(F.count("*").alias("m")).where(F.col("m") > BLOCK)
    hot = common.stored(hot.select("t", "key", "d", "m", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "hot-buckets")
    # a row holds the vector, its code, all keys and some numbers; in a hot bucket it is copied once per block
    fixed = 4 * tables + 72
    copied = hot.agg(F.sum(F.col("m") * (F.col("blocks") - 1) * (F.col("d") * (width + 0.125) + fixed))).first()[0] or 0
    spread = max(common.parts(spark), int((n * fixed + (numbers or 0) * (width + 0.125)) * tables + copied) // TASK_BYTES + 1)
    hot = hot.drop("m")
    hot = F.broadcast(hot) if hot.count() <= HOT_ROWS else hot
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (
        in_tables.join(hot, ["t", "key", "d"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("rep", "copies", "d", "x", "code", "factor", "t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                (F.col("own") > F.col("other")).cast("int").alias("side"), "packed")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.groups(batches, ("t", "key", "d", "i", "j"), common.GROUP_BYTES):
            yield from _compare(rows.combine_chunks(), threshold, sigmas, kind)

    met = common.stored(dealt.repartition(spread, "t", "key", "d", "i", "j").sortWithinPartitions("t", "key", "d", "i", "j").mapInArrow(run, "rep long, n long, low long"), "links")
    counts = met.groupBy("rep").agg(F.sum("n").alias("n"))
    groups = components(met.select(F.col("rep").alias("a"), F.col("low").alias("b")))
    known = vectors.join(counts, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("h", "embedding", "rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = keyed.where("usable").join(known, ["h", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = keyed.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

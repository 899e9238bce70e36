"""MinHash near-dedup sensitive to order: order MinHash and banded alignment.

The words of a text (runs of ASCII letters and digits, A-Z lower-cased, and
characters beyond ASCII) give shingles of ``k`` words; a shingle's n-th
occurrence in a text is labelled n.  A sketch takes the ``pick`` labelled
shingles that are smallest under a random function, in their text order, so
two sketches agree only if the texts share these shingles in one order.  Several sketches
with independent functions make two texts candidates if any of them agrees.

Candidates are verified by alignment of the whole shingle sequences: with the
longest common subsequence L of sequences of n and m shingles, the similarity
is L / (n + m - L) and links need 0.8 or more.  That bounds how far an
alignment may leave the diagonal, so a band of that width is exact; rows of the
band are machine words of one long integer (bit-parallel).

Recall: with order kept and a shingle similarity s, t sketches of p shingles
all miss with probability (1 - s**p)**t; at s = 0.8 that is 3e-6 for the family
of long texts (5 shingles, 32 sketches), 6e-7 for that of short texts (3, 20).

Work of a bucket (texts with one sketch): first, one text of the bucket is
aligned with the others; links join classes, and a bucket of one class is done.
The other buckets go to tasks with their sequences (those of more than
``BLOCK`` texts as pairs of blocks, sorted, so that a task holds few groups at
a time).  There one matrix product tells how many
shingles any two texts share, which bounds their similarity; pairs of different
classes that the bound leaves are aligned until their classes are joined.  So
no link between texts of a bucket is lost, and what is returned are joined
classes, not pairs.  Copies of one word sequence are one node.  No bucket is
capped.

Defined results: texts of fewer than ``k`` words have one shingle of all their
words; null texts and texts without words are linked with nothing; class_id is
the smallest doc_id of the class; a null doc_id belongs to the class of its
text but never names it, unless no text of the class has an id; repeated rows
are copies; other columns are not read.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common, textops
from tidemart.llm.components import components

K, SIMILARITY, BLOCK = 5, 0.8, 512
#: (least and most shingles, shingles in a sketch, sketches) of each family of
#: tables.  Short texts need small sketches, long ones selective sketches; two
#: texts of sizes within SIMILARITY of each other are always in one family.
FAMILIES = ((1, 50, 3, 20), (40, 2**31, 5, 32))
SLICE = 2 << 20
#: Sequences that a task compares, with their copies in pairs of blocks, in bytes.
TASK_BYTES = 16 << 20
#: Hot buckets that may be broadcast (of 12 bytes); more are joined.
HOT_ROWS = 100_000
_TEXT = "__td_text"


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each shingle, each text's first shingle (n + 1), and a hash of each text's word sequence (0: no words)."""
    starts, ends, first = textops.scan(data, offsets, textops.ALNUM)
    sums = textops.prefix(textops.hashes(data, starts, ends, textops.FOLD))
    words = np.diff(first)
    count = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1], count) + np.repeat(first[:-1], count)
    size = np.repeat(np.minimum(words, k), count)
    whole = np.where(words > 0, textops.spans(sums, first[:-1], first[1:]), np.uint64(0))
    return textops.spans(sums, at, at + size), begin, whole


def labelled(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The shingles with the number of their occurrence in the text mixed in."""
    key = h + text.astype(np.uint64) * np.uint64(textops._P)
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(h), bool)
    same[1:] = key[order[1:]] == key[order[:-1]]
    run = np.arange(len(h))
    rank = run - np.maximum.accumulate(np.where(same, 0, run))
    occurrence = np.zeros(len(h), np.uint64)
    occurrence[order] = rank
    return textops.mix(h + occurrence * np.uint64(textops._Q))


def sketches(h: np.ndarray, begin: np.ndarray, pick: int, tables: int) -> np.ndarray:
    """One 64-bit sketch for each text and table (0 rows for no texts)."""
    n = np.diff(begin)
    text = np.repeat(np.arange(len(n)), n)
    marks = labelled(h, text)
    # smallest values lie below pick / n of the range; 8 times that leaves almost no text short
    limit = np.where(n > 8 * pick, (8.0 * pick / np.maximum(n, 1) * 2.0**64).clip(0, 2.0**64 - 2049), 2.0**64 - 2049).astype(np.uint64)
    high = limit[text]
    out = np.zeros((len(n), tables), np.uint64)
    rng = np.random.default_rng(0x0A11)
    for t in range(tables):
        a, b = rng.integers(1, 2**63, 2, dtype=np.uint64)
        value = (marks ^ a) * (b | np.uint64(1))
        value ^= value >> np.uint64(32)
        value *= np.uint64(textops._Q)
        value ^= value >> np.uint64(29)
        for short in (False, True):
            if short:  # the few texts of which too little lies below the limit
                few = np.flatnonzero(found < np.minimum(n, pick))
                if not len(few):
                    break
                at = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in few])
            else:
                at = np.flatnonzero(value <= high)
            own = text[at]
            order = np.lexsort((value[at], own))
            at, own = at[order], own[order]
            start = np.searchsorted(own, np.arange(len(n)))
            rank = np.arange(len(own)) - start[own]
            if not short:
                found = np.bincount(own, minlength=len(n))
            at = np.sort(at[rank < pick])  # text order
            own = text[at]
            place = np.arange(len(at)) - np.searchsorted(own, own)
            mixed = textops.mix(marks[at] + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(textops._P))
            total = np.zeros(len(n), np.uint64)
            np.add.at(total, own, mixed)
            new = textops.mix(total ^ np.uint64(t + 1))
            hit = few if short else np.unique(own)
            out[hit, t] = new[hit]
    return out


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Is the similarity of two shingle sequences at least ``least``?  Exact, in a band."""
    n, m = len(a), len(b)
    if min(n, m) < least * max(n, m):
        return False
    # L / (n + m - L) >= least
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))
    top = min(n, m)
    diff = np.flatnonzero(a[:top] != b[:top])
    head = int(diff[0]) if len(diff) else top
    diff = np.flatnonzero(a[n - top + head :][::-1] != b[m - top + head :][::-1]) if head < top else np.zeros(0, int)
    tail = int(diff[0]) if len(diff) else top - head
    common_ends = head + tail
    if common_ends >= need:
        return True
    a, b = a[head : n - tail], b[head : m - tail]
    need -= common_ends
    # the sequences share no more than the multiset of shingles that both have
    values, counts = np.unique(a, return_counts=True)
    place = np.minimum(np.searchsorted(values, b), len(values) - 1) if len(values) else np.zeros(len(b), int)
    both, theirs = np.unique(place[values[place] == b], return_counts=True) if len(values) else (place, place)
    if np.minimum(counts[both], theirs).sum() < need:
        return False
    # every matched pair (i, j) has |i - j| at most the number of unmatched ones
    width = len(a) + len(b) - 2 * need
    if width < 0:
        return False
    where: dict[int, list[int]] = {}
    for i, x in enumerate(a.tolist()):
        where.setdefault(x, []).append(i)
    low, matched, band, full = 0, 0, 0, (1 << 2 * width + 2) - 1
    state = full  # bit i: row low + i; a zero is one more match
    left = len(b)
    for j, x in enumerate(b.tolist()):
        if j - width > low:  # the lowest row leaves the band
            matched += not state & 1
            state = state >> 1 | 1 << 2 * width + 1
            low += 1
        rows = where.get(x)
        if rows is not None:
            i = bisect.bisect_left(rows, low)
            match = 0
            while i < len(rows) and rows[i] <= j + width:
                match |= 1 << rows[i] - low
                i += 1
            if match:
                u = state & match
                state = ((state + u) | (state - u)) & full
    size = min(2 * width + 2, len(a) - low)
    matched += sum(1 for c in bin(state & ((1 << size) - 1) | 1 << size)[3:] if c == "0") if size > 0 else 0
    return matched >= need


def families(h: np.ndarray, begin: np.ndarray, kinds: tuple[tuple[int, int, int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
    """All sketches of each text, one text after the other, and how many each has."""
    n = np.diff(begin)
    found, whose = [], []
    for number, (least, most, pick, tables) in enumerate(kinds):
        texts = np.flatnonzero((n >= least) & (n <= most))
        own = np.concatenate([[0], np.cumsum(n[texts])])
        at = np.arange(own[-1]) + np.repeat(begin[texts] - own[:-1], n[texts])
        found.append(textops.mix(sketches(h[at], own, pick, tables) + np.uint64(number)).reshape(-1))
        whose.append(np.repeat(texts, tables))
    whose = np.concatenate(whose)
    return np.concatenate(found)[np.argsort(whose, kind="stable")], np.bincount(whose, minlength=len(n))


def sketch_table(docs: DataFrame, k: int, kinds: tuple[tuple[int, int, int, int], ...]) -> DataFrame:
    """doc_id, row (hash of id and text), node (hash of the word sequence; null: no words), n (shingles), sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(b.column(2))
            for i, j in textops.slices(offsets, SLICE):
                o = offsets[i : j + 1]
                h, begin, whole = shingles(data[o[0] : o[-1]], o - o[0], k)
                found, count = families(h, begin, kinds)
                flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(found.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(whole.view(np.int64), mask=whole == 0), pa.array(np.diff(begin).astype(np.int32)), flat], ["doc_id", "row", "node", "n", "sketches"])

    return docs.select("doc_id", "row", _TEXT).mapInArrow(run, "doc_id long, row long, node long, n int, sketches array<long>")


def sequences(docs: DataFrame, k: int) -> DataFrame:
    """node, seq: the shingle sequence (64-bit hashes) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(b.column(1))
            for i, j in textops.slices(offsets, SLICE):
                o = offsets[i : j + 1]
                h, begin, _ = shingles(data[o[0] : o[-1]], o - o[0], k)
                h = h.astype(np.uint32)  # 32 bits of each: what is compared are long sequences
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array([h[x:y].tobytes() for x, y in zip(begin[:-1], begin[1:], strict=True)], pa.binary())], ["node", "seq"])

    return docs.select("node", _TEXT).mapInArrow(run, "node long, seq binary")


def verified(pairs: DataFrame, seqs: DataFrame, least: float) -> DataFrame:
    """a, b, linked: the pairs (a, b) with the verdict of the alignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [similar(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), least) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], ["a", "b", "linked"])

    both = pairs.join(seqs.toDF("b", "y"), "b").join(seqs.toDF("a", "x"), "a")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def shared(seqs: list[np.ndarray]) -> np.ndarray:
    """How many shingles any two sequences share, as multisets."""
    size = np.array([len(x) for x in seqs])
    text = np.repeat(np.arange(len(seqs)), size)
    marks = labelled(np.concatenate(seqs).astype(np.uint64), text)
    _, column, count = np.unique(marks, return_inverse=True, return_counts=True)
    use = count[column] > 1
    number = np.cumsum(count > 1) - 1
    text, column = text[use], number[column[use]]
    out = np.zeros((len(seqs), len(seqs)), np.float32)
    order = np.argsort(column, kind="stable")
    text, column = text[order], column[order]
    width = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [first, first + width])
        block = np.zeros((len(seqs), width), np.float32)
        block[text[i:j], column[i:j] - first] = 1
        out += block @ block.T
    return out


def joined(nodes: list[int], classes: list[int], side: np.ndarray, cross: bool, seqs: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links that join the classes of one group; of a cross group, links between its sides."""
    size = np.array([len(x) for x in seqs])
    need = np.ceil(least * (size[:, None] + size[None, :]) / (1 + least) - 1e-9)
    own = np.unique(np.array(classes), return_inverse=True)[1]
    possible = np.triu(shared(seqs) >= need, 1) & (own[:, None] != own[None, :])
    if cross:
        possible &= side[:, None] != side[None, :]
    parent = list(range(int(own.max()) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(possible)):
        x, y = find(int(own[i])), find(int(own[j]))
        if x != y and similar(seqs[i], seqs[j], least):
            parent[x] = y
            out.append((nodes[i], nodes[j]))
    return out


def group_links(rows: pa.Table, least: float) -> list[tuple[int, int]]:
    """Links that join classes, of whole groups (bucket, i, j)."""
    bucket, i, j, side, node, cls = (rows.column(c).to_numpy() for c in ("bucket", "i", "j", "side", "node", "class"))
    order = np.lexsort((node, side, j, i, bucket))
    blobs = rows.column("seq")
    change = np.flatnonzero(np.concatenate([[True], (bucket[order[1:]] != bucket[order[:-1]]) | (i[order[1:]] != i[order[:-1]]) | (j[order[1:]] != j[order[:-1]])]))
    out = []
    for x, y in zip(change, np.append(change[1:], len(order)), strict=True):
        at = order[x:y]
        if y - x > 1 and len(np.unique(cls[at])) > 1:
            texts = [np.frombuffer(blobs[int(r)].as_buffer(), np.uint32) for r in at]
            out += joined(node[at].tolist(), cls[at].tolist(), side[at], bool(i[at[0]] != j[at[0]]), texts, least)
    return out


def rest_links(mixed: DataFrame, seqs: DataFrame, least: float) -> DataFrame:
    """a, b: links that join classes of the buckets in ``mixed`` (bucket, node, n, class)."""
    spark = mixed.sparkSession
    per_bucket = mixed.groupBy("bucket").agg(F.count("*").alias("m"), F.sum(F.col("n").cast("long") * 4).alias("bytes"))
    hot = common.stored(per_bucket.where(F.col("m") > BLOCK).select("bucket", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"), "bytes"), "hot-buckets")
    # each row of a hot bucket is copied once per block
    size = (mixed.agg(F.sum(F.col("n").cast("long") * 4)).first()[0] or 0) + (hot.agg(F.sum(F.col("bytes") * (F.col("blocks") - 1))).first()[0] or 0)
    spread = max(common.parts(spark), int(size) // TASK_BYTES + 1)
    hot = hot.drop("bytes")
    hot = F.broadcast(hot) if hot.count() <= HOT_ROWS else hot
    dealt = (
        mixed.join(hot, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "class")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.groups(batches, ("bucket", "i", "j"), common.GROUP_BYTES):
            yield from common.emit(group_links(rows, least), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return dealt.join(seqs, "node").repartition(spread, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(run, "a long, b long")


def row_key(text_col: str = "text") -> Column:
    """Names a row by doc_id and text; equal rows have one key."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col(text_col))


def near_duplicates(docs: DataFrame, text_col: str = "text", k: int = K, least: float = SIMILARITY, kinds: tuple[tuple[int, int, int, int], ...] = FAMILIES, by_row: bool = False) -> DataFrame:
    """doc_id, class_id, kept (one row of each class) for every document; ``by_row``: row (``row_key``) and kept.

    By row the one that is kept is the first by (doc_id, row), ids that are null last.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias(_TEXT)).withColumn("row", row_key(_TEXT))
    rows = common.stored(sketch_table(read, k, kinds), "sketches")

    # buckets of two or more different texts; at first each text is a class of its own
    keyed = rows.where("node is not null").select("node", "n", F.explode("sketches").alias("bucket")).distinct()
    several = keyed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("bucket")
    buckets = common.stored(keyed.join(several, "bucket"), "buckets")

    # one text of each node that is in a bucket
    used = buckets.select("node").distinct()
    owners = rows.groupBy("node").agg(F.min("row").alias("row")).join(used, "node")
    seqs = common.stored(sequences(read.join(owners, "row"), k), "sequences")

    # one text of each bucket is aligned with the others
    drawn = buckets.groupBy("bucket").agg(F.min("node").alias("lead"))
    lead = buckets.join(drawn.withColumnRenamed("lead", "node"), ["bucket", "node"]).select("bucket", F.col("node").alias("lead"), F.col("n").alias("lead_n"))
    sized = F.expr(f"least(n, lead_n) >= {least} * greatest(n, lead_n)")
    pairs = buckets.join(lead, "bucket").where("node <> lead").where(sized).select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    links = common.stored(verified(pairs, seqs, least).where("linked").select("a", "b"), "first-links")
    classes = components(links)

    # buckets of several classes still
    named = buckets.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")
    several = named.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("bucket")
    mixed = common.stored(named.join(several, "bucket"), "mixed")
    more = common.stored(rest_links(mixed, seqs, least), "more-links")
    classes = components(more.union(classes.toDF("a", "b")))

    # node -> class, named by the smallest document
    named = rows.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).select("doc_id", "row" if by_row else "node", "class")
    # stored, so that the join with a hot class is one of plain exchanges, which Spark splits
    named = common.stored(named, "classes")
    if by_row:
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
        firsts = common.stored(named.where("class is not null").groupBy("class").agg(F.min(order).alias("first")).select("class", F.col("first.row").alias("first")), "class-rows")
        return named.join(firsts, "class", "left").select("row", F.coalesce(F.col("row") == F.col("first"), F.lit(True)).alias("kept"))
    names = common.stored(named.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("class_id")), "class-names")
    out = named.join(names, "class", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    return out.select("doc_id", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))

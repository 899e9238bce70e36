"""Conversation prefix trie: ternary search trees over turn ids, one for each range shard.

1. *Dictionary.*  A distinct turn (role, text) gets a 64-bit id; turns are told
   apart by a SHA-256 digest, so no text is shuffled and a turn that opens a
   third of all conversations is one row for each task.
2. *Order.*  Turns are range-partitioned by conversation and turn; a turn's
   place is its row number less that of its conversation's first row, taken
   from counts for each partition, so a long conversation is not sorted in one
   task.
3. *Distinct sequences.*  Equal conversations are one sequence with their
   number, smallest id and the digest of all their ids; the ids are joined in
   blocks first and a digest runs over the blocks in order, so no list of them
   is held.
4. *Range shards.*  The sequences are range-partitioned and cut into shards of
   ``SHARD_TURNS`` turns.  In a shard the median sequence is inserted first,
   then the medians of the halves: a ternary search tree whose sibling trees
   are balanced.  An iterative traversal accumulates members, children, leaves
   and savings from the leaves up.
5. *Boundary nodes.*  A node that lies in several shards is on the first path of
   all of them but one.  Two numbers tell a shard which: the depth shared by its
   first sequence with the sequence before it, and by its last with the one
   after it.  Each shard counts only what it is the first to hold, so the
   partial numbers of a boundary node are simply summed; the other nodes are
   done.

Defined results: a null role or text is empty; turns of equal number are ordered
by the digest of (role, text), null numbers first, equal rows stay two turns;
rows without ``conv_id`` belong to no conversation; a turnless sequence ends at
the root; an empty table has no nodes, not even the root; other columns are not
read.  The ids of one conversation (8 bytes a turn) are held as one list; texts
of any length never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm import common

#: Turns of one shard's tree.
SHARD_TURNS = 200_000
#: Conversation ids that are joined before they are digested: 2 ** BLOCK.
BLOCK = 16
SPACES = "[\\x20\\x09-\\x0D]+"

_NODES = "key binary, parent binary, depth int, low long, parent_low long, n long, children long, leaves long, saved long, ends string, edge boolean, parent_edge boolean"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, n_words of each turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    n_words = F.size(F.filter(F.split(text, SPACES), lambda w: w != "")).cast("long")
    read = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(digest).alias("digest"), n_words.alias("n_words"))
    return read.where("conv_id is not null")


def dictionary(turns: DataFrame) -> DataFrame:
    """digest, id, n_words of each distinct turn."""
    distinct = turns.groupBy("digest").agg(F.max("n_words").alias("n_words"))
    return common.stored(distinct.withColumn("id", F.monotonically_increasing_id()), "turn-dictionary")


def placed(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), id, n_words: each conversation's turns in order."""
    n = common.parts(turns.sparkSession)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    rows = turns.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = rows.select("conv_id", "id", "n_words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    rows = common.stored(rows, "turn-order")
    counts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    starts = common.stored(counts.select("conv_id", "part", "first", before.alias("before")), "turn-starts")
    return rows.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("row") - F.col("first") + F.col("before")).alias("place"), "id", "n_words")


def sequences(placed: DataFrame) -> DataFrame:
    """conv_id, seq, words: ids and words of each conversation's turns."""
    listed = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "id", "n_words"))).alias("s"))
    return listed.select("conv_id", F.col("s.id").alias("seq"), F.col("s.n_words").alias("words"))


def rebuilt(seqs: DataFrame, group: int = 20, shared: int = 4) -> DataFrame:
    """Each conversation with its first h turns replaced by those of the group's first one, h = crc32(conv_id) % shared."""
    heads = seqs.select(F.col("conv_id").alias("donor"), *(F.slice(c, 1, shared - 1).alias(f"head_{c}") for c in ("seq", "words")))
    donor = F.col("conv_id") - F.col("conv_id") % group
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    joined = seqs.withColumns({"donor": donor, "h": h}).join(heads, "donor", "left")
    none = F.array().cast("array<bigint>")

    def changed(c: str) -> Column:
        head = F.when(F.col("h") > 0, F.slice(F.coalesce(f"head_{c}", none), F.lit(1), F.greatest("h", F.lit(1)))).otherwise(none)
        return F.concat(head, F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1)))).alias(c)

    return joined.select("conv_id", changed("seq"), changed("words"))


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """seq, words, n (conversations), low (smallest conv_id), ends (SHA-256 of the comma-joined ascending ids)."""
    keyed = common.stored(seqs.withColumn("of", F.unhex(F.sha2(F.array_join(F.col("seq").cast("array<string>"), ","), 256))), "conversations-rebuilt")
    blocks = keyed.groupBy("of", F.shiftright("conv_id", BLOCK).alias("block")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for b in batches:
            keys, hexes = [], []
            for of, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if of == last:
                    digest.update(b"," + ids.encode())
                    continue
                if last is not None:
                    keys.append(last)
                    hexes.append(digest.hexdigest())
                last, digest = of, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hexes, pa.string())], ["of", "ends"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([digest.hexdigest()])], ["of", "ends"])

    n = common.parts(seqs.sparkSession)
    ends = blocks.repartition(n, "of").sortWithinPartitions("of", "block").select("of", "ids").mapInArrow(run, "of binary, ends string")
    # one list for each sequence: only its smallest conversation's row is kept
    groups = keyed.groupBy("of").agg(F.count("*").alias("n"), F.min("conv_id").alias("low"))
    lists = keyed.join(groups.select("of", F.col("low").alias("conv_id")), ["of", "conv_id"], "left_semi").select("of", "seq", "words")
    return lists.join(groups, "of").join(ends, "of").select("seq", "words", "n", "low", "ends")


def sharded(distinct: DataFrame) -> DataFrame:
    """The sequences with ``shard`` (ascending with them) and the depths it shares with its neighbours."""
    rows = distinct.repartitionByRange(common.parts(distinct.sparkSession), "seq").sortWithinPartitions("seq")
    schema = common.extended(distinct, shard="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            numbers = []
            for n in b.column(0).value_lengths().to_pylist():
                if size and size + n > SHARD_TURNS:
                    shard, size = shard + 1, 0
                size += n + 1
                numbers.append(shard)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers, pa.int64())], names=[f.name for f in schema])

    rows = common.stored(rows.mapInArrow(run, schema), "sequences-sharded")
    edges = rows.groupBy("shard").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    order = Window.orderBy("shard")  # two rows' worth of sequences for each shard, not the sequences
    edges = edges.select("shard", "first", "last", F.lag("last").over(order).alias("left"), F.lead("first").over(order).alias("right"))
    edges = edges.select("shard", _shared("first", "left").alias("before"), _shared("last", "right").alias("after"))
    return rows.join(common.stored(edges, "shard-edges"), "shard")


def _shared(a: str, b: str) -> Column:
    """Length of the common prefix of two id lists; -1 if the second is null."""
    n = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True).cast("int") - 1
    return F.when(F.col(b).isNull(), -1).otherwise(F.when(n < 0, F.size(a)).otherwise(n))


class Tree:
    """A ternary search tree of sequences; node 0 is the root of the trie and holds no id."""

    def __init__(self) -> None:
        self.id, self.less, self.equal, self.more = [None], [0], [0], [0]
        self.parent, self.depth, self.n, self.low, self.ends = [0], [0], [0], [None], [None]

    def _new(self, turn: int, parent: int) -> int:
        self.id.append(turn)
        for links in (self.less, self.equal, self.more, self.n):
            links.append(0)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.low.append(None)
        self.ends.append(None)
        return len(self.id) - 1

    def _child(self, node: int, turn: int) -> int:
        links, at = self.equal, node
        while nxt := links[at]:
            at = nxt
            if turn == self.id[at]:
                return at
            links = self.less if turn < self.id[at] else self.more
        links[at] = new = self._new(turn, node)
        return new

    def insert(self, seq: list[int], n: int, low: int, ends: str) -> None:
        node, i = 0, 0
        while True:
            self.n[node] += n
            self.low[node] = low if self.low[node] is None else min(low, self.low[node])
            if i == len(seq):
                break
            node, i = self._child(node, seq[i]), i + 1
        self.ends[node] = ends

    def siblings(self) -> int:
        """Links to the deepest sibling: the longest search among a node's children."""
        most, stack = 0, [(0, 0)]
        while stack:
            node, k = stack.pop()
            most = max(most, k)
            stack += [(x, k + 1) for x in (self.less[node], self.more[node]) if x]
            if self.equal[node]:
                stack.append((self.equal[node], 1))
        return most


def build_tree(rows: list[tuple]) -> Tree:
    """Rows (seq, n, low, ends) in ascending order, inserted median first."""
    tree, stack = Tree(), [(0, len(rows))]
    while stack:
        a, b = stack.pop()
        if a < b:
            mid = (a + b) // 2
            tree.insert(*rows[mid])
            stack += [(mid + 1, b), (a, mid)]
    return tree


def _nodes(rows: list[tuple], words: list[list[int]], before: int, after: int) -> Iterator[tuple]:
    """Partial numbers of the shard's nodes (see _NODES)."""
    tree = build_tree([r[:4] for r in rows])
    n_words = {t: w for (seq, *_), ws in zip(rows, words, strict=True) for t, w in zip(seq, ws, strict=True)}
    size = len(tree.id)
    first, last = set(), set()
    for path, seq, depth in ((first, rows[0][0], before), (last, rows[-1][0], after)):
        node = 0
        if depth >= 0:
            path.add(0)
        for t in seq[: max(depth, 0)]:
            node = tree._child(node, t)
            path.add(node)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    open_end = after == len(rows[-1][0])  # the last sequence goes on in the next shard
    end = None
    if open_end:
        end = 0
        for t in rows[-1][0]:
            end = tree._child(end, t)
    # children have larger numbers than their parents: they were made later
    for x in range(size - 1, -1, -1):
        if not tree.equal[x] and x != end:
            leaves[x] += 1
        if x:
            p = tree.parent[x]
            saved[x] += (tree.n[x] - (x not in first)) * n_words[tree.id[x]]
            children[p] += x not in first
            leaves[p] += leaves[x]
            saved[p] += saved[x]
    keys = [b""] * size
    edge = [x in first or x in last for x in range(size)]
    for x in range(size):
        p = tree.parent[x]
        keys[x] = hashlib.blake2b(keys[p] + tree.id[x].to_bytes(8, "big"), digest_size=16).digest() if x else b"root"
        own = (keys[p], tree.low[p], edge[p]) if x else (None, None, False)
        yield keys[x], own[0], tree.depth[x], tree.low[x], own[1], tree.n[x], children[x], leaves[x], saved[x], tree.ends[x], edge[x], own[2]


def shard_nodes(sharded: DataFrame) -> DataFrame:
    """The nodes of all shards."""
    schema = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("low", pa.int64()), ("parent_low", pa.int64()), *((c, pa.int64()) for c in ("n", "children", "leaves", "saved")), ("ends", pa.string()), ("edge", pa.bool_()), ("parent_edge", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in common.groups(batches, ("shard",), 0):
            by_shard: dict[int, list[dict]] = {}
            for r in t.to_pylist():
                by_shard.setdefault(r["shard"], []).append(r)
            for own in by_shard.values():
                out = list(_nodes([(r["seq"], r["n"], r["low"], r["ends"]) for r in own], [r["words"] for r in own], own[0]["before"], own[0]["after"]))
                yield from common.emit(out, schema)

    n = common.parts(sharded.sparkSession)
    rows = sharded.select("shard", "seq", "n", "low", "ends", "before", "after", "words")
    return rows.repartition(n, "shard").sortWithinPartitions("shard", "seq").mapInArrow(run, _NODES)


def merged(nodes: DataFrame) -> DataFrame:
    """Boundary nodes summed over their shards; the parent's smallest member brought to its children."""
    nodes = common.stored(nodes, "trie-nodes")
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    edge = nodes.where("edge").groupBy("key").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("low").alias("low"), F.lit(None).cast("long").alias("parent_low"), *sums, F.max("ends").alias("ends"), F.max("parent_edge").alias("parent_edge"))
    edge = common.stored(edge, "trie-boundary")
    done = nodes.where("not edge").drop("edge").unionByName(edge)
    parents = common.stored(edge.select(F.col("key").alias("parent"), F.col("low").alias("merged_low")), "trie-parents")
    below = done.where("parent_edge").join(parents, "parent").withColumn("parent_low", F.col("merged_low")).drop("merged_low")
    return done.where("not parent_edge").unionByName(below)


def trie(conversations: DataFrame, group: int = 20, shared: int = 4) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 (of the members that end there)."""
    common.prepare(conversations.sparkSession)
    read = common.stored(turns(conversations), "turns")
    words = dictionary(read)
    seqs = common.stored(sequences(placed(read.drop("n_words").join(words, "digest"))), "conversations")
    shards = sharded(distinct_sequences(rebuilt(seqs, group, shared)))
    nodes = merged(shard_nodes(shards))
    none = hashlib.sha256().hexdigest()
    return nodes.select(
        F.col("low").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent_low").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(none)).alias("ends_sha256"),
    )

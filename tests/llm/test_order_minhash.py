"""op 4: alignment against a plain one, classes against all pairs."""

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemart.llm import common, orderminhash

from .data import alnum, documents, edge_rows, words


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@given(st.lists(st.integers(0, 6), min_size=1, max_size=25), st.lists(st.tuples(st.integers(0, 30), st.integers(0, 6), st.booleans()), max_size=5))
@settings(max_examples=300, deadline=None)
def test_banded_alignment_is_exact(a, edits):
    b = list(a)
    for at, value, insert in edits:
        at = min(at, len(b))
        if insert:
            b.insert(at, value)
        elif len(b) > 1:
            del b[min(at, len(b) - 1)]
    n = _lcs(a, b)
    assert orderminhash.similar(np.array(a, np.uint32), np.array(b, np.uint32), 0.8) == (n / (len(a) + len(b) - n) >= 0.8 - 1e-12)


def _classes(rows):
    seqs = []
    for _, text in rows:
        w = alnum(text)
        seqs.append([tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else [])
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(seqs):
        for j in range(i):
            b = seqs[j]
            if a and b and (a == b or min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and (n := _lcs(a, b) if len(set(a) & set(b)) > 1 else 0) and n / (len(a) + len(b) - n) >= 0.8):
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted(((doc, low.get(find(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def test_edge_rows(spark):
    rows = edge_rows()
    out = orderminhash.near_duplicates(documents(spark)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in out), key=repr) == _classes(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.class_id) for r in out)


def test_a_large_group_whose_members_are_not_all_alike(spark):
    rng, base, rows = random.Random(4), words(120, 3), []
    for i in range(90):  # 0 to 5 changes each: some pairs are links, some are not
        own = base.copy()
        for _ in range(i % 6):
            own[rng.randrange(len(own))] = f"new{rng.random()}"
        rows.append((i, " ".join(own)))
    out = orderminhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in out), key=repr) == _classes(rows)


def test_tasks_are_sized_by_all_copies_of_a_hot_bucket(spark, monkeypatch):
    """40 sequences of 100 shingles in 10 blocks: each is dealt to 10 pairs of blocks."""
    monkeypatch.setattr(orderminhash, "BLOCK", 4)
    monkeypatch.setattr(orderminhash, "TASK_BYTES", 4_000)
    mixed = spark.createDataFrame([(1, i, 100, i) for i in range(40)], "bucket long, node long, n int, class long")
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**32, 100, dtype=np.uint32)
    rows = []
    for i in range(40):
        own = base.copy()
        own[: i % 5] = rng.integers(0, 2**32, i % 5, dtype=np.uint32)
        rows.append((i, own.tobytes()))
    out = orderminhash.rest_links(mixed, spark.createDataFrame(rows, "node long, seq binary"), 0.8)
    assert out.rdd.getNumPartitions() >= 40 * 400 * 10 // 4_000
    low = list(range(40))
    for a, b in [tuple(r) for r in out.collect()]:
        low = [min(low[a], low[b]) if x in (low[a], low[b]) else x for x in low]
    assert low == [0] * 40


def test_a_task_holds_few_groups_at_a_time():
    read = []

    def batches():
        for g in range(50):
            for k in (3, 0, 4):
                read.append(g)
                yield pa.RecordBatch.from_pydict({"bucket": [g // 2] * k, "i": [g % 2] * k, "x": list(range(k))}, pa.schema([("bucket", pa.int64()), ("i", pa.int32()), ("x", pa.int64())]))

    got = []
    for t in common.groups(batches(), ("bucket", "i"), 1):
        got.append((t.column("bucket").to_pylist(), t.column("i").to_pylist()))
        assert read[-1] <= len(got)  # no more than the next group's first rows were read
    assert got == [([g // 2] * 7, [g % 2] * 7) for g in range(50)]
    whole = list(common.groups(batches(), ("bucket", "i"), 1 << 30))
    assert [t.num_rows for t in whole] == [350] and list(common.groups(iter([]), ("bucket",), 1)) == []
    one = pa.RecordBatch.from_pydict({"bucket": [1, 1, 2, 3, 3]})
    assert [t.column("bucket").to_pylist() for t in common.groups(iter([one, one.slice(3)]), ("bucket",), 1)] == [[1, 1, 2], [3, 3, 3, 3]]


def test_order_matters(spark):
    a, b = words(200, 8), words(200, 9)
    out = orderminhash.near_duplicates(documents(spark, [(1, " ".join(a + b)), (2, " ".join(b + a)), (3, " ".join(a + b[:-3]))])).collect()
    assert {r.doc_id: r.class_id for r in out} == {1: 1, 2: 2, 3: 1}


def test_rows_without_or_with_shared_ids(spark):
    """A text that only rows without id hold, and two texts under one id."""
    base, other = words(100, 11), words(100, 12)
    rows = [(None, " ".join(base)), (1, " ".join(base[:-2])), (2, " ".join(other)), (2, " ".join(words(90, 13))), (3, " ".join(other[2:]))]
    out = orderminhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.class_id) for r in out), key=repr) == _classes(rows)


def test_empty(spark):
    assert orderminhash.near_duplicates(documents(spark, [])).count() == 0
    assert orderminhash.near_duplicates(documents(spark, [(1, None), (2, "")])).where("kept").count() == 2


def test_components_of_chains_and_stars(spark):
    from tidemart.llm.components import components

    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (500, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 500: 0, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

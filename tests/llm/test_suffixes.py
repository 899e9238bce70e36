"""op 11: repeated byte strings against brute force; induced sorting against plain sorting."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import induced, suffixes

from .data import documents, edge_rows, words


def _brute(rows, k=400):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + k] for t in texts for i in range(len(t) - k + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - k + 1):
            if seen[t[i : i + k]] > 1:
                gone[i : i + k] = b"\1" * k
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


def _rows():
    """Edge rows, passages at odd places, overlapping repeats within a text, near misses and cuts inside characters."""
    long = " ".join(words(400, 50))
    rows = [r for r in edge_rows() if r[0] != 13] + [
        (200, long), (201, "x" + long[7:1500]), (202, long[300:699]), (203, long[300:700]), (204, long[:450] + "Q" + long[450:900]),
        (205, "ab" * 700), (206, "z" * 900), (207, "z" * 399), (208, "漢字é" * 80 + "x" + "漢字é" * 80), (209, None), (210, ""), (211, "y" * 401),
        (212, "\0" * 500), (213, long[1000:] + " " + " ".join(words(100, 51)) + long[1200:]), (None, long[:500]),
    ]
    return rows


def test_edge_rows(spark):
    rows = _rows()
    docs = documents(spark, rows)
    df = suffixes.remove_repeats(docs)
    assert df.columns == [*(c for c in docs.columns if c != "kept"), "n_bytes", "n_removed", "n_spans", "kept"]
    assert _got(df) == _brute(rows)


def test_long_text(spark):
    rows = [(1, " ".join(words(20_000, 7))), (2, " ".join(words(20_000, 7)[5000:5200]))]
    got = {r[0]: r[1:4] for r in _got(suffixes.remove_repeats(documents(spark, rows)))}
    n = len(rows[1][1])
    assert got[2] == (n, n, 1) and got[1] == (len(rows[0][1]), n, 1)


@pytest.mark.parametrize(("shard", "hot", "queue"), [(300, 1 << 30, 0), (2000, 3000, 500), (1 << 20, 0, 0)])
def test_small_shards_hot_anchors_and_queues_on_disk(spark, monkeypatch, shard, hot, queue):
    for name, value in (("SHARD_BYTES", shard), ("HOT_BYTES", hot), ("QUEUE_BYTES", queue), ("SLICE", 700)):
        monkeypatch.setattr(suffixes, name, value)
    monkeypatch.setattr(induced, "SHORT", 50)
    monkeypatch.setattr(induced, "BIN", 40)
    rng = random.Random(shard)
    base = words(60, 3)
    rows = [(i, " ".join(base[rng.randrange(20) : 40 + rng.randrange(20)] + words(rng.randrange(30), i))) for i in range(40)]
    rows = [(i, t[rng.randrange(5) :]) for i, t in rows] + [(50, "ab" * 60), (51, "zz" * 50), (52, rows[3][1]), (52, rows[3][1])]
    assert _got(suffixes.remove_repeats(documents(spark, rows), k=60, gram=8)) == _brute(rows, 60)


def test_empty_tables(spark):
    assert suffixes.remove_repeats(documents(spark, [])).count() == 0
    assert _got(suffixes.remove_repeats(documents(spark, [(1, None), (2, "short")]))) == [(1, 0, 0, 0, b""), (2, 5, 0, 0, b"short")]


def test_induced_sorting_of_random_texts(tmp_path, monkeypatch):
    rng = random.Random(1)
    for trial in range(150):
        n, a, cap = rng.randrange(2, 120), rng.choice([1, 2, 3, 8, 200]), rng.choice([1, 2, 3, 5, 20])
        body = [rng.randrange(1, a + 1) for _ in range(n)]
        if rng.random() < 0.5:
            body = body[: n // 2] * 2 + body[n // 3 :]
        t = [*body, 0]
        for name, choice in (("BIN", (1, 3, 10, 1 << 16)), ("STEP", (1, 2, 7, 1 << 18)), ("SHORT", (1, 2, 5, 1 << 20))):
            monkeypatch.setattr(induced, name, rng.choice(choice))
        spill = induced.Spill(str(tmp_path / str(trial)), rng.choice([0, 50, 1 << 30]))
        got = [x for p, v in induced.sorted_suffixes(np.array(t, np.int32), cap, spill) for x in zip(p.tolist(), v.tolist(), strict=True)]
        spill.close()
        assert {p for p, _ in got} | {len(t) - 1} == set(range(len(t)))
        keys = [t[p : p + cap] for p, _ in got]
        assert keys == sorted(keys, reverse=True)
        for (x, _), (y, v) in zip(got, got[1:], strict=False):
            shared = next((i for i in range(cap) if t[x + i : x + i + 1] != t[y + i : y + i + 1]), cap)
            assert v == shared


def test_queues_go_to_disk_and_leave_nothing(tmp_path):
    rng = np.random.default_rng(3)
    part = rng.integers(1, 60, 5000).astype(np.uint16)
    text = np.concatenate([part, rng.integers(1, 60, 2999), [70], part[1000:], [0]]).astype(np.uint16)
    spill = induced.Spill(str(tmp_path / "q"), 5_000)
    found = induced.shared_with_another(text, 400, spill)
    assert spill.runs > 3
    spill.close()
    assert not (tmp_path / "q").exists()
    assert sorted(np.flatnonzero(found)) == [*range(1000, 4601), *range(8000, 11601)]


def test_shards_take_turns(spark):
    """Several shards met in one task by their hash: with two for each task, some had many and others none."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = " ".join(words(100, 9)).encode()
    rows = [(s, bytes([s % 256, s // 256, i]), bytes([i]) + body, s) for s in range(2 * n) for i in range(2)]
    bodies = spark.createDataFrame(rows, "anchor long, digest binary, body binary, shard long")
    found = suffixes.sorted_shards(bodies, 400, "unused").withColumn("task", F.spark_partition_id())
    held = found.groupBy("task").agg(F.countDistinct("anchor").alias("shards"), F.count("*").alias("runs")).collect()
    assert [(r.shards, r.runs) for r in held] == [(2, 4)] * n


def test_doubling_sorts_only_what_shares_a_rank(monkeypatch):
    rng = random.Random(4)
    plain, sizes = induced._finer, []

    def finer(rank, alive, h):
        sizes.append(len(alive))
        return plain(rank, alive, h)

    monkeypatch.setattr(induced, "_finer", finer)
    for n, repeated, cap in ((2000, 100, 202), (300, 90, 10), (300, 90, 300), (50, 0, 202), (1, 0, 202)):
        sizes.clear()
        names = rng.sample(range(1, 5000), n - repeated - 1)
        names = [*names, *names[:repeated], 0]
        names = np.unique(names, return_inverse=True)[1]
        order, value = induced._doubled(names, cap)
        assert sizes == [2 * (repeated - h + 1) for h in (1 << i for i in range(9)) if h < cap and h <= repeated]  # pairs that share h names
        t = names.tolist()
        keys = [t[p : p + cap] for p in order.tolist()]
        assert sorted(order.tolist()) == list(range(n)) and keys == sorted(keys)
        shared = [next((i for i in range(cap) if x[i : i + 1] != y[i : i + 1]), cap) for x, y in zip(keys, keys[1:], strict=False)]
        assert value.tolist() == [0, *shared]

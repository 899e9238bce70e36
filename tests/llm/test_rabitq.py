"""op 3: all links and components, against all pairs."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import common, rabitq


def _brute(rows):
    ok = [i for i, (a, v) in enumerate(rows) if a is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    parent, links = {i: i for i in range(len(rows))}, [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in ok:
        for j in ok:
            if i < j and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.95:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    low = {}
    for i, (a, _) in enumerate(rows):
        if a is not None:
            low[find(i)] = min(low.get(find(i), a), a)
    return sorted(((a, n, low.get(find(i)) if a is not None else None) for i, ((a, _), n) in enumerate(zip(rows, links))), key=repr)


def _rows():
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(24).tolist()) for i in range(60)]
    for c in range(4):
        center = rng.standard_normal(24)
        rows += [(100 * (c + 1) + i, (center + rng.standard_normal(24) * (0.05 + 0.05 * c)).tolist()) for i in range(40)]
    rows += [(i, rows[70][1]) for i in (901, 902, 902)]  # equal vectors, a repeated row
    rows += [(910, None), (911, []), (912, [0.0] * 24), (913, [1.0, None]), (914, [float("nan")] * 24), (915, [float("inf"), 1.0]), (None, rows[70][1]), (916, [1.0, 2.0]), (917, [10.0, 20.0]), (918, [-1.0, -2.0]), (919, [5.0])]
    return [(a, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for a, v in rows]


@pytest.mark.parametrize("block", [2048, 7])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(rabitq, "BLOCK", block)
    rows = _rows()
    out = rabitq.near_duplicates(spark.createDataFrame([(a, v, 1, "x") for a, v in rows], "vec_id long, embedding array<float>, rep int, n string"))
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out.collect()), key=repr) == _brute(rows)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in out.collect())


def test_tasks_are_sized_by_all_copies_of_a_hot_bucket(spark, monkeypatch):
    """100 like vectors of 512 numbers meet as pairs of 25 blocks in each table."""
    for module, name, value in ((rabitq, "BLOCK", 4), (rabitq, "TASK_BYTES", 1 << 21), (common, "GROUP_BYTES", 1)):
        monkeypatch.setattr(module, name, value)
    sizes, dealt = [], type(spark.range(0)).repartition
    monkeypatch.setattr(type(spark.range(0)), "repartition", lambda df, n, *keys: (sizes.append((n, keys)), dealt(df, n, *keys))[1])
    rng = np.random.default_rng(8)
    center = rng.standard_normal(512)
    rows = [(i, (center + 0.01 * rng.standard_normal(512)).tolist()) for i in range(100)]
    out = rabitq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id) for r in out} == {(99, 0)}
    _, tables = rabitq.shape(100, rabitq.THRESHOLD, rabitq.MISS)
    (spread,) = [n for n, keys in sizes if "key" in keys]
    assert spread >= 100 * tables * 512 * 8 * 10 // (1 << 21)


def test_many_links_of_a_group_are_folded(monkeypatch):
    rng = np.random.default_rng(9)
    x = rabitq.unit(np.concatenate([rng.standard_normal(32) + 0.02 * rng.standard_normal((60, 32)) for _ in range(3)]))
    rng.shuffle(x)
    keys, code, factor = rabitq.encode(x, 1, 2)
    keys[:] = 0
    n = len(x)
    column = {"rep": np.arange(n) + 5, "copies": np.ones(n, np.int64), "d": np.full(n, 32, np.int32), "x": [v.tobytes() for v in x], "code": [v.tobytes() for v in code], "factor": factor, "t": np.zeros(n, np.int32), "key": keys[:, 0], "i": np.zeros(n, np.int32), "j": np.zeros(n, np.int32), "side": np.zeros(n, np.int32), "packed": [v.tobytes() for v in keys]}
    table = pa.table(column)
    want = [b.to_pydict() for b in rabitq._compare(table, 0.95, 5.0)]
    assert len(set(want[0]["low"])) == 3 and set(want[0]["n"]) == {59}
    monkeypatch.setattr(rabitq, "CHUNK", 100)
    assert [b.to_pydict() for b in rabitq._compare(table, 0.95, 5.0)] == want


def test_empty(spark):
    assert rabitq.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_estimate_is_unbiased_and_the_bound_holds():
    rng = np.random.default_rng(5)
    d, n = 64, 4000
    x = rabitq.unit(rng.standard_normal((n, d)))
    y = rabitq.unit(x + 0.25 * rng.standard_normal((n, d)) / 8)  # cosine about 0.97
    _, code, factor = rabitq.encode(x, 8, 4)
    signs = np.where(np.unpackbits(code, axis=1, count=d), 1.0, -1.0)
    turned = y @ rabitq.rotation(d, 0).T
    real = np.einsum("ij,ij->i", x, y)
    estimate = np.einsum("ij,ij->i", signs, turned) / (math.sqrt(d) * factor)
    assert abs((estimate - real).mean()) < 0.003
    both = np.arange(n)
    near, exact = rabitq.linked(np.concatenate([x, y]), np.concatenate([signs, signs]), np.concatenate([factor, factor]), both + n, both, np.concatenate([turned, turned]), 0.95, 5.0)
    assert set(np.flatnonzero(real >= 0.95)) <= set(near[exact])


def test_few_random_pairs_are_recomputed():
    rng = np.random.default_rng(6)
    x = rabitq.unit(rng.standard_normal((500, 64)))
    _, code, factor = rabitq.encode(x, 8, 4)
    signs = np.where(np.unpackbits(code, axis=1, count=64), 1.0, -1.0)
    a, b = np.triu_indices(500, 1)
    near, exact = rabitq.linked(x, signs, factor, a, b, x @ rabitq.rotation(64, 0).T, 0.95, 5.0)
    assert len(near) < 0.001 * len(a) and not exact.any()

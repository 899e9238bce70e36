"""op 13: best-first search under range maxima against the plain score of every document."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import ranked

from .data import alnum, documents, edge_rows, passage, words


def _brute(rows, items, k=10):
    docs = [(i, Counter(alnum(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        found = []
        for doc, c in docs:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(ranked.weight(n, df[t]) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(alnum(text)) if t in c)
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, r, doc, -score) for r, (score, _, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def _table(spark, items):
    return spark.createDataFrame([(a, t, 1) for a, t in items], "item_id string, text string, doc_id int")


def _got(spark, rows, items, partitions=3, **kw):
    df = ranked.search(ranked.build(documents(spark, rows, partitions)), _table(spark, items), **kw)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


ITEMS = [("a", passage()), ("b", "one TWO"), ("c", None), ("d", ""), ("e", "!?"), (None, "wort w5 w6 w7"), ("f", "nowhere atall"), ("a", "w1 w2 w3 w4 w1"), ("b", "one TWO"), ("g", " ".join(words(300, 1)))]


def test_edge_rows(spark):
    assert _got(spark, edge_rows(), ITEMS) == _brute(edge_rows(), ITEMS)


def test_small_shards_blocks_and_steps(spark, monkeypatch):
    for name, value in (("SHARD_BYTES", 300), ("BLOCK_BYTES", 200), ("WIDTH", 2), ("LEAF", 1), ("PAIRS", 3)):
        monkeypatch.setattr(ranked, name, value)
    rows = [r for r in edge_rows() if r[0] != 13]
    assert _got(spark, rows, ITEMS, k=3) == _brute(rows, ITEMS, 3)


def test_random_texts_with_ties(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(500), " ".join(words(rng.randrange(1, 60), i % 150, 40 + i % 300))) for i in range(1500)]
    items = [(str(i), " ".join(words(rng.randrange(1, 25), 9000 + i, 200))) for i in range(20)]
    assert _got(spark, rows, items) == _brute(rows, items)


def test_few_intervals_are_opened_for_a_rare_term():
    rng = random.Random(2)
    texts = [" ".join(words(50, i, 60)) + (" rare" if i in (700, 1900) else "") for i in range(3000)]
    h, first = ranked.terms_of(pa.array(texts))
    assert len(first) == 3001 and rng
    order = np.argsort(h, kind="stable")
    doc = np.repeat(np.arange(3000, dtype=np.uint32), np.diff(first))[order]
    pairs, counts = np.unique(np.stack([h[order], doc.astype(np.uint64)]), axis=1, return_counts=True)
    terms, at = np.unique(pairs[0], return_index=True)
    shard = ranked._Shard({"doc_ids": list(range(3000)), "sizes": np.diff(first).astype(np.int64).tobytes(), "terms": terms.tobytes(), "offsets": np.append(at, pairs.shape[1]).astype(np.int64).tobytes(), "docs": pairs[1].astype(np.uint32).tobytes(), "counts": counts.astype(np.uint32).tobytes()})
    items = ranked._read_items([{"item": 1, "text": "rare w1 w2"}])
    df = {t: int(n) for t, n in zip(terms.tolist(), np.diff(np.append(at, pairs.shape[1])), strict=True)}
    weights = np.array([ranked.weight(3000, df[t]) for t in items.terms.tolist()])
    asked = []
    bounds = ranked._Search.bounds
    ranked._Search.bounds = lambda self, i, a, b: asked.append(len(i)) or bounds(self, i, a, b)
    try:
        _, docs, _ = ranked.search_shard(shard, items, weights, 3000, len(h), np.zeros(1, np.int64), 2, None)
    finally:
        ranked._Search.bounds = bounds
    assert sorted(docs.tolist()) == [700, 1900] and sum(asked) < 600


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "..."), (None, "")]])
def test_empty_tables(spark, rows):
    assert _got(spark, rows, ITEMS) == []
    assert _got(spark, edge_rows()[:3], []) == []

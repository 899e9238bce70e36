"""op 7: phrases and proximity against brute force; blocks of items."""

from tidemart.llm import decontam

from .data import alnum, documents, edge_rows, passage, words


def _items():
    w = passage().split()
    return [(1, " ".join(w[10:40])), (2, "ONE two"), (3, None), (4, ""), (5, "!!"), (6, " ".join(w[:9])), (6, " ".join(w[30:45]).upper()), (None, " ".join(w[50:62])), (7, "wort " * 12), (8, "nowhere at all"), (10, "x x"), (9, "one")]


def _brute(rows, items, k=10):
    phrases = []
    for item, text in items:
        w = alnum(text)
        n = min(k, len(w))
        phrases += [(item, w[i : i + n]) for i in range(len(w) - n + 1 if n else 0)]
    out = []
    for doc, text in rows:
        w = alnum(text)
        hit, names = set(), set()
        for item, p in phrases:
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    names.add(item)
        out.append((doc, len(w), len(hit), sorted(str(x) for x in names if x is not None), bool(hit)))
    return sorted(out, key=repr)


def _table(spark, items):
    return spark.createDataFrame([(a, t, 1) for a, t in items], "item_id long, text string, doc_id int")


def _got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in df.collect()), key=repr)


def test_edge_rows(spark):
    rows = [r for r in edge_rows() if r[0] != 13]  # the brute force is slow on the long text
    assert _got(decontam.contamination(documents(spark, rows), _table(spark, _items()))) == _brute(rows, _items())


def test_items_in_blocks_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 100)
    monkeypatch.setattr(decontam, "SHARD_BYTES", 500)
    rows = [r for r in edge_rows() if r[0] != 13]
    assert _got(decontam.contamination(documents(spark, rows), _table(spark, _items()))) == _brute(rows, _items())


def test_no_phrase_crosses_documents(spark):
    w = words(20, 3)
    rows = [(1, " ".join(w[:10])), (2, " ".join(w[10:])), (3, " ".join(w))]
    got = _got(decontam.contamination(documents(spark, rows, partitions=1), _table(spark, [(1, " ".join(w[5:15]))])))
    assert [(r[0], r[2]) for r in got] == [(1, 0), (2, 0), (3, 10)]


def test_empty_tables(spark):
    assert decontam.contamination(documents(spark, []), _table(spark, _items())).count() == 0
    got = _got(decontam.contamination(documents(spark, [(1, "a b")]), _table(spark, [])))
    assert got == [(1, 2, 0, [], False)]


def test_proximity(spark):
    rows = [(1, "a x x b x c"), (2, "c a b"), (3, "a x x x x x b c"), (4, "a b"), (5, None), (6, "b a x c x a b x c")]
    got = decontam.proximity_matches(decontam.build(documents(spark, rows, partitions=1)), {"q": "A b C"}, 5).collect()
    expected = []
    for doc, text in rows:
        w = alnum(text)
        runs = [(i, j) for i in range(len(w)) for j in range(i + 1, min(i + 5, len(w)) + 1) if {"a", "b", "c"} <= set(w[i:j])]
        expected += [(doc, i, j) for i, j in runs if not any((x, y) != (i, j) and x >= i and y <= j for x, y in runs)]
    assert sorted((r.doc_id, r.lo, r.hi) for r in got) == sorted(expected)


def test_repeated_items_are_read_once(spark, monkeypatch):
    """Equal rows fall in one block, whatever its bound."""
    items = [(7, "a b c d e f g h i j k")] * 500 + [(i, f"x{i} y z") for i in range(100, 140)]
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 200)
    blocks = list(decontam._blocks(_table(spark, items), "item_id", "text"))
    assert sorted(x for b in blocks for x in b) == sorted({(str(i), t) for i, t in items}) and max(map(len, blocks)) < 41


def test_windows_of_large_blocks_are_arrays():
    """A block of items costs some 20 bytes a byte of text, not Python objects for each window."""
    import tracemalloc

    texts = [" ".join(words(2000, i, 50_000)) for i in range(200)] + ["one two", "one two", "", "!"]
    tracemalloc.start()
    found = decontam.phrases_of(texts, 10)
    now, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert now < 25 * sum(map(len, texts))
    assert [p.windows.shape for p in found] == [(1, 2), (200 * 1991, 10)] and found[0].item.tolist() == [200, 201]
    assert found[1].at[-1] == len(found[1].item) == 200 * 1991

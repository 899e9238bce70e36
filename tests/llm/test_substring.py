"""op 5: against a walk over all windows."""

from tidemart.llm import queries, substring

from .data import SF, SPACED, documents, edge_rows, words


def brute(rows, k=50):
    first, out = {}, []
    ordered = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    for doc, text in ordered:
        w = SPACED.findall(text or "")
        for i in range(len(w) - k + 1):
            first.setdefault(tuple(w[i : i + k]), doc)
    for doc, text in rows:
        w = SPACED.findall(text or "")
        gone = [False] * len(w)
        if doc is not None:
            for i in range(len(w) - k + 1):
                if first[tuple(w[i : i + k])] < doc:
                    gone[i : i + k] = [True] * k
        out.append((doc, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()), key=repr)


def test_edge_rows(spark):
    out = substring.remove_repeats(documents(spark))
    assert {"lang", "n_words", "kept_text", "seed", "h"} <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    assert _got(out) == brute(edge_rows())


def test_branching_passages(spark):
    """Passages cut, extended and joined differently in each document."""
    a, b, c = words(90, 1), words(70, 2), words(55, 3)
    rows = [(1, a + b), (2, a[20:] + b[:40]), (3, b + a), (4, c + a[10:75] + c), (5, a[:60] + c + b[5:]), (6, b[:49]), (7, b[:50]), (8, a[:49] + ["x"] + a[49:]), (9, c * 3), (10, ["z"] + c)]
    rows = [(i, " ".join(w)) for i, w in rows]
    assert _got(substring.remove_repeats(documents(spark, rows))) == brute(rows)


def test_small_windows_over_few_words(spark):
    """Many ties and repeats: an alphabet of few words."""
    rows = [(i, " ".join(words(60, i, vocabulary=3))) for i in range(25)]
    assert _got(substring.remove_repeats(documents(spark, rows), k=8, seed=3)) == brute(rows, 8)


def test_query_over_a_whole_table(spark):
    import hashlib

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    expected = sorted((d, n, m, hashlib.sha256(t.encode()).hexdigest()) for d, n, m, t in brute(rows))
    assert sorted(map(tuple, queries.op5_substring_dedup(spark, SF).collect())) == expected


def test_empty(spark):
    assert substring.remove_repeats(documents(spark, [])).count() == 0

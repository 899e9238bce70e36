"""The corpus pipeline: each stage against what it must keep and drop."""

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm import common

from .data import SF, alnum
from .test_substring import brute


def test_stages_over_a_whole_table(spark):
    docs = common.table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        after = common.stored(stage(spark, docs, SF), f"test-{name}")
        kept[name] = (docs, after)
        docs = after
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_dedup", "substring_dedup", "decontamination", "bpe"]
    for name in list(kept)[:-1]:
        assert kept[name][1].columns == columns

    # filters return rows of their input, unchanged
    for name in ("toxicity", "minhash_dedup", "decontamination"):
        before, after = kept[name]
        assert after.exceptAll(before).count() == 0 and after.count() < before.count()
    labels = common.table(spark, SF, "labels")
    before, after = (x.join(labels, "doc_id").groupBy("toxic").count().rdd.collectAsMap() for x in kept["toxicity"])
    assert after.get(1, 0) < 0.4 * before[1] and after[0] > 0.97 * before[0]

    # no exact copies are left, and each dropped text has a near copy that stays
    before, after = kept["minhash_dedup"]
    assert after.select(F.countDistinct("text")).first()[0] == after.count()
    stay = {r.doc_id: set(zip(*[alnum(r.text)[i:] for i in range(5)])) for r in after.collect()}
    for r in before.join(after, "doc_id", "left_anti").collect():
        own = set(zip(*[alnum(r.text)[i:] for i in range(5)]))
        assert not own or any(len(own & s) >= 0.6 * len(own | s) for s in stay.values())

    before, after = kept["substring_dedup"]
    expected = {d: (m, t) for d, _, m, t in brute([(r.doc_id, r.text) for r in before.collect()])}
    texts = {r.doc_id: r.text for r in before.collect()}
    assert {r.doc_id: r.text for r in after.collect()} == {d: t if m else texts[d] for d, (m, t) in expected.items()}

    before, after = kept["decontamination"]
    windows = set()
    for r in common.table(spark, SF, "benchmark").collect():
        w = alnum(r.text)
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1 if n else 0)}
    sizes = {len(w) for w in windows}
    clean = {r.doc_id for r in before.collect() if not any(tuple(w[i : i + n]) in windows for w in [alnum(r.text)] for n in sizes for i in range(len(w) - n + 1))}
    assert {r.doc_id for r in after.collect()} == clean

    before, after = kept["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.round_trip and r.ids == ",".join(map(str, library.encode(texts[r.doc_id]).ids))


def test_decisions_hold_for_rows_without_or_with_shared_ids(spark, tmp_path):
    from .data import documents, words

    a, b, c, d, e, leak = (words(100, 20 + i) for i in range(6))
    text = " ".join
    rows = [
        (1, text(a)), (1, text(b)), (2, text(a[1:])), (1, text(b[1:])),  # two texts under one id, each with a near copy; one of those under it too
        (None, text(c)), (None, text(c[2:])), (3, text(d)), (None, text(d[1:])),  # near copies without id
        (4, text(e)), (4, text(leak)), (None, text(leak[50:])), (5, None), (None, None), (3, text(d)),
    ]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    left = [(r.doc_id, r.text) for r in corpus_pipeline.minhash_dedup(spark, docs, "").collect()]
    assert len(left) == len(set(left)) and set(left) <= set(rows)
    kept = lambda *texts: [r for r in left if r[1] in {text(t) for t in texts}]
    assert kept(a, a[1:]) == [(1, text(a))] and len(kept(b, b[1:])) == 1 and len(kept(c, c[2:])) == 1 and kept(d, d[1:]) == [(3, text(d))]
    assert {(4, text(e)), (4, text(leak)), (5, None), (None, None)} <= set(left)
    spark.createDataFrame([(1, text(leak[60:80]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(r.doc_id, r.text) for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()]
    assert sorted(clean, key=repr) == sorted((r for r in rows if r[1] not in (text(leak), text(leak[50:]))), key=repr)


def test_edge_rows_pass_all_stages(spark, tmp_path):
    from .data import documents

    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name in ("labels", "benchmark"):
        common.table(spark, SF, name).write.parquet(f"{tmp_path}/{name}.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r.doc_id for r in out]
    assert {1, 4, 5, 7, 10, 11, 13} <= set(ids) and not {2, 3, 15} & set(ids) and len([i for i in ids if i is not None]) == len(set(ids) - {None})


def test_empty_tables_pass_all_stages(spark, tmp_path):
    from .data import documents

    documents(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        common.table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns_pass_all_stages(spark):
    """Columns named like results of the operators are those of the documents after each stage."""
    from .data import documents

    docs = documents(spark, [(1, "one two three"), (2, None), (3, "a b " * 300)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.schema.simpleString() == docs.schema.simpleString(), name
        assert after.where("n_words = 'x' and score = 'y' and ids = 1 and items = 2 and kept and h = 3 and node = 5").count() == 3, name

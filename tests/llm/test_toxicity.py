"""op 10: noisy-or, held-out accuracy, the offending sentences."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemart.llm import queries, textops, toxicity

from .data import SF, documents, words


def _made(n=600):
    """Every third document holds one or two bad words, in one sentence among many."""
    rows = []
    for i in range(n):
        sentences = [" ".join(words(8, 31 * i + s, vocabulary=300)) for s in range(5 + i % 20)]
        if i % 3 == 0:
            sentences[i % len(sentences)] += [" badword", " Awful!", " vileness", " badwords vilest"][i // 3 % 4]
        rows.append((i, ". ".join(sentences), int(i % 3 == 0)))
    return rows


def test_learns_and_locates(spark):
    rows = _made()
    docs = documents(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], r[2], "x") for r in rows] + [(None, 1, "x"), (5000, None, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model).select("doc_id", "score", "predicted", toxicity.held_out().alias("held")).collect()
    truth = {r[0]: r[2] for r in rows}
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert all(r.predicted == truth[r.doc_id] == (r.score >= 0.7) for r in out)
    found = toxicity.offending(docs, model).collect()
    assert {r.doc_id for r in found} == {i for i, y in truth.items() if y}
    assert all(any(b in r.sentence.lower() for b in ("bad", "awful", "vile")) for r in found)


def test_score_is_noisy_or_of_whole_texts():
    model = toxicity.train([r[1] for r in _made()], np.array([r[2] for r in _made()]))
    clean, bad = " ".join(words(7, 1, 300)), "so awful"
    score = lambda t: float(model.scores(*textops.buffers(pa.array([t])))[0])
    one, p = score(clean), score(bad)
    assert abs(score(f"{clean}. {clean}? {bad}! {clean}") - (1 - (1 - one) ** 3 * (1 - p))) < 1e-9
    assert abs(score(bad + " awful" * 50) - score(bad)) < 1e-9  # a word counts once a sentence
    assert score((clean + ". ") * 2000 + bad) >= p - 1e-9
    assert score("") == score(" .!? ") == 0.0


def test_held_out_accuracy(spark):
    out = queries.op10_toxicity(spark, SF.replace("0.01", "0.1")).join(spark.read.parquet(f"{SF.replace('0.01', '0.1')}/labels.parquet"), "doc_id").where("held_out").collect()
    y, s = np.array([r.toxic for r in out]), np.array([r.score for r in out])
    rank = s.argsort().argsort()
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    assert auc > 0.94
    predicted = np.array([r.predicted for r in out])
    assert predicted[y == 1].mean() > 0.8 and predicted[y == 0].mean() < 0.02


def test_without_both_classes(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for table in (labels, labels.limit(0)):
        out = toxicity.score(docs, toxicity.fit(docs, table))
        assert out.where("score <> 0 or predicted <> 0").count() == 0
        assert out.where(F.col("lang") == "en").count() == docs.count()
    assert toxicity.score(documents(spark, []), toxicity.fit(docs, labels)).count() == 0


def test_long_texts_are_replaced_or_kept_whole(spark):
    """A class whose texts are all or mostly beyond the bound."""
    rows = [(i, t if i % 3 else t + (" x" * 300 if i % 2 else " x" * 400), y) for i, t, y in _made()]
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    for rows_, bound in ((600, 100), (600, 1000), (60, 3000)):
        model = toxicity.fit(documents(spark, [r[:2] for r in rows]), labels, rows=rows_, text_bytes=bound)
        assert len(model.keys) and model.scores(*textops.buffers(pa.array(["so awful", "all is well"]))).tolist()[0] > 0.7


def test_long_clean_texts_stay_clean():
    rows = _made()
    model = toxicity.train([r[1] for r in rows], np.array([r[2] for r in rows]))
    clean = [". ".join(" ".join(words(8, 7 * s, vocabulary=300)) for s in range(n)) for n in (10, 1000, 6000)]
    assert max(model.scores(*textops.buffers(pa.array(clean)))) < 0.1
    assert model.scores(*textops.buffers(pa.array([clean[2] + ". so awful"])))[0] > 0.7


def test_rare_words_of_a_large_sample_count():
    """A word of 20 in 3,000 toxic texts."""
    rows = [(" ".join(words(8, i, vocabulary=300)) + (". zyxwv" if i < 20 else ". badword" if i < 3000 else ""), i < 3000) for i in range(6000)]
    model = toxicity.train([r[0] for r in rows], np.array([r[1] for r in rows]))
    assert model.scores(*textops.buffers(pa.array(["zyxwv", "badword"]))).min() > 0.7


def test_few_labels_teach_nothing(spark):
    """Two toxic texts among many: no word of theirs makes another text toxic."""
    texts = [" ".join(words(60, i, vocabulary=500)) for i in range(200)]
    assert not len(toxicity.train(texts, np.arange(200) < 2).keys)
    assert not len(toxicity.train(texts[:12], np.arange(12) < 6).keys)
    model = toxicity.train([t + " awful" * (i < 5) for i, t in enumerate(texts)], np.arange(200) < 5)
    assert model.scores(*textops.buffers(pa.array(texts))).max() < 0.7
    assert model.scores(*textops.buffers(pa.array(["so awful"])))[0] > 0.5

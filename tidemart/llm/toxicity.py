"""Toxicity by multiple-instance learning: sentences scored, documents labelled.

A sentence's probability is a logistic function of the words it holds; a
document's score is the noisy-or of its sentences, 1 - prod(1 - p), so training
needs document labels only and finds the offending sentences by itself.

Words are runs of ASCII letters and digits (A-Z lower-cased) and characters
beyond ASCII; features are words and their first 4, 5 and 6 bytes (known word
stems with endings never seen count too).  Sentences end at ``. ! ?`` or a line end.
Only features that are markedly more frequent in toxic documents get a weight:
everything else cannot make a document toxic.  A sentence without weighted
features scores 0, so long clean texts do not add up to a toxic one.

The model is fitted on a bounded sample, in one task: at most ``TRAIN_ROWS``
labelled texts of each class, of all texts of at most ``TRAIN_BYTES`` bytes those
with the smallest hashes of doc_id.  If these are too few, the shortest of the
longer texts follow, whole, until the class has ``TRAIN_ROWS`` rows or
``TRAIN_ROWS`` x ``TRAIN_BYTES`` bytes (one text more, if it alone has more); only the weights (at most
``MAX_FEATURES``) come to the driver.  Scoring covers whole texts of all rows.
Labels, lang, source and doc_id are never features.

Defined results: null and empty texts have no sentence and score 0; labels that
are null, or rows in the held-out part, are not learned from; of several labels
for one doc_id all count; with fewer than ``LEAST_DOCS`` texts of a class or
``LEAST_LABELLED`` in all (words of one or two texts say nothing), or without
rows of both classes, every score is 0; other columns pass through, but the result's own columns replace columns of the same
name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm import common, textops

TRAIN_ROWS, TRAIN_BYTES = 3000, 16 << 10
MAX_FEATURES, LEAST_DOCS, LEAST_SHARE, LEAST_ODDS = 20_000, 4, 0.01, 1.5
LEAST_LABELLED = 20
#: Toxic documents that are enough for a feature, however many there are.
ENOUGH_DOCS = 12
THRESHOLD = 0.7
STEMS = (4, 5, 6)
SLICE = 2 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[0x21, 0x2E, 0x3F, 0x0A]] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """Words (starts, ends), and the sentence and text of each word; sentences are numbered over all texts."""
    starts, ends, first = textops.scan(data, offsets, textops.ALNUM)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    breaks = np.cumsum(_BREAK[data], dtype=np.int64)[starts] if len(data) else starts
    new = np.ones(len(starts), bool)
    new[1:] = (breaks[1:] != breaks[:-1]) | (text[1:] != text[:-1])
    return starts, ends, np.cumsum(new) - 1, text


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray | slice, np.ndarray]]:
    """(words, hashes): whole words first, then the stems of longer words."""
    yield slice(None), textops.hashes(data, starts, ends, textops.FOLD)
    for size in STEMS:
        at = np.flatnonzero(ends - starts > size)
        # a stem is no word: other hashes
        yield at, textops.hashes(data, starts[at], starts[at] + size, textops.FOLD) ^ np.uint64(0x5DEECE66D * size)


@dataclass
class Model:
    """Sorted feature hashes with weights, and the bias of a sentence."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.seen = np.zeros(1 << 20, bool)  # a first look that most words fail
        self.seen[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def logits(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sentences with known features, and the weights of those; a feature counts once a sentence."""
        pairs = [np.zeros(0, np.int64)]
        for at, h in features(data, starts, ends):
            own = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
            if len(own):
                place = np.minimum(np.searchsorted(self.keys, h[own]), len(self.keys) - 1)
                hit = self.keys[place] == h[own]
                words = own[hit] if isinstance(at, slice) else at[own[hit]]
                pairs.append(sentence[words] * len(self.keys) + place[hit])
        pair = np.unique(np.concatenate(pairs))
        return pair // len(self.keys), self.weights[pair % len(self.keys)]

    def sentence_scores(self, data: np.ndarray, offsets: np.ndarray):
        """Scores of the sentences that hold weighted words (number, p), text and count of all sentences."""
        starts, ends, sentence, text = sentences(data, offsets)
        n = int(sentence[-1]) + 1 if len(sentence) else 0
        whose = np.zeros(n, np.int64)
        whose[sentence] = text
        hit, weights = self.logits(data, starts, ends, sentence)
        own, at = np.unique(hit, return_inverse=True)
        z = np.bincount(at, weights, len(own)) + self.bias
        return starts, ends, sentence, own, 1 / (1 + np.exp(-np.clip(z, -60, 60))), whose, n

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Noisy-or of each text's sentences."""
        if not len(self.keys):
            return np.zeros(len(offsets) - 1)
        *_, own, p, whose, _ = self.sentence_scores(data, offsets)
        texts = len(offsets) - 1
        miss = np.bincount(whose[own], np.log1p(-np.minimum(p, 1 - 1e-12)), texts)
        return -np.expm1(miss)


def train(texts: list[str], labels: np.ndarray, rounds: int = 300, l2: float = 1e-3) -> Model:
    """Maximum likelihood of noisy-or over sentences; features are chosen by document frequency."""
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    y = np.asarray(labels, bool)
    if min(y.sum(), (~y).sum()) < LEAST_DOCS or len(y) < LEAST_LABELLED:
        return empty
    data, offsets = textops.buffers(pa.array(texts, pa.large_string()))
    slices = textops.slices(offsets, SLICE // 4)

    # features of enough toxic documents (a document counts once)
    found = [np.zeros(0, np.uint64)]
    for i in np.flatnonzero(y):
        own = data[offsets[i] : offsets[i + 1]]
        starts, ends, _, _ = sentences(own, np.array([0, len(own)]))
        found.append(np.unique(np.concatenate([h for _, h in features(own, starts, ends)])))
    keys, toxic = np.unique(np.concatenate(found), return_counts=True)
    enough = toxic >= max(LEAST_DOCS, min(ENOUGH_DOCS, LEAST_SHARE * y.sum()))
    keys, toxic = keys[enough], toxic[enough]
    if not len(keys):
        return empty

    # where they stand: (sentence, feature) once each, and the document of each sentence
    pairs, owners, base = [], [], 0
    for i, j in slices:
        o = offsets[i : j + 1]
        starts, ends, sentence, text = sentences(data[o[0] : o[-1]], o - o[0])
        whose = np.zeros(int(sentence[-1]) + 1 if len(sentence) else 0, np.int64)
        whose[sentence] = text + i
        for at, h in features(data[o[0] : o[-1]], starts, ends):
            place = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero(keys[place] == h)
            pairs.append(np.unique((sentence[at][hit] + base) * len(keys) + place[hit]))
        owners.append(whose)
        base += len(whose)
    pair, whose = np.unique(np.concatenate(pairs)), np.concatenate(owners)
    in_clean = ~y[whose[pair // len(keys)]]
    once = np.unique(whose[pair[in_clean] // len(keys)] * len(keys) + pair[in_clean] % len(keys))
    clean = np.bincount(once % len(keys), minlength=len(keys))
    odds = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((clean + 0.5) / ((~y).sum() + 1))
    good = np.flatnonzero(odds >= LEAST_ODDS)
    good = np.sort(good[np.argsort(-(toxic * odds)[good], kind="stable")[:MAX_FEATURES]])
    if not len(good):
        return empty
    number = np.full(len(keys), -1)
    number[good] = np.arange(len(good))
    pair = pair[number[pair % len(keys)] >= 0]
    pair = pair // len(keys) * len(good) + number[pair % len(keys)]
    own, row = np.unique(pair // len(good), return_inverse=True)
    col, who = pair % len(good), whose[own]
    # both classes weigh the same
    share = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
    w, b = odds[good], -6.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], len(own)) + b, -30, 30)))
        miss = np.exp(np.bincount(who, np.log1p(-p + 1e-12), len(y)))
        pull = np.where(y, miss / np.maximum(1 - miss, 1e-9), -1.0) * share  # d log likelihood / d -log(1 - p)
        gz = pull[who] * p
        gw = np.bincount(col, gz[row], len(w)) - l2 * w / len(w)
        gb = gz.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        c, d = 1 - 0.9**t, 1 - 0.99**t
        w = np.maximum(w + 0.1 * (m / c) / (np.sqrt(v / d) + 1e-9), 0)  # evidence for, never against
        b += 0.1 * (mb / c) / (np.sqrt(vb / d) + 1e-9)
    return Model(keys[good], w, float(b))


def held_out(doc_id: str = "doc_id"):
    """The rows that are kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, text_bytes: int = TRAIN_BYTES) -> Model:
    """Train on at most ``rows`` rows of each class."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").where(~held_out())
    read = docs.select("doc_id", "text", F.octet_length("text").alias("size")).where("size is not null")
    there = known.join(read.select("doc_id", "size").distinct(), "doc_id")
    upto = Window.orderBy("at", "hash", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    chosen = []
    for c in (0, 1):
        # texts within text_bytes by hash, then the shortest of the longer ones
        first = there.where(F.col("toxic") == c).withColumns({"at": F.greatest("size", F.lit(text_bytes)), "hash": F.xxhash64("doc_id")}).orderBy("at", "hash", "doc_id").limit(rows)
        first = first.withColumns({"total": F.sum(F.col("size").cast("long")).over(upto), "nth": F.count("*").over(upto)})
        chosen.append(first.where((F.col("total") <= rows * text_bytes) | (F.col("nth") == 1)).select("doc_id", "size", "toxic"))
    # at most 2 * rows triples of numbers: the bound that makes the broadcast safe
    sample = read.join(F.broadcast(chosen[0].union(chosen[1])), ["doc_id", "size"]).select("doc_id", "text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted({r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)})
        model = train([r[1] for r in got], np.array([r[2] for r in got], int))
        yield pa.RecordBatch.from_arrays([pa.array([model.keys.tobytes()]), pa.array([model.weights.tobytes()]), pa.array([model.bias])], ["keys", "weights", "bias"])

    common.prepare(docs.sparkSession)
    got = sample.repartition(1).mapInArrow(run, "keys binary, weights binary, bias double").first()
    if got is None:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    return Model(np.frombuffer(got["keys"], np.uint64), np.frombuffer(got["weights"]), got["bias"])


def score(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with score and predicted."""
    spark = docs.sparkSession
    common.prepare(spark)
    base = docs.drop("score", "predicted")
    out = common.extended(base, score="double", predicted="int")
    sent = spark.sparkContext.broadcast(model)  # at most MAX_FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(b.column(b.num_columns - 1))
            found = [np.zeros(0)]
            for i, j in textops.slices(offsets, SLICE):
                o = offsets[i : j + 1]
                found.append(sent.value.scores(data[o[0] : o[-1]], o - o[0]))
            s = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[f.name for f in out])

    return base.select("*", F.col(text_col).cast("string").alias("__td_text")).mapInArrow(run, out)


def offending(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """doc_id, sentence (its words from the first to the last), p: sentences scored ``least`` or more."""
    spark = docs.sparkSession
    common.prepare(spark)
    sent = spark.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("sentence", pa.string()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = textops.buffers(b.column(1))
            ids, rows = b.column(0).to_pylist(), []
            if len(sent.value.keys):
                starts, ends, sentence, own, p, whose, n = sent.value.sentence_scores(data, offsets)
                first = np.searchsorted(sentence, own)
                last = np.searchsorted(sentence, own, "right") - 1
                for k in np.flatnonzero(p >= least):
                    text = data[starts[first[k]] : ends[last[k]]].tobytes().decode("utf-8", "replace")
                    rows.append((ids[whose[own[k]]], text, float(p[k])))
            yield from common.emit(rows, schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, sentence string, p double")

"""Corpus pipeline over ``documents``: each stage applies one operator of tidemart.llm.

Every stage is written as Parquet and read again as the next stage's input, so
a lost executor never costs more than the running stage.  All stages but the
last return the columns of ``documents``; the last one returns the encoding of
each document that is left.  A stage works on all that its predecessor kept.

A null text passes the filters (it has no words) and is encoded as no ids.  Texts
of any length are read whole: each operator cuts its work, not the text.  Empty
tables pass as empty ones.  Other columns of the documents, whatever their names,
pass through the stages unchanged (``substring_dedup`` adjusts ``n_chars``).
Decisions about copies and phrases name rows by doc_id and text, so they hold
for rows without doc_id and for several texts under one.  Of copies the row with
the smallest doc_id stays (one without id only if no copy has one), and of equal
rows one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import common, decontam, orderminhash, substring, toxicity, trie_bpe

_KEY, _ROW = "__td_key", "__td_row"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _aside(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns in one, so that no result of an operator replaces one of them."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias(_ROW))


def _back(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` from rows that have been put aside."""
    own = {"text": F.col("text"), **changed}
    return [own[c].alias(c) if c in own else F.col(f"{_ROW}.`{c}`").alias(c) for c in docs.columns]


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the model, trained on their labels, predicts to be toxic."""
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.score(_aside(docs), model).where("predicted = 0").select(*_back(docs))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near copies: that with the smallest doc_id."""
    classes = orderminhash.near_duplicates(docs, by_row=True)
    dropped = classes.where("not kept").select(F.col("row").alias(_KEY)).distinct()
    left = docs.withColumn(_KEY, orderminhash.row_key()).join(dropped, _KEY, "left_anti")
    return left.dropDuplicates(["doc_id", _KEY]).select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove the words of repeated 50-word windows; texts that lose none stay as they are."""
    out, changed = substring.remove_repeats(_aside(docs)), F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col(f"{_ROW}.n_chars"))
    return out.select(*_back(docs, text=text, n_chars=n_chars))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which phrases of benchmark items occur."""
    keyed = docs.withColumn(_KEY, orderminhash.row_key())
    found = decontam.contamination(keyed.select(F.col(_KEY).alias("doc_id"), "text"), common.table(spark, sf_dir, "benchmark"))
    dropped = found.where("contaminated").select(F.col("doc_id").alias(_KEY)).distinct()
    return keyed.join(dropped, _KEY, "left_anti").select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by commas) and whether they decode to the text."""
    out = trie_bpe.encode_decode(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_tokens", "ids", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_filter),
    ("minhash_dedup", minhash_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("bpe", encoding),
]

#: A trained model, sketches and a tokenizer: SQL cannot express the rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Small tables for the tests: edge cases that every operator must take."""

import random
import re

SF = "/root/testdata/sf0.01"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = {i: i + 32 for i in range(0x41, 0x5B)}


def words(n, seed, vocabulary=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def alnum(text):
    return ALNUM.findall((text or "").translate(_LOW))


def passage(n=70, seed=99):
    return " ".join(words(n, seed))


def edge_rows():
    """(doc_id, text): nulls, empty and long texts, copies, near copies, repeated rows, shared passages."""
    base = words(300, 1)
    near = base.copy()
    near[150] = "changed"
    shared = passage()
    rows = [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base)), (3, " ".join(base)),
        (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "One  TWO!"), (None, " ".join(base)), (None, None),
        (10, " ".join(words(40, 5)) + " " + shared + " " + " ".join(words(40, 6))),
        (11, shared), (12, "x\n" + shared.replace(" ", "\n") + "\ty"),
        (13, " ".join(words(20_000, 7))),
        (14, "wort " * 500), (15, "wort " * 500),
        (16, "漢字 é\u0301 \u00a0 <|endoftext|> 'LL don't <|startoftext|>A Σ. 😀" * 3),
        (17, "y" * 5000), (18, "\x00 \x1c \x85 !"),
    ]
    rows += [(100 + i, " ".join(words(80, 1000 + i))) for i in range(30)]
    return rows


def documents(spark, rows=None, partitions=3):
    """The edge rows with the other columns of documents and some whose names clash with results."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score string, ids int, items int, kept boolean, h int, seed int, node int"
    full = [(i, t, "en", "s", None if t is None else len(t), "x", "y", 1, 2, True, 3, 4, 5) for i, t in (edge_rows() if rows is None else rows)]
    return spark.createDataFrame(full, schema).repartition(partitions)

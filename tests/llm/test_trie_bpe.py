"""op 8: against the tokenizers library."""

from functools import cache

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemart.llm import trie_bpe

from .data import documents, edge_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@cache
def loaded():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def library():
    return loaded()


def test_edge_rows(spark, library):
    out = trie_bpe.encode_decode(documents(spark)).withColumn("array", trie_bpe.id_array())
    assert {"lang", "n_words", "ids", "decoded"} <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    expected = []
    for doc, text in edge_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc, ids, ",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)))
    got = [(r.doc_id, r.array, r.ids, r.decoded) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert trie_bpe.encode_decode(documents(spark, [])).count() == 0


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_any_text(texts):
    lib = loaded()
    got = list(trie_bpe.codec(PATH).run(texts))
    assert [g[1] for g in got] == [",".join(map(str, e.ids)) for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert [g[2] for g in got] == texts


@given(st.text(alphabet="aAeinorst 's", max_size=60))
@settings(max_examples=150, deadline=None)
def test_repeating_letters(text):
    lib = loaded()
    assert next(trie_bpe.codec(PATH).run([text]))[1] == ",".join(map(str, lib.encode(text).ids))


def test_shared_prefixes_and_cache_limits(monkeypatch, library):
    monkeypatch.setattr(trie_bpe, "CACHE", 3)
    own = trie_bpe.TextCodec(PATH)
    for text in ("international internationally internationalize inter", "walk walked walking walker", "x " * 50):
        assert next(own.run([text]))[1] == ",".join(map(str, library.encode(text).ids))

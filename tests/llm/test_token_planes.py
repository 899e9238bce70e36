"""op 1: round trip through the files, against the tokenizers library."""

import zlib
from array import array
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemart.llm import common, planes

from .data import documents, edge_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@cache
def loaded():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def library():
    return loaded()


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_files_hold_the_ids_in_order(spark, library, mode):
    manifest = planes.write(documents(spark), common.scratch(spark, "planes"), mode=mode, block=256)
    got = sorted(map(tuple, planes.read(manifest).collect()), key=lambda r: r[1])
    rows = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at, expected = 0, []
    for doc_id, text in rows:
        ids = array("I", library.encode(text or "", add_special_tokens=False).ids + [2])
        expected.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == expected


@given(st.lists(st.text(alphabet="aA1.'!<|> \n\tÉé\u0301s t,2ı漢\u00a0-", max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_words_encode_as_texts(texts):
    lib, own = loaded(), planes._encoder(PATH)
    assert [array("I", b).tolist() for b in own.run(pa.array(texts, pa.string()))] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=70))
@settings(max_examples=60, deadline=None)
def test_planes_round_trip(ids):
    x = np.array(ids, "<u4")
    for mode in ("byte", "bit"):
        assert (planes.from_planes(planes.to_planes(x, mode), len(x), mode) == x).all()


def test_ranges_are_read_through_the_chunk_index(tmp_path):
    out = planes.Writer(str(tmp_path), "a.planes", block=10)
    data = np.arange(95, dtype="<u4") * 70_001
    out.add(1, data[:33].tobytes())
    out.add(None, b"")
    out.add(2, data[33:].tobytes())
    out.close()
    reader = planes.Reader(out.file.uri)
    assert len(reader.chunks) == 10
    for a, b in ((0, 95), (9, 11), (40, 40), (90, 95)):
        assert (reader.read_range(a, b) == data[a:b]).all()
    assert [(d, at, len(ids)) for d, at, ids in reader.documents()] == [(1, 0, 33), (None, 33, 0), (2, 33, 62)]
    with pytest.raises(ValueError):
        (tmp_path / "cut.planes").write_bytes((tmp_path / "a.planes").read_bytes()[:-9])
        planes.Reader(str(tmp_path / "cut.planes"))


def test_empty_table(spark):
    assert planes.read(planes.write(documents(spark, []), common.scratch(spark, "planes"))).count() == 0

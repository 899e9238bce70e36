"""op 6: archives read back; equal payloads, edge rows, damage."""

import pytest

from tidemart.llm import common, warc


def _table(spark, rows):
    return spark.createDataFrame([(a, u, h, "x", 1) for a, u, h in rows], "page_id long, url string, html string, digest string, record_type int")


ROWS = [(1, "http://a/", "<p>x</p>"), (2, "http://b/\r\nEvil: 1", "<p>x</p>"), (3, None, None), (4, "http://c/", ""), (5, "http://d/", "é\r\n\r\nWARC/1.1\r\n" * 5000), (7, "u", "<p>x</p>"), (7, "u", "<p>x</p>"), (None, "n", "alone"), (None, "n", "<p>x</p>")]


def _expected(rows, least=0):
    out = []
    for a, _, h in rows:
        payload = (h or "").encode()
        top = max((b for b, _, g in rows if (g or "") == (h or "") and b is not None), default=None) if len(payload) >= least else None
        revisit = top is not None and a != top
        out.append((a, len(payload), warc.digest(payload), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 6, 100])
def test_read_back(spark, least):
    out = warc.read(warc.write(_table(spark, ROWS), common.scratch(spark, "warc"), min_bytes=least))
    got = out.collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == _expected(ROWS, least)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert {r.page_id: bytes(r.payload).decode() for r in got if r.page_id == 5} == {5: ROWS[4][2]}


def test_records_are_single_frames_behind_a_dictionary(tmp_path):
    pages = [f"<html><body><p>common words of all pages, number {i}</p></body></html>".encode() for i in range(400)]
    dictionary = warc.train(pages, 4096)
    out = warc.Writer(str(tmp_path), "a.warc.zst", dictionary)
    raw = [warc.record(i, f"http://x/{i}", p, None, False, warc.DATE) for i, p in enumerate(pages)]
    for r in raw:
        out.add(r)
    out.close()
    data = (tmp_path / "a.warc.zst").read_bytes()
    assert data[:4] == bytes.fromhex("5d2a4d18") and int.from_bytes(data[4:8], "little") == len(dictionary) and data[8 : 8 + len(dictionary)] == dictionary
    assert len(data) < sum(map(len, raw)) / 4
    assert [b.partition(b"\r\n\r\n")[2] for _, b in warc.records(out.file.uri)] == pages
    (tmp_path / "cut.warc.zst").write_bytes(data[:-5])
    with pytest.raises(Exception):
        list(warc.records(str(tmp_path / "cut.warc.zst")))


def test_files_are_rotated(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    rows = [(i, f"http://x/{i}", " ".join(str(j * i) for j in range(3000))) for i in range(30)]
    manifest = warc.write(_table(spark, rows).coalesce(1), common.scratch(spark, "warc"))
    sizes = manifest.collect()
    assert len(sizes) >= 3 and sum(r.n_records for r in sizes) == 30 and len({r.uri for r in sizes}) == len(sizes)
    got = warc.read(manifest).collect()
    assert sorted((r.page_id, r.url, bytes(r.payload).decode()) for r in got) == rows


def test_dictionary_is_trained_on_records(spark):
    rows = [(i, f"http://host.example/path/{i}", f"<html><p>page {i * 7919}</p></html>") for i in range(500)]
    payloads, urls = warc.sample(_table(spark, rows))
    assert len(payloads) == len(urls) == 500
    assert b"WARC-Payload-Digest: sha1:" in warc.train(payloads, urls=urls)


def test_empty_tables(spark):
    assert warc.read(warc.write(_table(spark, []), common.scratch(spark, "warc"))).count() == 0
    assert warc.train([]) == b""

"""Token-id files: blocks of ids, transposed to bit or byte planes and compressed.

File layout (all integers little-endian):

    b"TDPLANE1"                                   magic
    planes of block 0, planes of block 1, ...     each a zstandard frame
    footer                                        a zstandard frame (see below)
    footer offset u64, footer length u64, magic

A block holds ``block`` ids (the last one of a file fewer) as unsigned 32-bit
integers.  In byte mode plane p holds byte p of every id, in bit mode bit p of
every id, eight to a byte.  High planes of small ids are constant and cost a
few bytes.  The footer is JSON: mode, block, ids, the chunk index (offset and
plane sizes of every block) and the documents (id, number of ids, in order).

``write`` puts the documents in ascending ``doc_id`` order over files in
ascending name order (a range partitioning; a task writes one file and holds one
block).  A file appears under its final name only when it is whole, and a
repeated task writes the same bytes again.  ``read`` streams a file block by
block; ``read_range`` reads any range of ids through the chunk index.

Texts are encoded by the tokenizers library.  No match of the vocabulary's
pre-tokenizer crosses an ASCII space, tab or line end, nor the border between
an ASCII letter and marks that end a word, so each distinct word between them
is encoded once and kept in a cache of bounded size.

Defined results: null and empty texts have the end id only; documents without
id come first; rows of equal id are ordered by their text; other columns are
not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm import common, textops

MAGIC = b"TDPLANE1"
BLOCK = 1 << 16
END_ID = 2
#: Distinct words whose ids a worker keeps.
CACHE = 300_000
#: New words that are encoded as one text.
JOINED = 1000


class WordEncoder:
    """Ids of texts from ids of distinct words, which the tokenizers library encodes."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        normalizers, split = json.dumps(data.get("normalizer")), json.dumps(data.get("pre_tokenizer"))
        # Word by word is right only for a pre-tokenizer that drops white space
        # and starts afresh behind it; other vocabularies get whole texts.
        self.by_word = '"Removed"' in split and "[\\\\p{L}]+" in split and "Prepend" not in normalizers
        self.folds = '"Lowercase"' in normalizers
        suffix = data["model"].get("end_of_word_suffix")
        self.bare = None
        if self.by_word and self.folds and suffix and '"ByteLevel"' in split:
            self.bare = Tokenizer.from_str(json.dumps(data | {"normalizer": None, "truncation": None, "padding": None}))
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.ends = np.zeros(max(data["model"]["vocab"].values()) + 1, bool)
            self.ends[[i for t, i in data["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words; a word not met for two generations of the cache is forgotten."""
        if len(self.young) > CACHE:
            self.young, self.old = {}, self.young
        young, old, new = self.young, self.old.get, []
        for w in words:
            if w not in young:
                ids = old(w)
                if ids is None:
                    new.append(w)
                else:
                    young[w] = ids
        if self.bare is not None:
            # words of Latin letters only: lower case is all that normalises them, nothing
            # splits them, and the suffix marks their ends
            plain = list(filter(_LATIN, new))
            texts = [" ".join(plain[i : i + JOINED]).lower() for i in range(0, len(plain), JOINED)]
            for n, e in enumerate(self.bare.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(e.ids, "<u4")
                raw, begin = ids.tobytes(), 0
                for w, end in zip(plain[n * JOINED : (n + 1) * JOINED], (4 * np.flatnonzero(self.ends[ids]) + 4).tolist(), strict=True):
                    young[w] = raw[begin:end]
                    begin = end
            new = [w for w in new if w not in young]
        for i in range(0, len(new), 10 * JOINED):
            part = new[i : i + 10 * JOINED]
            for w, e in zip(part, self.lib.encode_batch_fast(part, add_special_tokens=False), strict=True):
                young[w] = array("I", e.ids).tobytes()
        return list(map(young.__getitem__, words))

    def run(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text as unsigned 32-bit integers."""
        if not self.by_word:
            for e in self.lib.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False):
                yield array("I", e.ids).tobytes()
            return
        data, offsets = textops.buffers(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts)
        for i, j in textops.slices(offsets, SLICE):
            o = offsets[i : j + 1]
            yield from self._encode(data[o[0] : o[-1]], o - o[0])

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        starts, ends, first = textops.scan(data, offsets, _WORD)
        # Marks behind an ASCII letter or digit are a match of their own: cut them off.
        cut = ends.copy()
        while True:
            more = np.flatnonzero(_MARK[data[np.maximum(cut - 1, 0)]] & (cut - 1 > starts))
            if not len(more):
                break
            cut[more] -= 1
        cut = np.where((cut < ends) & _PLAIN[data[np.maximum(cut - 1, 0)]], cut, ends)
        tails = np.flatnonzero(cut < ends)
        order = np.argsort(np.concatenate([starts, cut[tails]]), kind="stable")
        at, to = np.concatenate([starts, cut[tails]])[order], np.concatenate([cut, ends[tails]])[order]
        first = np.searchsorted(at, offsets)
        h = textops.hashes(data, at, to)
        if self.folds:  # single ASCII letters fold alike; "<" may begin a special token
            odd = np.concatenate([[0], np.cumsum(_ODD[data])])
            low = odd[to] == odd[at]
            h = np.where(low, textops.hashes(data, at, to, textops.FOLD) ^ np.uint64(1), h)
        else:
            low = np.zeros(len(at), bool)
        _, one, which = np.unique(h, return_index=True, return_inverse=True)
        raw = data.tobytes()
        words = [(raw[a:b].lower() if f else raw[a:b]).decode() for a, b, f in zip(at[one].tolist(), to[one].tolist(), low[one].tolist(), strict=True)]
        known = self._known(words)
        sizes = np.array([len(x) // 4 for x in known], np.int64)
        ids, places = np.frombuffer(b"".join(known), "<u4"), np.cumsum(sizes) - sizes
        n = sizes[which]
        upto = np.concatenate([[0], np.cumsum(n)])
        flat = ids[np.arange(upto[-1]) + np.repeat(places[which] - upto[:-1], n)] if len(n) else ids
        bounds = upto[first]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield flat[a:b].tobytes()


SLICE = 4 << 20
#: Letters that have one lower-case letter and no other normal form.
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
_WORD = np.ones(256, bool)
_WORD[[0x20, 0x0A, 0x09, 0x0D]] = False
#: ASCII marks that are no letter, digit, white space, control or apostrophe, and cannot begin "<|".
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in '!"#$%&()*+,-./:;=>?@[]^_`{}~']] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_ODD = np.zeros(256, bool)
_ODD[[0x3C, *range(0x80, 0x100)]] = True
_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def to_planes(ids: np.ndarray, mode: str) -> list[bytes]:
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if mode == "byte":
        return [np.ascontiguousarray(raw[:, p]).tobytes() for p in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, p], bitorder="little").tobytes() for p in range(32)]


def from_planes(planes: list[bytes], n: int, mode: str) -> np.ndarray:
    if mode == "byte":
        return np.stack([np.frombuffer(p, np.uint8, n) for p in planes], axis=1).reshape(-1).view("<u4")
    bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    """Writes one file; holds one block of ids."""

    def __init__(self, folder: str, name: str, mode: str = "byte", block: int = BLOCK, level: int = 3) -> None:
        if mode not in ("byte", "bit"):
            raise ValueError(f"mode is byte or bit, not {mode!r}")
        self.file, self.mode, self.block = common.TaskFile(folder, name), mode, block
        self.packer = zstandard.ZstdCompressor(level=level)
        self.held, self.index, self.docs, self.counts, self.ids = bytearray(), [], [], [], 0
        self.file.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.held += ids
        size = 4 * self.block
        whole = len(self.held) // size * size
        for i in range(0, whole, size):
            self._flush(bytes(self.held[i : i + size]))
        del self.held[:whole]

    def _flush(self, raw: bytes) -> None:
        packed = [self.packer.compress(p) for p in to_planes(np.frombuffer(raw, "<u4"), self.mode)]
        self.index.append([self.file.size, *map(len, packed)])
        self.file.write(b"".join(packed))
        self.ids += len(raw) // 4

    def close(self) -> None:
        if self.held:
            self._flush(bytes(self.held))
        footer = {"mode": self.mode, "block": self.block, "ids": self.ids, "chunks": self.index, "docs": self.docs, "counts": self.counts}
        packed, at = self.packer.compress(json.dumps(footer, separators=(",", ":")).encode()), self.file.size
        self.file.write(packed + at.to_bytes(8, "little") + len(packed).to_bytes(8, "little") + MAGIC)
        self.file.close()


class Reader:
    """Reads one file through its footer."""

    def __init__(self, uri: str) -> None:
        self.file = common.open_input(uri)
        self.unpack = zstandard.ZstdDecompressor()
        end = self.file.size()
        tail = self.file.read_at(24, end - 24)
        if tail[16:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{uri} is no token-id file, or not whole")
        footer = self.file.read_at(int.from_bytes(tail[8:16], "little"), int.from_bytes(tail[:8], "little"))
        for key, value in json.loads(self.unpack.decompress(footer)).items():
            setattr(self, key, value)

    def chunk(self, number: int) -> np.ndarray:
        at, *sizes = self.chunks[number]
        raw = self.file.read_at(sum(sizes), at)
        planes, pos = [], 0
        for size in sizes:
            planes.append(self.unpack.decompress(raw[pos : pos + size]))
            pos += size
        return from_planes(planes, min(self.block, self.ids - number * self.block), self.mode)

    def read_range(self, a: int, b: int) -> np.ndarray:
        """Ids a to b of the file, read from the chunks that hold them."""
        if a >= b:
            return np.zeros(0, "<u4")
        first = a // self.block
        own = np.concatenate([self.chunk(n) for n in range(first, (b - 1) // self.block + 1)])
        return own[a - first * self.block : b - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, place of the first id in the file, ids) of each document; holds a block and a document."""
        at, held, have = 0, np.zeros(0, "<u4"), 0
        for doc, n in zip(self.docs, self.counts, strict=True):
            parts, need = [held], n - len(held)
            while need > 0:
                parts.append(self.chunk(have))
                have += 1
                need -= len(parts[-1])
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc, at, held[:n]
            held, at = held[n:], at + n


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about SLICE bytes, so that fewer words repeat between them."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= SLICE:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, mode: str = "byte", block: int = BLOCK, end_id: int = END_ID, text_col: str = "text") -> DataFrame:
    """Encode and write all documents; the manifest: file, uri, n_docs, n_ids, start (ids of all files before)."""
    spark = docs.sparkSession
    common.prepare(spark)
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, out = TaskContext.get().partitionId(), None
        for b in _gathered(batches):
            out = out or Writer(folder, f"ids-{number:06d}.planes", mode, block)
            for doc, ids in zip(b.column(0).to_pylist(), _encoder(path).run(b.column(1)), strict=True):
                out.add(doc, ids + end)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([out.file.uri]), pa.array([len(out.docs)]), pa.array([out.ids])], ["file", "uri", "n_docs", "n_ids"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    dealt = read.repartitionByRange(common.parts(spark), "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = common.stored(dealt.mapInArrow(run, "file long, uri string, n_docs long, n_ids long"), "planes-manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    spark = manifest.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for uri, start in (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
            rows = [(doc, start + at, len(ids), zlib.crc32(ids.tobytes())) for doc, at, ids in Reader(uri).documents()]
            yield from common.emit(rows, schema)

    each = manifest.select("uri", "start").repartition(common.parts(spark), "uri")
    return each.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id, ids (array<long>) of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
        for uri in (u for b in batches for u in b.column(0).to_pylist()):
            for doc, _, ids in Reader(uri).documents():
                yield from common.emit([(doc, ids.astype(np.int64))], schema)

    return manifest.select("uri").mapInArrow(run, "doc_id long, ids array<long>")

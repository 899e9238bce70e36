"""Byte-level BPE by a prefix-sharing trie of distinct words.

For every prefix of a word there is exactly one token that can end the
prefix's encoding (its *last token*): the token ``t`` with which the prefix
ends and for which the encoding of what stands before ``t`` ends in a token
that BPE keeps apart from ``t``.  So the state of a trie node is one token,
found from the states of the nodes above it.  The distinct words of a batch
are walked in sorted order, which is a depth-first walk of their trie: states
of a shared prefix are computed once and kept on the path's stack.

The tokens that can end a prefix are read off an automaton over the beginnings
of all tokens, whose steps are filled in as words need them.  Words repeat, so
each distinct one is encoded and decoded once and kept in a cache of bounded
size.

Defined results: a null or empty text has no ids and decodes to ""; a special
token written in a text gets its id, as the tokenizers library does; other
columns pass through unchanged, but the result's own columns (``n_tokens``,
``ids``, ``decoded``) replace columns of the same name.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common

#: The pre-tokenizer pattern of byte-level BPE, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries kept by each cache of a worker.
CACHE = 400_000


def byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable ones stand for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TrieEncoder:
    """Encoder of words (bytes) to token ids by last-token states."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letter = byte_letters()
        specials = {x["content"]: x["id"] for x in data["added_tokens"]}
        named = {s: i for s, i in data["model"]["vocab"].items() if s not in specials}
        self.bytes_of = {i: bytes(map(letter.__getitem__, s)) for s, i in named.items()}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> rank, left, right
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(data["model"]["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b, t = named[left], named[right], named[left + right]
            if t in self.parts:
                raise ValueError(f"two merges make the token {t}")
            self.parts[t] = rank, a, b
            self.merged[a, b] = rank, t
        self.specials = {s: i for s, i in specials.items()}
        self.apart: dict[int, bool] = {}
        reachable: dict[int, bool] = {}
        for t in sorted(self.bytes_of, key=lambda t: len(self.bytes_of[t])):
            p = self.parts.get(t)
            reachable[t] = len(self.bytes_of[t]) == 1 if p is None else reachable[p[1]] and reachable[p[2]] and self._stays(p[1], p[2], p[0])
        self.tokens = {self.bytes_of[t]: t for t, ok in reachable.items() if ok}
        self.lengths = {t: len(b) for b, t in self.tokens.items()}
        self.begins = sorted({b[:n] for b in self.tokens for n in range(len(b) + 1)}, key=len)  # state 0 is b""
        self.number = {s: n for n, s in enumerate(self.begins)}
        self.steps: dict[int, int] = {}
        self.ends: dict[int, list[tuple[int, int]]] = {}

    def _stays(self, a: int, b: int, limit: float) -> bool:
        """Does no merge across the border of a and b come before rank ``limit``?

        Undoes the merges of both sides from the last to the first.  A pair of
        neighbours at the border lives until the merge that is undone next; of
        two merges of equal rank the left one comes first.
        """
        pair, parts = self.merged.get, self.parts.get
        left, right = parts(a), parts(b)
        while True:
            across = pair((a, b))
            if across is not None and across[0] < limit:
                return False
            if left is not None and (right is None or left[0] > right[0]):
                limit, a = left[0], left[2]
                left = parts(a)
            elif right is not None:
                limit, b = right[0] + 1, right[1]
                right = parts(b)
            else:
                return True

    def _step(self, state: int, byte: int) -> int:
        """The longest end of state + byte that begins a token; 0: none."""
        s = self.begins[state] + bytes((byte,))
        while s not in self.number:
            s = s[1:]
        to = self.steps[state << 8 | byte] = self.number[s]
        if to not in self.ends:  # the tokens with which it ends, longest first
            self.ends[to] = [(len(s) - j, self.tokens[s[j:]]) for j in range(len(s)) if s[j:] in self.tokens]
        return to

    def encode_words(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct words: one depth-first walk of their trie."""
        steps, ends, lengths, apart = self.steps, self.ends, self.lengths, self.apart
        if len(apart) > 4 * CACHE:
            apart.clear()
        out: dict[bytes, list[int]] = {}
        last: list[int] = []  # last tokens on the path to the current node
        states: list[int] = [0]  # what of the path may begin a token
        before = b""
        for word in sorted(words):
            n, i = len(word), 0
            top = min(len(before), n)
            while i < top and before[i] == word[i]:
                i += 1
            del last[i:], states[i + 1 :]
            before, state = word, states[-1]
            for end in range(i, n):
                byte = word[end]
                state = steps.get(state << 8 | byte)
                if state is None:
                    state = self._step(states[-1], byte)
                states.append(state)
                for size, t in ends[state]:
                    if size > end:
                        break
                    key = last[end - size] << 32 | t
                    ok = apart.get(key)
                    if ok is None:
                        ok = apart[key] = self._stays(last[end - size], t, float("inf"))
                    if ok:
                        break
                last.append(t)
            ids = []
            while n:
                t = last[n - 1]
                ids.append(t)
                n -= lengths[t]
            ids.reverse()
            out[word] = ids
        return out


class TextCodec:
    """Encodes and decodes texts; words are cached up to a bound."""

    #: What PATTERN means for texts of ASCII only.
    ascii_pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)

    def __init__(self, path: str) -> None:
        self.trie = TrieEncoder(path)
        self.pattern = regex.compile(PATTERN)
        self.special = re.compile("(" + "|".join(map(re.escape, self.trie.specials)) + ")") if self.trie.specials else None
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, bytes] = {}

    def _cut(self, text: str) -> list[str]:
        return (self.ascii_pattern if text.isascii() else self.pattern).findall(text)

    def _learn(self, words: set[str]) -> None:
        """Encode new words together; what they decode to is put together from the ids."""
        bytes_of = self.trie.bytes_of
        for word, ids in self.trie.encode_words([w.encode() for w in words]).items():
            w = word.decode()
            self.ids[w] = b"%d," * len(ids) % tuple(ids)
            self.decoded[w] = b"".join([bytes_of[i] for i in ids])

    def run(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, decimal ids joined by commas, decoded text) of each text."""
        if len(self.ids) > CACHE:
            self.ids.clear()
            self.decoded.clear()
        specials = self.trie.specials
        for s, i in specials.items():
            self.ids[s], self.decoded[s] = b"%d," % i, s.encode()
        cut: list[list[str]] = []
        for text in texts:
            if self.special is not None and self.special.search(text):
                cut.append([p for s in self.special.split(text) for p in ([s] if s in specials else self._cut(s))])
            else:
                cut.append(self._cut(text))
        if new := set().union(*cut).difference(self.ids):
            self._learn(new)
        ids_of, decoded_of = self.ids.__getitem__, self.decoded.__getitem__
        for own in cut:
            ids = b"".join(map(ids_of, own))
            yield ids.count(b","), ids[:-1].decode(), b"".join(map(decoded_of, own)).decode("utf-8", "replace")


_CODECS: dict[str, TextCodec] = {}


def codec(path: str) -> TextCodec:
    """One codec for each vocabulary and worker process."""
    if path not in _CODECS:
        _CODECS[path] = TextCodec(path)
    return _CODECS[path]


def encode_decode(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """The documents with n_tokens, ids (decimal, joined by commas) and decoded."""
    common.prepare(docs.sparkSession)
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    base = docs.drop("n_tokens", "ids", "decoded")
    out = common.extended(base, n_tokens="long", ids="string", decoded="string")
    names = [f.name for f in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            texts = [t or "" for t in b.column(b.num_columns - 1).to_pylist()]
            n, ids, decoded = zip(*own.run(texts), strict=True) if texts else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=names)

    return base.select("*", F.col(text_col).alias("__td_text")).mapInArrow(run, out)


def id_array(ids: str = "ids"):
    """The ids column as array<int>."""
    return F.when(F.col(ids) == "", F.array().cast("array<int>")).otherwise(F.split(ids, ",").cast("array<int>"))

"""Vectorised word scanning and hashing over Arrow string buffers.

Words are runs of bytes of a class: all classes used here are closed under
UTF-8 (every byte from 0x80 is either always or never part of a word), so
scanning bytes gives the same words as scanning characters.  Hashes are
64-bit polynomial sums, taken from prefix sums modulo 2**64 and mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(0x71DE)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, so invertible modulo 2**64
#: Bytes hashed at once; bounds the 8-byte temporaries, not the text.
BLOCK = 1 << 19

#: Words of everything but space, tab, line feed, vertical tab, form feed, CR.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of 0-9, a-z and all characters beyond ASCII, A-Z lower-cased first.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_TABLES: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    size = 1 << max(12, (n - 1).bit_length())
    for (b, s), t in _TABLES.items():
        if b == base and s >= n:
            return t[:n]
    t = np.full(size, base, np.uint64)
    t[0] = 1
    np.cumprod(t, out=t)
    for key in [k for k in _TABLES if k[0] == base]:
        del _TABLES[key]
    if size <= 4 * BLOCK:  # larger ones are for single very long words or texts
        _TABLES[base, size] = t
    return t[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the n+1 offsets of the texts; null counts as empty."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def scan(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's first word (n+1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    m = word[data]
    edge = np.empty_like(m)
    edge[0] = True
    np.logical_not(m[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < len(m)]] = True
    starts = np.flatnonzero(m & edge)
    edge[-1] = True
    np.logical_not(m[1:], out=edge[:-1])
    edge[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(m & edge) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word."""
    out, table, i = np.empty(len(starts), np.uint64), _BYTE if fold is None else _BYTE[fold], 0
    inverse = pow(_P, -1, 2**64)
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * powers(_P, b - a), out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * powers(inverse, b - a + 1)[s] + (e - s).astype(np.uint64) * np.uint64(_Q))
        i = j
    return out


def prefix(h: np.ndarray, base: int = _Q) -> np.ndarray:
    """Prefix sums for ``spans``."""
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(base, max(1, len(h)))[: len(h)], out=sums[1:])
    return sums


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _Q) -> np.ndarray:
    """A hash of each word sequence [start, end), given ``prefix`` of the words' hashes."""
    back = powers(pow(base, -1, 2**64), max(1, len(sums)))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * np.uint64(_P))


def inside(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of k words that lie in one text, and the text's number."""
    n = np.maximum(np.diff(first) - k + 1, 0)
    text = np.repeat(np.arange(len(n)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:-1], n)
    return at, text


def slices(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Runs of whole texts of about ``limit`` bytes; a longer text is a run of its own."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        out.append((i, j))
        i = j
    return out

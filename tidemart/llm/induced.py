"""External induced sorting of suffixes, with common-prefix values.

``sorted_suffixes`` orders the suffixes of a text of integer symbols by their
first ``cap`` symbols and gives each one the number of symbols, ``cap`` at most,
that it shares with its neighbour.  The text ends with a 0 that occurs nowhere
else.  A suffix is of type S if it is smaller than the one that starts a symbol
later, else of type L; an S* suffix is one of type S behind one of type L.

1. The substrings between S* positions are sorted and named.  If names repeat,
   the suffixes of the string of names are sorted by *recursion* (in memory, by
   doubling, once that string is short), which orders the S* suffixes.
2. From them the L suffixes are induced in ascending order, then from those the
   S suffixes in descending order: a suffix taken from the queue brings forth
   the one that starts a symbol earlier.

The *priority queue* holds (position, common prefix) tuples under their first
symbol.  Within a symbol tuples leave in the order they came, so a symbol is a
queue, and neighbouring rare symbols share a bin that is sorted when its turn
comes.  Tuples are taken many at once: as many as cannot be overtaken by what
they bring forth.  Two neighbours under one symbol share one symbol more than
the least value between the two that brought them forth; that range minimum
comes from a sparse table inside a step and from a stack of minima across
steps.  Where the two types meet under a symbol, the value is compared anew.

Bins, sorted L suffixes and results live in ``Spill``: whatever exceeds its
memory is written to run files in the shared scratch folder and read once, in
order.  Held in memory are the text, for each position the symbol it brings forth,
two numbers for each S* position and, for each symbol, two numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np

from tidemart.llm import common

#: Tuples of a bin of rare symbols, tuples of a step, names sorted in memory (two ranks and a position fit 64 bits).
BIN, STEP, SHORT = 1 << 16, 1 << 18, 1 << 21
_NONE = np.iinfo(np.int16).max
Block = tuple[np.ndarray, np.ndarray]


class Spill:
    """Blocks of (position, value) tuples; in memory up to ``memory`` bytes in all, else in run files."""

    def __init__(self, folder: str, memory: int) -> None:
        self.folder, self.memory, self.held, self.runs = folder, memory, 0, 0
        self.lists: list[Blocks] = []

    def add(self, size: int) -> None:
        self.held += size
        if self.held > self.memory:
            fs, base = common.filesystem(self.folder)
            fs.create_dir(base, recursive=True)
            path, at = f"{base}/run-{uuid.uuid4().hex}", 0
            with fs.open_output_stream(path) as out:
                for x in self.lists:
                    at = x.to_disk(out, path, at)
            self.held, self.runs = 0, self.runs + 1

    def read(self, path: str, at: int, n: int) -> Block:
        fs, _ = common.filesystem(self.folder)
        with fs.open_input_file(path) as f:
            f.seek(at)
            data = f.read(n * 10)
        return np.frombuffer(data, np.int64, n), np.frombuffer(data, np.int16, n, n * 8)

    def close(self) -> None:
        if self.runs:
            fs, base = common.filesystem(self.folder)
            fs.delete_dir(base)


class Blocks:
    """A sequence of blocks under a ``Spill``."""

    def __init__(self, spill: Spill) -> None:
        self.spill, self.blocks = spill, []
        spill.lists.append(self)

    def append(self, pos: np.ndarray, value: np.ndarray) -> None:
        if len(pos):
            self.blocks.append((pos.astype(np.int64), value.astype(np.int16)))
            self.spill.add(len(pos) * 10)

    def to_disk(self, out, path: str, at: int) -> int:
        merged: list = []
        held = [b for b in self.blocks if len(b) == 2]
        for i in range(0, len(held), 1000):  # neighbouring small blocks become one
            part = held[i : i + 1000]
            pos, value = np.concatenate([p for p, _ in part]), np.concatenate([v for _, v in part])
            for j in range(0, len(pos), STEP):
                p, v = pos[j : j + STEP], value[j : j + STEP]
                out.write(p.tobytes())
                out.write(v.tobytes())
                merged.append((path, at, len(p)))
                at += len(p) * 10
        self.blocks = [b for b in self.blocks if len(b) == 3] + merged
        return at

    def _load(self, block) -> Block:
        if len(block) == 3:
            return self.spill.read(*block)
        self.spill.held -= len(block[0]) * 10
        return block

    def __bool__(self) -> bool:
        return bool(self.blocks)

    def take(self) -> Block:
        """The oldest blocks, about STEP tuples."""
        got, n = [], 0
        for block in self.blocks:
            n += block[2] if len(block) == 3 else len(block[0])
            if got and n > STEP:
                break
            got.append(block)
        del self.blocks[: len(got)]
        loaded = [self._load(b) for b in got]
        return np.concatenate([p for p, _ in loaded]), np.concatenate([v for _, v in loaded])

    def drain(self) -> Iterator[Block]:
        while self.blocks:
            yield self.take()
        self.spill.lists.remove(self)

    def drain_reversed(self) -> Iterator[Block]:
        """From the end; a value, which belongs to a tuple and its predecessor, goes to the other of the two."""
        carry = 0
        while self.blocks:
            pos, value = self._load(self.blocks.pop())
            yield pos[::-1], np.concatenate([[carry], value[:0:-1]]).astype(np.int16)
            carry = value[0]
        self.spill.lists.remove(self)


def _least(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of each range a .. b (b included, a <= b) of x."""
    level = (np.frexp((b - a + 1).astype(np.float64))[1] - 1).astype(np.int64)
    table = np.empty((int(level.max(initial=0)) + 1, len(x)), x.dtype)
    table[0] = x
    for k in range(1, len(table)):
        half, n = 1 << (k - 1), len(x) - (1 << k) + 1
        np.minimum(table[k - 1, :n], table[k - 1, half : half + n], out=table[k, :n])
    row = level * len(x)
    flat = table.ravel()
    return np.minimum(flat[row + a], flat[row + b + 1 - (np.int64(1) << level)])


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Symbols, ``cap`` at most, that the suffixes a and b share."""
    out, alive, n = np.full(len(a), cap, np.int64), np.arange(len(a)), 0
    while n < cap and len(alive):
        same = text[np.minimum(a[alive] + n, len(text) - 1)] == text[np.minimum(b[alive] + n, len(text) - 1)]
        out[alive[~same]] = n
        alive, n = alive[same], n + 1
    return out


def _border(text: np.ndarray, a: int, b: int, cap: int) -> int:
    x, y = text[a : a + cap], text[b : b + cap]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


class _Minima:
    """Common-prefix values of what steps bring forth: minima of the values passed since a symbol's last one."""

    def __init__(self, symbols: int, cap: int) -> None:
        self.cap, self.step = cap, 0
        self.last, self.rest = np.full(symbols, -1, np.int64), np.zeros(symbols, np.int16)
        self.at, self.low, self.n = np.zeros(64, np.int64), np.zeros(64, np.int16), 0  # rising minima of later steps

    def next(self, value: np.ndarray, source: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sources and values of a step's offspring by symbol, then source; where each symbol starts, and the symbols.

        value: of all the step's tuples; source: ascending numbers of those that bring forth."""
        order = np.argsort(symbol, kind="stable")
        s, g = symbol[order], source[order]
        if len(s):
            f = np.append(0, np.flatnonzero(s[1:] != s[:-1]) + 1)
            new = np.zeros(len(s), np.int16)
            new[1:] = _least(value, np.minimum(g[:-1] + 1, g[1:]), g[1:])  # those of a symbol's first one are set below
            ahead = np.minimum.accumulate(value)
            since = self.last[s[f]]
            low = np.minimum(self.rest[s[f]], ahead[g[f]])
            k = np.searchsorted(self.at[: self.n], since, "right")
            between = k < self.n
            low[between] = np.minimum(low[between], self.low[: self.n][k[between]])
            low[since < 0] = -1  # a symbol's first one shares nothing with what is before it
            new[f] = low
            new = np.minimum(new + 1, self.cap).astype(np.int16)
            behind = np.append(np.minimum.accumulate(value[::-1])[::-1], _NONE).astype(np.int16)
            ends = np.append(f[1:], len(s)) - 1
            self.last[s[ends]], self.rest[s[ends]] = self.step, behind[g[ends] + 1]
        else:
            f, new = np.zeros(0, np.int64), np.zeros(0, np.int16)
        low = int(value.min()) if len(value) else _NONE
        while self.n and self.low[self.n - 1] >= low:
            self.n -= 1
        if self.n == len(self.at):
            self.at, self.low = np.resize(self.at, 2 * self.n), np.resize(self.low, 2 * self.n)
        self.at[self.n], self.low[self.n] = self.step, low
        self.n, self.step = self.n + 1, self.step + 1
        return g, new, f, s[f]


class _Seeds:
    """Tuples in ascending symbols, read as far as a bin needs them."""

    def __init__(self, blocks: Iterable[Block], symbol: np.ndarray) -> None:
        self.blocks, self.symbol, self.block = iter(blocks), symbol, None

    def upto(self, last: int) -> Iterator[Block]:
        """The tuples left with symbols of at most ``last``."""
        while True:
            if self.block is None:
                if (block := next(self.blocks, None)) is None:
                    return
                self.block = *block, self.symbol[block[0]]
            pos, value, symbol = self.block
            n = int(np.searchsorted(symbol, last, "right"))
            if n:
                yield pos[:n], value[:n]
            if n < len(pos):
                self.block = pos[n:], value[n:], symbol[n:]
                return
            self.block = None


def _induce(text: np.ndarray, symbol: np.ndarray, mine: np.ndarray, seeds: Iterable[Block], cap: int, spill: Spill) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks (position, value, is a seed) of all suffixes in the order of ``symbol``: under each symbol the
    suffixes of type ``mine``, which are brought forth, then the seeds."""
    n_symbols = int(symbol.max()) + 1
    symbol = symbol.astype(np.min_scalar_type(n_symbols))  # narrow numbers are sorted by radix
    key_type = np.min_scalar_type(2 * n_symbols)
    counts = np.bincount(symbol[mine], minlength=n_symbols)
    heavy = counts > BIN
    new = np.ones(n_symbols, bool)
    quota = np.cumsum(np.where(heavy, 0, counts)) // BIN
    new[1:] = heavy[1:] | heavy[:-1] | (quota[1:] != quota[:-1])
    bin_of = np.cumsum(new) - 1
    first = np.append(np.flatnonzero(new), n_symbols)
    brings = np.full(len(text), n_symbols, symbol.dtype)  # the symbol that a position brings forth, if any
    np.copyto(brings[1:], symbol[:-1], where=mine[:-1])
    bins = [Blocks(spill) for _ in range(len(first) - 1)]
    waiting, minima = _Seeds(seeds, symbol), _Minima(n_symbols, cap)
    last_own = {}  # symbol -> the last suffix of type ``mine``, for the border to the seeds

    def step(pos: np.ndarray, value: np.ndarray, here: int) -> Block:
        """Bring forth; returns what belongs to the bin itself."""
        brought = brings[pos]
        source = np.flatnonzero(brought != n_symbols)
        source, more, heads, symbols = minima.next(value, source, brought[source])
        before = pos[source] - 1
        to = bin_of[symbols]
        some = np.flatnonzero(np.diff(to, prepend=-1))
        own = before[:0], more[:0]
        for k, a, b in zip(to[some].tolist(), heads[some].tolist(), np.append(heads[some[1:]], len(before)).tolist(), strict=False):
            if k == here:
                own = before[a:b], more[a:b]
            else:
                bins[k].append(before[a:b], more[a:b])
        return own

    def border(pos: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Values of seeds, with those of each symbol's first one set."""
        s = symbol[pos]
        value = value.copy()
        for i in np.flatnonzero(np.diff(s, prepend=-1)).tolist():
            if (k := int(s[i])) not in bordered:
                bordered.add(k)
                value[i] = _border(text, last_own[k], int(pos[i]), cap) if k in last_own else 0
        return value

    def note(pos: np.ndarray) -> None:
        s = symbol[pos]
        for i in (np.append(np.flatnonzero(s[1:] != s[:-1]), len(s) - 1)).tolist():
            last_own[int(s[i])] = int(pos[i])

    for here, (low, high) in enumerate(zip(first[:-1].tolist(), (first[1:] - 1).tolist(), strict=True)):
        bordered: set[int] = set()
        last_own.clear()
        queue = bins[here]
        if low == high:
            while queue:
                pos, value = queue.take()
                queue_more = step(pos, value, here)
                queue.append(*queue_more)
                last_own[low] = int(pos[-1])
                yield pos, value, np.zeros(len(pos), bool)
            for pos, value in waiting.upto(high):
                value = border(pos, value)
                step(pos, value, here)  # a seed brings forth other symbols only
                yield pos, value, np.ones(len(pos), bool)
            spill.lists.remove(queue)
            continue
        # rare symbols: all that waits, in order; then what cannot be overtaken
        pos, value = (np.concatenate(x) for x in zip(*queue.drain(), (np.zeros(0, np.int64), np.zeros(0, np.int16)), strict=True))
        seed = np.zeros(len(pos), bool)
        for p, v in waiting.upto(high):
            pos, value, seed = np.concatenate([pos, p]), np.concatenate([value, v]), np.concatenate([seed, np.ones(len(p), bool)])
        while len(pos):
            key = symbol[pos].astype(key_type)
            key *= 2
            key += seed
            order = np.argsort(key, kind="stable")
            pos, value, seed, key = pos[order], value[order], seed[order], key[order]
            brought = brings[pos]
            child = np.where((brought >= low) & (brought <= high), 2 * brought.astype(key_type), np.iinfo(key_type).max)
            ok = np.append(True, key[1:] <= np.minimum.accumulate(child)[:-1])
            n = len(ok) if ok.all() else int(np.argmin(ok))
            n = min(n, STEP)
            p, v, d = pos[:n], value[:n], seed[:n]
            # a stretch of seeds may start under a symbol whose own suffixes are in the same step
            v = v.copy()
            if (~d).any():
                note(p[~d])
            if d.any():
                v[d] = border(p[d], v[d])
            more = step(p, v, here)
            yield p, v, d
            pos, value = np.concatenate([pos[n:], more[0]]), np.concatenate([value[n:], more[1]])
            seed = np.concatenate([seed[n:], np.zeros(len(more[0]), bool)])


def _finer(rank: np.ndarray, alive: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks by twice as many names, from those by ``h``; and the positions that still share theirs.

    alive: the positions that share a rank by ``h`` names, no others are sorted.  The rank of the end is -1."""
    n = len(rank) - 1
    behind = (rank[np.minimum(alive + h, n)] + 1).astype(np.uint64)
    bits, mask = np.uint64((n - 1).bit_length()), np.uint64((1 << (n - 1).bit_length()) - 1)
    key = (rank[alive].astype(np.uint64) << np.uint64(n.bit_length()) | behind) << bits | alive.astype(np.uint64)
    key.sort()
    at, key = (key & mask).astype(np.int64), key >> bits
    old = rank[at]
    group, part = (np.append(True, x[1:] != x[:-1]) for x in (old, key))
    tops, heads = np.flatnonzero(group), np.flatnonzero(part)
    rank = rank.copy()
    rank[at] = old + np.repeat(heads, np.diff(np.append(heads, len(at)))) - np.repeat(tops, np.diff(np.append(tops, len(at))))
    return rank, at[~(part & np.append(part[1:], True))]


def _doubled(names: np.ndarray, cap: int) -> Block:
    """Suffix order by the first ``cap`` of the names 0, 1, ... and values, in memory.

    A rank is the number of suffixes that are smaller, as far as compared."""
    n, counts = len(names), np.bincount(names)
    ranks = [np.append((np.cumsum(counts) - counts)[names], -1).astype(np.int32)]
    alive, h = np.flatnonzero(counts[names] > 1), 1
    while h < cap and len(alive):
        rank, alive = _finer(ranks[-1], alive, h)
        ranks.append(rank)
        h *= 2
    bits = np.uint64((n - 1).bit_length())
    order = ranks[-1][:-1].astype(np.uint64) << bits | np.arange(n, dtype=np.uint64)
    order.sort()
    order = (order & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        same = np.flatnonzero(ranks[k][a] == ranks[k][b])
        shared[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, np.minimum(np.append(0, shared), cap).astype(np.int16)


def _named(text: np.ndarray, small: np.ndarray, star: np.ndarray) -> np.ndarray:
    """Names, in lexical order, of the substrings from each S* position to the next one, by symbols and types."""
    bits = int(2 * int(text.max()) + 1).bit_length()
    per = max(1, 63 // bits)
    end = np.append(star[1:], star[-1])
    both = text.astype(np.min_scalar_type(2 * int(text.max()) + 1))
    both *= 2
    both += small
    order_at = np.zeros(len(star), np.int64)  # number of smaller substrings, as far as compared
    alive, off = np.arange(len(star)), 0
    while len(alive):
        key = np.zeros(len(alive), np.int64)
        for j in range(per):
            at = star[alive] + off + j
            inside = at <= end[alive]
            key = (key << bits) | np.where(inside, both[np.minimum(at, len(text) - 1)], 0)
        order = np.lexsort((key, order_at[alive])) if off else np.argsort(key)
        k, o = key[order], order_at[alive][order]
        group = np.ones(len(order), bool)
        group[1:] = o[1:] != o[:-1]
        new = group.copy()
        new[1:] |= k[1:] != k[:-1]
        start = np.flatnonzero(new)
        in_group = np.maximum.accumulate(np.where(group, np.arange(len(order)), 0))
        size = np.diff(np.append(start, len(order)))
        order_at[alive[order]] = o + np.repeat(start, size) - in_group
        off += per
        more = order[np.repeat(size > 1, size)]
        alive = np.sort(alive[more])
        alive = alive[star[alive] + off <= end[alive]]
    used = np.zeros(len(star), bool)
    used[order_at] = True
    return (np.cumsum(used) - 1)[order_at]


def _types(text: np.ndarray) -> np.ndarray:
    """True for suffixes of type S."""
    n = len(text)
    differs = np.append(text[1:] != text[:-1], False)
    at = np.minimum.accumulate(np.where(differs, np.arange(n), n - 1)[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = text[at[:-1]] < text[at[:-1] + 1]
    return small


def sorted_suffixes(text: np.ndarray, cap: int, spill: Spill) -> Iterator[Block]:
    """Blocks (position, value) of all suffixes but the last, in *descending* order; a value belongs to a suffix
    and the one before it in this order."""
    small = _types(text)
    star = np.flatnonzero(small & np.append(False, ~small[:-1]))
    names = _named(text, small, star)
    cap_names = cap // 2 + 2  # a name spans two symbols or more
    if int(names.max()) + 1 == len(names):
        order = np.argsort(names)
        blocks: Iterable[Block] = [(order, np.zeros(len(order), np.int16))]
    elif len(names) <= SHORT:
        blocks = [_doubled(names, cap_names)]
    else:
        kept = Blocks(spill)
        for pos, value in sorted_suffixes(names, cap_names, spill):
            kept.append(pos, value)
        kept.append(np.array([len(names) - 1]), np.zeros(1, np.int16))  # the last one, smallest of all
        blocks = kept.drain_reversed()

    def seeds() -> Iterator[Block]:
        previous = None
        for order, value in blocks:
            for i in range(0, len(order), STEP):
                b, shared = order[i : i + STEP], value[i : i + STEP].astype(np.int64)
                a = np.append(previous if previous is not None else b[0], b[:-1])
                x, y = np.minimum(a + shared, len(star) - 1), np.minimum(b + shared, len(star) - 1)
                done = star[x] - star[a]
                left = np.maximum(cap - done, 0)
                out = np.minimum(done, cap)
                some = np.flatnonzero((left > 0) & (a != b))
                out[some] += np.minimum(common_prefix(text, star[x[some]], star[y[some]], cap), left[some])
                if previous is None:
                    out[0] = 0
                previous = b[-1]
                yield star[b], out.astype(np.int16)

    larger = Blocks(spill)
    for pos, value, seed in _induce(text, text, ~small, seeds(), cap, spill):
        larger.append(pos[~seed], value[~seed])
    top = int(text.max())
    for pos, value, _ in _induce(text, (top - text.astype(np.int64)).astype(text.dtype), small, larger.drain_reversed(), cap, spill):
        yield pos, value


def shared_with_another(text: np.ndarray, cap: int, spill: Spill) -> np.ndarray:
    """For each position: another suffix has the same first ``cap`` symbols."""
    out, last = np.zeros(len(text), bool), -1
    for pos, value in sorted_suffixes(text, cap, spill):
        at = np.flatnonzero(value >= cap)
        out[pos[at]] = True
        out[pos[at[at > 0] - 1]] = True
        if len(at) and at[0] == 0 and last >= 0:
            out[last] = True
        last = int(pos[-1])
    return out

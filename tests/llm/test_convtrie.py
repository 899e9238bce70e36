"""op 12: the trie of rebuilt conversations against a plain one."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from tidemart.llm import convtrie

from .data import SPACED


def _brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = (*own.get(c - int(math.fmod(c, 20)), [])[:h], *turns[h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children.get(p)
            saved[p[:d]] += (len(m) - 1) * len(SPACED.findall(p[-1][1])) if p else 0
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p], sha(p)) for p, m in members.items())


def _table(spark, rows, partitions=3):
    schema = "conv_id long, turn long, role string, text string, seq string, n int, low int, id int, shard int, digest int, place int, words int, key int"
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5, 6, 7, 8) for r in rows], schema).repartition(partitions)


def _got(spark, rows):
    df = convtrie.trie(_table(spark, rows))
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()))


def _rows(seed=3, convs=150):
    rng = random.Random(seed)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {rng.randrange(3)} of some words") for c in range(convs) for t in range(rng.randrange(1, 7))]
    rows += [(200 + c, t, "user", "same  words\there") for c in range(60) for t in range(3)]  # copies
    rows += [(300, t, "user", f"long {t}") for t in range(400)]
    rows += [(-41, 0, "user", "minus"), (-40, 0, None, None), (-41, 1, None, "x"), (401, None, "user", "null turn"), (401, 3, "user", "b"), (401, 3, "user", "a"), (401, 3, "user", "a"), (None, 0, "user", "nobody")]
    gone = next(c for c in range(501, 520) if zlib.crc32(str(c).encode()) % 4 > 1)
    rows += [(gone, 0, "user", "gone")]  # its only turn goes and the donor is absent: turnless
    return rows


def test_edge_rows(spark):
    rows = _rows()
    assert _got(spark, rows) == _brute(rows)


@pytest.mark.parametrize("turns", [1, 7, 60])
def test_small_shards(spark, monkeypatch, turns):
    monkeypatch.setattr(convtrie, "SHARD_TURNS", turns)
    monkeypatch.setattr(convtrie, "BLOCK", 2)
    rows = _rows(seed=turns, convs=60)
    assert _got(spark, rows) == _brute(rows)


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(1001, 1020) if zlib.crc32(str(c).encode()) % 4 > 1)
    rows = [(c, 0, "user", "a b"), (c + 40, 0, "user", "a b")]
    assert _got(spark, rows) == _brute(rows)


def test_empty_tables(spark):
    assert _got(spark, []) == []
    assert _got(spark, [(None, 1, "user", "a")]) == []


def test_median_insertion_balances_siblings():
    tree = convtrie.build_tree([((i, 1), 1, i, "") for i in range(1000)])
    assert tree.siblings() <= 10 and tree.n[0] == 1000 and tree.low[0] == 0

"""Connected components: hubs, chains and loops against a plain search."""

import random

import pytest

from tidemart.llm.components import components


def _brute(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {x: find(x) for x in parent}


def _random(n, m, seed):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]


@pytest.mark.parametrize("links", [
    [(7, i) for i in range(300)] + [(301, 299), (400, 401)],  # a hub whose smallest neighbour is not the hub
    [(i, i + 1) for i in range(60)],
    [(i + 1, i) for i in range(0, 40, 2)] + [(i, i + 1) for i in range(1, 41, 2)],
    [(5, 5), (None, 3), (4, None), (1, 2), (2, 1), (1, 2)],
    _random(200, 120, 1), _random(100, 300, 2), [],
])
def test_equals_a_plain_search(spark, links):
    out = components(spark.createDataFrame(links, "a long, b long"))
    got = [(r.node, r.component) for r in out.collect()]
    assert len(got) == len(set(got)) and dict(got) == _brute(links)

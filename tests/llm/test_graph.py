from __future__ import annotations

import random
from collections import defaultdict

import pytest

from llm.brute import components
from niaga.llm import graph


@pytest.mark.parametrize("seed", range(3))
def test_components_of_stars_chains_and_random_links(spark, seed):
    r = random.Random(seed)
    links = [(0, i) for i in range(1, 40)] if seed == 0 else []
    links += [(100 + i, 101 + i) for i in range(r.choice([5, 30]))]
    links += [(200 + r.randrange(60), 200 + r.randrange(60)) for _ in range(40)]
    links += links[:5] + [(b, a) for a, b in links[5:9]]
    both = defaultdict(set)
    for a, b in links:
        if a != b:
            both[a].add(b)
            both[b].add(a)
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == components(both) and len(got) == len(both)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0

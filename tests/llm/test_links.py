import random

import pytest

from pagetrail.llm.links import components


def brute(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("case", ["random", "chain", "star", "cycle", "empty", "loops"])
def test_components(spark, case):
    shuffled = random.Random(3)
    pairs = {
        "random": [(shuffled.randrange(300), shuffled.randrange(300)) for _ in range(200)],
        "chain": [(i, i + 1) for i in shuffled.sample(range(60), 60)],
        "star": [(1000, i) for i in range(500)],
        "cycle": [(i, (i + 1) % 17) for i in range(17)],
        "empty": [],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[case]
    found = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    expected = {x: root for x, root in brute(p for p in pairs if p[0] != p[1]).items() if x != root}
    assert len(found) == len(expected) and {r.node: r.root for r in found} == expected

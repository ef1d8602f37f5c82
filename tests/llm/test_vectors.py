import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetrail.llm import vectors as v


def fixture():
    r = np.random.default_rng(3)
    out = []
    for _ in range(60):
        centre = r.standard_normal(16)
        out += [centre + r.standard_normal(16) * s for s in r.uniform(0.01, 0.12, r.integers(1, 6))]
    out += [out[3], out[3], out[7] * 2.5]
    return [x.astype(np.float32) for x in out]


VECTORS = fixture()
ODD = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.0], [2.0, 4.0]]


def brute(rows):
    ids = [i for i, _ in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def cosine(a, b):
        if a is None or b is None or len(a) != len(b) or not len(a):
            return 0
        a, b = ([math.nan if x is None else float(x) for x in y] for y in (a, b))
        if not all(map(math.isfinite, a + b)) or not any(a) or not any(b):
            return 0
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))

    for a in range(len(rows)):
        for b in range(a):
            if cosine(rows[a][1], rows[b][1]) >= 0.95:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    smallest = {}
    for k, i in enumerate(ids):
        smallest[find(k)] = min(i, smallest.get(find(k), i))
    return [(i, links[k], smallest[find(k)], i == smallest[find(k)]) for k, i in enumerate(ids)]


def rows_of():
    rows = [(1000 - i, [float(x) for x in y]) for i, y in enumerate(VECTORS)]
    return rows + [(2000 + i, x) for i, x in enumerate(ODD)]


@pytest.mark.parametrize("block", [v.BLOCK, 256])
def test_equals_brute_force(spark, block):
    frame = spark.createDataFrame(rows_of(), "vec_id bigint, embedding array<float>").withColumn("key", F.lit("x")).repartition(5)
    found = v.near_duplicates(frame, block=block).collect()
    assert sorted(map(tuple, found)) == sorted(brute([(i, None if x is None else [None if y is None else np.float32(y) for y in x]) for i, x in rows_of()]))


def test_windows_link_no_pair_twice_and_none_below(spark):
    """With small windows some links are missed, but none is wrong and components stay those of the links found."""
    frame = spark.createDataFrame(rows_of(), "vec_id bigint, embedding array<float>")
    exact = {i: n for i, n, _, _ in brute(rows_of())}
    for window, block in ((1, 8), (4, 4), (16, 32)):
        found = v.near_duplicates(frame, window=window, block=block).collect()
        assert all(r.n_links <= exact[r.vec_id] for r in found)
        assert sum(r.n_links for r in found) >= 0.9 * sum(exact.values())


def test_group_of_many_different_near_copies(spark):
    """More near copies than a window and than a block of a component hold, all different, and copies of some of them."""
    r = np.random.default_rng(11)
    centre = r.standard_normal(64) / 8
    near = [centre + r.standard_normal(64) / 8 * s for s in r.uniform(0.12, 0.3, 2 * v.PART_CLASSES)]
    every = np.array([*near, *near[:5], *(r.standard_normal(64) for _ in range(4000))], np.float32)
    every = every[r.permutation(len(every))]
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(every)], "vec_id bigint, embedding array<float>")
    exact = every.astype(np.float64)
    exact /= np.sqrt((exact * exact).sum(axis=1))[:, None]
    exact = exact @ exact.T >= v.THRESHOLD
    np.fill_diagonal(exact, False)
    found = {x.vec_id: x for x in v.near_duplicates(frame.repartition(5)).collect()}
    links = np.array([found[i].n_links for i in range(len(every))])
    component = np.array([found[i].component_id for i in range(len(every))])
    # the passes decide who shares a component; inside one no link is missed
    assert links.tolist() == (exact & (component[:, None] == component[None, :])).sum(axis=1).tolist()
    assert links.sum() >= 0.9999 * exact.sum()


def test_repeated_null_ids_and_empty_table(spark):
    one = [1.0, 0.5, 0.25]
    frame = spark.createDataFrame([(5, one), (5, one), (None, one), (9, one)], "vec_id bigint, embedding array<double>")
    found = sorted(((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in v.near_duplicates(frame).collect()))
    assert found == [(0, 3, 5, False), (5, 3, 5, True), (5, 3, 5, True), (9, 3, 5, False)]
    assert v.near_duplicates(frame.limit(0)).count() == 0


def test_number_of_passes_grows_slowly():
    few, many = (v.plan_passes(0.95, n, v.WINDOW, v.RECALL) for n in (50_000, 100_000_000))
    assert v.LEAST_PASSES <= few < many < 60
    with pytest.raises(ValueError):
        v.near_duplicates(None, window=10, block=5)

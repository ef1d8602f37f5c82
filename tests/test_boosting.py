"""The booster against plain loops over rows, features and bins."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetrail.operators import boosting as b

UNIT = 1 << 30


def table(rows, seed=1):
    r = np.random.default_rng(seed)
    out = []
    for _ in range(rows):
        x = [float(r.integers(0, 4)), round(float(r.normal()), 3), float(r.integers(0, 300)), 1.0]
        y = int((x[0] > 1) + (x[1] > 0.3) * (x[2] > 100)) if r.random() > 0.1 else int(r.integers(0, 3))
        out.append((x, y))
    return out


def plain(data, edges, classes, rounds, depth, rate, least):
    """(feature, cut, value) per round, class and node, and the margins, with one loop per row."""
    bins = [[min(sum(e < v for e in own), len(own) - 1) for v, own in zip(x, edges)] for x, _ in data]
    margins = [[math.log(max(sum(y == k for _, y in data) / len(data), 1e-15)) for k in range(classes)] for _ in data]
    trees = []
    for _ in range(rounds):
        gradients = []
        for m, (_, y) in zip(margins, data):
            odds = np.exp(np.array(m) - max(m))
            share = odds / odds.sum()
            gradients.append([(round((share[k] - (y == k)) * UNIT), round(share[k] * (1 - share[k]) * UNIT)) for k in range(classes)])
        grown = []
        for k in range(classes):
            nodes = {0: list(range(len(data)))}
            tree = {}
            for level in range(depth + 1):
                for node in range((1 << level) - 1, (2 << level) - 1):
                    if node not in nodes:
                        continue
                    own = nodes[node]
                    g, h = sum(gradients[i][k][0] for i in own), sum(gradients[i][k][1] for i in own)
                    best = (b.LEAST_GAIN * UNIT, None, None)
                    for f in range(len(edges)) if level < depth else ():
                        for cut in range(len(edges[f])):
                            left = [i for i in own if bins[i][f] <= cut]
                            gl, hl = sum(gradients[i][k][0] for i in left), sum(gradients[i][k][1] for i in left)
                            if min(len(left), len(own) - len(left)) < least or min(hl, h - hl) < b.LEAST_HESSIAN * UNIT:
                                continue
                            gain = gl * gl / hl + (g - gl) ** 2 / (h - hl) - g * g / h
                            if gain > best[0]:
                                best = (gain, f, cut)
                    tree[node] = (best[1], best[2], -rate * g / max(h, 1))
                    if best[1] is not None:
                        nodes[2 * node + 1] = [i for i in own if bins[i][best[1]] <= best[2]]
                        nodes[2 * node + 2] = [i for i in own if bins[i][best[1]] > best[2]]
            for i in range(len(data)):
                node = 0
                while tree[node][0] is not None:
                    node = 2 * node + 1 + (bins[i][tree[node][0]] > tree[node][1])
                margins[i][k] += tree[node][2]
            grown.append(tree)
        trees.append(grown)
    return trees, margins


@pytest.mark.parametrize("partitions", [1, 5])
def test_splits_equal_a_plain_loop(spark, partitions):
    data = table(300)
    frame = spark.createDataFrame(data, "features array<double>, label int").repartition(partitions)
    model = b.fit(frame, 3, rounds=3, depth=3, rate=0.3, most_bins=12, least_rows=10)
    trees, margins = plain(data, [e.tolist() for e in model.edges], 3, 3, 3, 0.3, 10)
    for number, grown in enumerate(trees):
        for k, tree in enumerate(grown):
            for node, (feature, cut, value) in tree.items():
                assert model.feature[number, k, node] == (b._LEAF if feature is None else feature)
                if feature is None:
                    assert model.value[number, k, node] == pytest.approx(value)
                else:
                    assert model.cut[number, k, node] == cut
    found = {tuple(row.features): (row.margins, row.winner) for row in model.predict(frame).collect()}
    for (x, _), expected in zip(data, margins):
        assert found[tuple(x)][0] == pytest.approx(expected) and found[tuple(x)][1] == int(np.argmax(expected))


def test_bins(spark):
    frame = spark.createDataFrame([([float(i), float(i % 3), 5.0], 0) for i in range(1000)], "features array<double>, label int")
    edges = b.bin_edges(frame, most=10)
    assert [len(e) for e in edges] == [10, 3, 1]
    assert np.diff(edges[0]).tolist() == [100] * 9 and edges[0][-1] == 999
    assert edges[1].tolist() == [0, 1, 2]


def test_model_does_not_depend_on_the_margins_being_written(spark, monkeypatch):
    frame = spark.createDataFrame(table(200), "features array<double>, label int")
    whole = b.fit(frame, 3, rounds=5, depth=2)
    monkeypatch.setattr(b, "_ROUNDS_KEPT", 2)
    again = b.fit(frame.repartition(3), 3, rounds=5, depth=2)
    assert np.array_equal(whole.feature, again.feature) and np.array_equal(whole.cut, again.cut)
    assert np.allclose(whole.value, again.value, rtol=1e-9)


def test_one_class_no_rows_and_unseen_values(spark):
    frame = spark.createDataFrame(table(60), "features array<double>, label int")
    one = b.fit(frame.withColumn("label", F.lit(0)), 1, rounds=2)
    assert {row.winner for row in one.predict(frame).collect()} == {0}
    empty = b.fit(frame.limit(0), 2, rounds=2)
    assert {row.winner for row in empty.predict(frame).collect()} == {0}
    some = b.fit(frame, 3, rounds=2)
    far = spark.createDataFrame([([1e9, -1e9, 0.5, 7.0], 0)], "features array<double>, label int")
    assert some.predict(far).first().winner in (0, 1, 2)
    assert some.predict(frame.limit(0)).collect() == []


def test_one_task_grows_what_the_jobs_of_each_level_grow(spark, monkeypatch):
    frame = spark.createDataFrame(table(1500, 4), "features array<double>, label int").repartition(3)
    kinds = {"rate": 0.2, "most_bins": 40, "least_rows": 8}
    whole = b.fit(frame, 3, rounds=7, depth=5, **kinds)
    monkeypatch.setattr(b, "_WHOLE_ROWS", 0)
    monkeypatch.setattr(b, "_TASK_ROWS", 400)
    by_level = b.fit(frame, 3, rounds=7, depth=5, **kinds)
    assert (whole.feature >= 0).sum() > 150
    for name in ("start", "feature", "cut", "value"):
        assert np.array_equal(getattr(whole, name), getattr(by_level, name))


def test_margins_written_by_the_jobs_of_each_level(spark, monkeypatch):
    frame = spark.createDataFrame(table(200), "features array<double>, label int")
    monkeypatch.setattr(b, "_WHOLE_ROWS", 0)
    whole = b.fit(frame, 3, rounds=5, depth=2)
    monkeypatch.setattr(b, "_ROUNDS_KEPT", 2)
    again = b.fit(frame.repartition(3), 3, rounds=5, depth=2)
    assert np.array_equal(whole.feature, again.feature) and np.array_equal(whole.cut, again.cut)
    assert np.allclose(whole.value, again.value, rtol=1e-9)


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_jobs_do_not_grow_with_the_rounds(spark):
    """Each round had a job for each level, which for small tables took all the time."""
    frame = spark.createDataFrame(table(300), "features array<double>, label int")
    few = jobs_of(spark, "two rounds", lambda: b.fit(frame, 3, rounds=2, depth=4))
    many = jobs_of(spark, "thirty rounds", lambda: b.fit(frame, 3, rounds=30, depth=4))
    assert 0 < many == few

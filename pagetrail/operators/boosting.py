"""Multiclass gradient boosting on histograms.

Features are binned once. A round grows a tree for each class on the gradients of the softmax loss. All trees of a round grow
level by level together: one aggregation sums gradient, Hessian and rows per class, node, feature and bin, and from its
result, whose size depends on the parameters only, the driver takes the splits of the level. Rows that one task can hold
are boosted by one task, without a job for each level. Gradients are summed as integers, so a model does not depend on how the
rows are dealt out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.session import materialize, remove_scratch, scratch_path

# executors run the functions of this module as the driver sends them and need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUNDS, DEPTH, RATE = 300, 6, 0.05
MAX_BINS = 255
LEAST_ROWS = 20
LEAST_HESSIAN = 1e-3
# Below this gain a split is rounding.
LEAST_GAIN = 1e-6
# Gradients are multiples of 2^-30.
_UNIT = 1 << 30
# Rounds after which the margins of all rows are written anew; until then they follow from the rounds since.
_ROUNDS_KEPT = 5
# Rows that one task sums.
_TASK_ROWS = 16_384
# Up to so many rows one task grows all trees.
_WHOLE_ROWS = 131_072
_LEAF = -1


@dataclass
class Booster:
    """Trees by round, class and node; the children of node i are 2i + 1 and 2i + 2, and a leaf has no feature."""

    edges: list[np.ndarray]
    start: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def predict(self, rows: DataFrame, features: str = "features") -> DataFrame:
        """``rows`` with ``margins``, one number per class, and ``winner``, the first class with the largest."""
        edges, start, trees = self.edges, self.start, (self.feature, self.cut, self.value)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margins = _margins(_binned(batch[features], edges), start[None, :], trees)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, _lists(margins, pa.float64()), pa.array(margins.argmax(1) if len(margins) else [], pa.int32())],
                    names=[*batch.schema.names, "margins", "winner"],
                )

        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        return rows.mapInArrow(run, f"{fields}, margins array<double>, winner int")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))


def _binned(column: pa.Array, edges: list[np.ndarray]) -> np.ndarray:
    """Bins of a column of feature arrays: bin i holds the values up to edge i, the last one also those above."""
    if not edges or not len(column):
        return np.zeros((len(column), len(edges)), np.int64)
    values = _matrix(column, np.float64)
    return np.stack([np.minimum(np.searchsorted(e, values[:, i], "left"), len(e) - 1) for i, e in enumerate(edges)], axis=1)


def _nodes(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node that each row reaches in one tree after so many levels."""
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    for _ in range(levels):
        own = feature[node]
        below = 2 * node + 1 + (bins[rows, np.maximum(own, 0)] > cut[node])
        node = np.where(own == _LEAF, node, below)
    return node


def _levels(nodes: int) -> int:
    return (nodes + 1).bit_length() - 2


def _margins(bins: np.ndarray, margins: np.ndarray, trees: tuple[np.ndarray, ...]) -> np.ndarray:
    """``margins`` plus what the trees of some rounds add."""
    feature, cut, value = trees
    total = np.repeat(margins, len(bins), axis=0) if len(margins) != len(bins) else margins.copy()
    for number in range(len(feature)):
        for k in range(feature.shape[1]):
            node = _nodes(bins, feature[number, k], cut[number, k], _levels(feature.shape[2]))
            total[:, k] += value[number, k][node]
    return total


def _gradients(margins: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the softmax loss in units of 2^-30."""
    odds = np.exp(margins - margins.max(axis=1, keepdims=True))
    share = odds / odds.sum(axis=1, keepdims=True)
    first = share.copy()
    first[np.arange(len(label)), label] -= 1
    return np.rint(first * _UNIT), np.rint(share * (1 - share) * _UNIT)


def bin_edges(train: DataFrame, features: str = "features", most: int = MAX_BINS) -> list[np.ndarray]:
    """Upper edges of the bins of each feature: every value is a bin if there are few, else bins of about equal size."""
    counted = train.select(F.posexplode(features).alias("feature", "value")).groupBy("feature", "value").agg(F.count("*").alias("n"))
    own = Window.partitionBy("feature")
    before = own.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.select(
        "feature",
        "value",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below"),
        F.sum("n").over(own).alias("rows"),
        F.count("*").over(own).alias("values"),
        F.row_number().over(own.orderBy("value")).alias("place"),
    )
    number = F.when(F.col("values") <= most, F.col("place")).otherwise(F.floor(F.col("below") * most / F.col("rows")))
    edges = placed.groupBy("feature", number.alias("bin")).agg(F.max("value").alias("edge"))
    found: dict[int, list[float]] = {}
    for row in edges.collect():  # at most ``most`` rows per feature
        found.setdefault(row["feature"], []).append(row["edge"])
    return [np.array(sorted(found[i])) for i in sorted(found)]


def _sums(state: DataFrame, tasks: int, trees, grown, level: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (class, node of the level, feature, bin) and the gradients, Hessians and rows there."""
    classes, wide, bins_of_all = grown[0].shape[0], 1 << level, int(offsets[-1])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, classes * wide * bins_of_all))
        for batch in batches:
            bins = _matrix(batch["bins"], np.int64)
            if not len(bins):
                continue
            first, second = _gradients(_margins(bins, _matrix(batch["margins"], np.float64), trees), batch["label"].to_numpy())
            for k in range(classes):
                node = _nodes(bins, grown[0][k], grown[1][k], level) - (wide - 1)
                there = np.flatnonzero(node >= 0)
                at = ((k * wide + node[there]) * bins_of_all)[:, None] + offsets[:-1] + bins[there]
                for held, weight in zip(total, (first[there, k], second[there, k], np.ones(len(there))), strict=True):
                    held += np.bincount(at.ravel(), np.repeat(weight, at.shape[1]), len(held))
        at = np.flatnonzero(total[2])
        g, h, n = (pa.array(x[at].astype(np.int64)) for x in total)
        yield pa.record_batch({"at": pa.array(at), "g": g, "h": h, "n": n})

    parts = state.mapInArrow(add, "at bigint, g bigint, h bigint, n bigint")
    if tasks == 1:
        parts = parts.coalesce(1)  # sums of one task need no shuffle
    found = parts.groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow()
    return found["at"].to_numpy(), np.stack([found[c].to_numpy() for c in "ghn"])


def _split(at: np.ndarray, sums: np.ndarray, grown, level: int, offsets: np.ndarray, rate: float, least: int) -> bool:
    """Split the nodes of a level where that lowers the loss, and give their children values; whether any was split."""
    slots, place = np.divmod(at, int(offsets[-1]))
    held, row = np.unique(slots, return_inverse=True)
    table = np.zeros((3, len(held), int(offsets[-1])))
    table[:, row, place] = sums
    classes, nodes = np.divmod(held, 1 << level)
    return bool(len(_divide(table, classes, nodes + (1 << level) - 1, grown, offsets, rate, least)))


def _divide(table: np.ndarray, classes: np.ndarray, nodes: np.ndarray, grown, offsets: np.ndarray, rate: float, least: int) -> np.ndarray:
    """Like ``_split``, from the sums of each node (gradients, Hessians and rows; node; bin); the places of those it split."""
    feature, cut, value = grown
    g, h, n = table[:, :, : offsets[1]].sum(2)  # every row is in one bin of the first feature
    below = np.cumsum(table, axis=2)
    starts = np.concatenate([np.zeros((3, len(nodes), 1)), below], axis=2)[:, :, np.repeat(offsets[:-1], np.diff(offsets))]
    left = below - starts
    right = np.stack([g, h, n])[:, :, None] - left
    fine = (left[2] >= least) & (right[2] >= least)
    fine &= (left[1] >= LEAST_HESSIAN * _UNIT) & (right[1] >= LEAST_HESSIAN * _UNIT)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fine, left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - (g**2 / np.maximum(h, 1))[:, None], -np.inf)
    best = gain.argmax(1)
    every = np.arange(len(nodes))
    split = gain[every, best] > LEAST_GAIN * _UNIT
    of_place = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    root = nodes == 0
    value[classes[root], 0] = -rate * g[root] / np.maximum(h[root], 1)
    best, classes, nodes, every = best[split], classes[split], nodes[split], every[split]
    feature[classes, nodes] = of_place[best]
    cut[classes, nodes] = best - offsets[:-1][of_place[best]]
    for child, side in ((1, left), (2, right)):
        value[classes, 2 * nodes + child] = -rate * side[0, every, best] / side[1, every, best]
    return every


def _boosted(bins: np.ndarray, label: np.ndarray, start: np.ndarray, offsets: np.ndarray, rounds: int, depth: int, rate: float, least: int):
    """The trees (feature, cut, value) of one round after another, grown on rows in memory."""
    shape = (len(start), (1 << (depth + 1)) - 1)
    place = np.ascontiguousarray((bins + offsets[:-1]).T)
    margins = np.repeat(start[None, :], len(bins), axis=0)
    for _ in range(rounds):
        grown = np.full(shape, _LEAF, np.int64), np.zeros(shape, np.int64), np.zeros(shape)
        first, second = _gradients(margins, label)
        for k in range(shape[0]):
            reached = _grow(place, np.ascontiguousarray(first[:, k]), np.ascontiguousarray(second[:, k]), grown, k, offsets, depth, rate, least)
            margins[:, k] += grown[2][k][reached]
        yield grown


def _grow(place: np.ndarray, first: np.ndarray, second: np.ndarray, grown, k: int, offsets: np.ndarray, depth: int, rate: float, least: int) -> np.ndarray:
    """Grow the tree of class k; the node that each row reaches. ``place`` has a row per feature: the bin among those of all."""
    width = int(offsets[-1])

    def summed(rows: np.ndarray, slot: np.ndarray, slots: int) -> np.ndarray:
        at = (place[:, rows] + slot * width).ravel()
        weights = (np.tile(w[rows], len(place)) for w in (first, second))
        sums = [np.bincount(at, w, slots * width) for w in weights]
        return np.stack([*sums, np.bincount(at, minlength=slots * width)]).reshape(3, slots, width)

    reached = np.zeros(len(first), np.int64)
    # rows of the nodes that may be split, each row with the place of its node
    rows, slot, nodes = np.arange(len(first)), np.zeros(len(first), np.int64), np.zeros(1, np.int64)
    table = summed(rows, slot, 1)
    for level in range(depth):
        split = _divide(table, np.full(len(nodes), k), nodes, grown, offsets, rate, least)
        if not len(split):
            break
        parent = nodes[split]
        pair = np.full(len(nodes), -1)
        pair[split] = np.arange(len(split))
        there = pair[slot] >= 0
        rows, slot = rows[there], pair[slot[there]]
        own = grown[0][k][parent]
        above = place[own[slot], rows] > (offsets[own] + grown[1][k][parent])[slot]
        slot = 2 * slot + above
        nodes = np.stack([2 * parent + 1, 2 * parent + 2], axis=1).ravel()
        reached[rows] = nodes[slot]
        if level + 1 == depth:
            break
        # the sums of the smaller child are counted, those of the other one are what it leaves of its parent
        counts = np.bincount(slot, minlength=len(nodes)).reshape(-1, 2)
        small = counts.argmin(1)
        counted = small[slot >> 1] == (slot & 1)
        part = summed(rows[counted], slot[counted] >> 1, len(parent))
        both = np.empty((3, len(parent), 2, width))
        every = np.arange(len(parent))
        both[:, every, small] = part
        both[:, every, 1 - small] = table[:, split] - part
        # a node with fewer rows than two children need is a leaf
        large = np.flatnonzero(counts.ravel() >= 2 * least)
        table, nodes = both.reshape(3, -1, width)[:, large], nodes[large]
        moved = np.full(counts.size, -1)
        moved[large] = np.arange(len(large))
        there = moved[slot] >= 0
        rows, slot = rows[there], moved[slot[there]]
    return reached


def fit(
    train: DataFrame,
    classes: int,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    most_bins: int = MAX_BINS,
    least_rows: int = LEAST_ROWS,
) -> Booster:
    """Boost on rows of ``features`` (array of doubles without nulls) and ``label`` (0 to ``classes`` - 1)."""
    spark = train.sparkSession
    given = scratch_path(spark, "boosting")
    # read several times below
    train = materialize(train.select("features", "label"), "boosting", given)
    try:
        edges = bin_edges(train, most=most_bins)
        nodes = (1 << (depth + 1)) - 1
        counts = dict(train.groupBy("label").count().collect())  # a row for each class
        total = sum(counts.values())
        start = np.log(np.maximum([counts.get(k, 0) / max(total, 1) for k in range(classes)], 1e-15))
        if not edges:
            none = np.zeros((0, classes, nodes), np.int64)
            return Booster([], start, none, none, none.astype(float))
        shape = (rounds, classes, nodes)
        boost = _boost_at_once if total <= _WHOLE_ROWS else _boost_by_level
        return Booster(edges, start, *boost(train, total, edges, start, shape, depth, rate, least_rows))
    finally:
        remove_scratch(spark, given)


def _boost_at_once(train: DataFrame, total: int, edges: list[np.ndarray], start: np.ndarray, shape: tuple[int, ...], depth: int, rate: float, least: int):
    """The trees, grown by one task that holds all rows."""
    offsets = np.cumsum([0, *(len(e) for e in edges)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(_binned(b["features"], edges), b["label"].to_numpy()) for b in batches if b.num_rows]
        bins, label = (np.concatenate(x) for x in zip(*held, strict=True))
        for number, trees in enumerate(_boosted(bins, label, start, offsets, shape[0], depth, rate, least)):
            feature, cut, value = (x.reshape(1, -1) for x in trees)
            yield pa.record_batch({
                "round": pa.array([number]),
                "feature": _lists(feature, pa.int64()),
                "cut": _lists(cut, pa.int64()),
                "value": _lists(value, pa.float64()),
            })

    schema = "round bigint, feature array<bigint>, cut array<bigint>, value array<double>"
    found = train.select("features", F.col("label").cast("int")).repartition(1).mapInArrow(run, schema).toArrow().sort_by("round")
    return [_matrix(found[c].combine_chunks(), kind).reshape(shape) for c, kind in (("feature", np.int64), ("cut", np.int64), ("value", np.float64))]


def _boost_by_level(train: DataFrame, total: int, edges: list[np.ndarray], start: np.ndarray, shape: tuple[int, ...], depth: int, rate: float, least: int):
    """The trees, grown with a job for each level of a round, which sums the rows in many tasks."""
    spark = train.sparkSession
    rounds = shape[0]
    offsets = np.cumsum([0, *(len(e) for e in edges)])

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _binned(batch["features"], edges)
            label = batch["label"].cast(pa.int32())
            margins = np.repeat(start[None, :], len(bins), axis=0)
            yield pa.record_batch({"label": label, "bins": _lists(bins, pa.int32()), "margins": _lists(margins, pa.float64())})

    schema = "label int, bins array<int>, margins array<double>"
    path = scratch_path(spark, "boosting")
    tasks = max(1, -(-total // _TASK_ROWS))
    state = materialize(train.repartition(tasks).mapInArrow(prepare, schema), "boosting", path)
    feature, cut = (np.full(shape, x, np.int64) for x in (_LEAF, 0))
    value = np.zeros(shape)
    written = 0
    for number in range(rounds):
        grown = feature[number], cut[number], value[number]
        since = slice(written, number)
        for level in range(depth):
            at, sums = _sums(state, tasks, (feature[since], cut[since], value[since]), grown, level, offsets)
            if not _split(at, sums, grown, level, offsets, rate, least):
                break
        if number + 1 - written == _ROUNDS_KEPT and number + 1 < rounds:
            since = slice(written, number + 1)
            before, path = path, scratch_path(spark, "boosting")
            state = materialize(_advanced(state, (feature[since], cut[since], value[since]), schema), "boosting", path)
            remove_scratch(spark, before)
            written = number + 1
    remove_scratch(spark, path)
    return feature, cut, value


def _advanced(state: DataFrame, trees, schema: str) -> DataFrame:
    """The rows with their margins after some more rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                margins = _margins(_matrix(batch["bins"], np.int64), _matrix(batch["margins"], np.float64), trees)
                yield pa.record_batch({"label": batch["label"], "bins": batch["bins"], "margins": _lists(margins, pa.float64())})

    return state.mapInArrow(run, schema)

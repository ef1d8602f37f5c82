"""Operator 10: near-duplicate vectors by sorted projection passes.

1. Equal vectors form a class, which from here on counts once with its number of rows.
2. In each pass, the signs of 63 random projections are concatenated to one number, and all classes are sorted by it. A
   class is compared with its ``window`` successors in that order, in double precision. Vectors at a small angle agree in
   most signs, so that they stand close together in most passes.
3. Each class carries its places in all passes: a pair that an earlier pass has already compared is left out, so every
   link is counted once, and only links per class and the smallest class that it reaches leave a task.
4. Links of all passes are united to components.
5. A window holds not all near copies of a class in a dense group, so links are counted anew in each component of more than
   two classes: all its pairs are compared, a large component in pairs of blocks.

All links inside a component are therefore counted, whatever its size. The passes decide only which classes share a component:
their number follows from the threshold, the number of classes and the wanted recall (``plan_passes``), and in a dense group
the windows overlap to chains. The work on a group grows with the square of its classes.

Null and empty vectors, those of length 0 and those with null or non-finite components link with nothing. Vectors with
different numbers of components are not compared. Repeated rows and ties are ordinary copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagetrail.llm.links import components
from pagetrail.session import materialize

THRESHOLD = 0.95
RECALL = 0.99
WINDOW = 256
LEAST_PASSES = 12
#: Classes whose windows one group of rows holds; the window before them comes along.
BLOCK = 1024
#: Classes, and numbers in their vectors, of a block of a large component; small components share a task up to this size.
PART_CLASSES, PART_NUMBERS = 2048, 1 << 22
#: Passes that are compared together: so many copies of the vectors are shuffled at a time.
TOGETHER = 3
_BITS = 63
_ROWS = 4096
_STRIPE = 512


def plan_passes(threshold: float, classes: int, window: int, recall: float) -> int:
    """Passes after which a pair at the threshold has shared a window with the wanted probability, if vectors are spread
    evenly: it must agree in so many leading signs that about one window of vectors is left."""
    agree = 1 - math.acos(threshold) / math.pi
    hit = agree ** math.log2(max(classes / window, 1))
    return max(LEAST_PASSES, 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log1p(-hit)))


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their class key (null if invalid), and one row per class."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    keyed = vectors.select("vec_id", F.when(F.coalesce(valid, F.lit(False)), F.xxhash64(v)).alias("key"), "embedding")
    classes = keyed.filter(F.col("key").isNotNull()).groupBy("key")
    classes = classes.agg(F.min("vec_id").alias("first_id"), F.count("*").alias("rows"), F.first("embedding").alias("embedding"))
    return keyed.select("vec_id", "key"), materialize(classes, "vector-classes")


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _unit_vectors(column: pa.Array, size: int) -> np.ndarray:
    vectors = _matrix(column, size)
    vectors /= np.abs(vectors).max(axis=1)[:, None]
    vectors /= np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    return vectors


def _codes(classes: DataFrame, passes: int) -> DataFrame:
    """key, size (number of components) and one sign code per pass."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(_BITS - 1, -1, -1, dtype=np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(start, _ROWS)
                sizes = batch["embedding"].value_lengths().to_numpy()
                codes = np.zeros((batch.num_rows, passes), np.int64)
                for size in np.unique(sizes).tolist():
                    at = np.flatnonzero(sizes == size)
                    own = _matrix(batch["embedding"].take(pa.array(at)), size)
                    for i in range(passes):
                        if (size, i) not in planes:
                            planes[size, i] = np.random.default_rng([7, size, i]).standard_normal((size, _BITS))
                        codes[at, i] = (own @ planes[size, i] >= 0) @ powers
                yield pa.record_batch(
                    {"key": batch["key"], "size": pa.array(sizes, pa.int32()), "codes": pa.array(list(codes), pa.list_(pa.int64()))}
                )

    return classes.select("key", "embedding").mapInArrow(project, "key bigint, size int, codes array<bigint>")


def _places(classes: DataFrame, passes: int) -> DataFrame:
    """key and its places in the orders of all passes: positions in one order of all passes, one pass after the other."""
    codes = materialize(_codes(classes, passes), "vector-codes")
    every = codes.select("key", "size", F.posexplode("codes").alias("pass", "code"))
    order = every.repartitionByRange("pass", "size", "code", "key").sortWithinPartitions("pass", "size", "code", "key")
    order = materialize(order.select("pass", "key", F.monotonically_increasing_id().alias("at")), "vector-order")
    part = F.shiftright("at", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the sort
    starts = order.groupBy(part.alias("part")).count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    placed = order.withColumn("part", part).join(F.broadcast(starts), "part")
    place = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    gathered = placed.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pass", place.alias("place")))).alias("p"))
    return materialize(gathered.select("key", F.col("p.place").alias("places")), "vector-places")


def _compare(number: int, table: pa.Table, threshold: float, window: int):
    """Links of a block of one pass: per class the rows it is linked with and the smallest class it reaches."""
    keys, rows, sizes, context = (table[c].to_numpy() for c in ("key", "rows", "size", "context"))
    places = np.stack(table["places"].to_numpy())
    order = np.lexsort((keys, sizes))
    out = []
    for own in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
        own = own[np.argsort(keys[own])]
        vectors = _unit_vectors(table["embedding"].combine_chunks().take(pa.array(own)), int(sizes[own[0]]))
        linked = vectors @ vectors.T >= threshold
        np.fill_diagonal(linked, False)
        linked &= ~(context[own][:, None] & context[own][None, :])
        a, b = np.nonzero(linked)
        near = np.abs(places[own[a], number] - places[own[b], number]) <= window
        for earlier in range(number):
            near &= np.abs(places[own[a], earlier] - places[own[b], earlier]) > window
        a, b = a[near], b[near]
        links = np.bincount(a, rows[own[b]], minlength=len(own)).astype(np.int64)
        label = np.arange(len(own))
        while True:
            better = label.copy()
            np.minimum.at(better, a, label[b])
            better = better[better]
            if (better == label).all():
                break
            label = better
        some = np.flatnonzero(links)
        out.append((keys[own[some]], links[some], keys[own[label[some]]]))
    return map(np.concatenate, zip(*out, strict=True))


def _counted(vectors: np.ndarray, rows: np.ndarray, one: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Per class the rows it is linked with, from all pairs of the classes ``one`` with ``other``, or of ``one`` if both are equal."""
    links = np.zeros(len(rows))
    same = one is other
    for start in range(0, len(one), _STRIPE):
        some = one[start : start + _STRIPE]
        linked = (vectors[some] @ vectors[other].T >= threshold).astype(np.float64)
        if same:
            linked[np.arange(len(some)), start + np.arange(len(some))] = 0
        else:
            links[other] += rows[some] @ linked
        links[some] += linked @ rows[other]
    return links


def _inside_components(held: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """key and links, the rows it is linked with, for each class of a component of more than two classes."""
    members = roots.select("key", "root").unionByName(roots.select(F.col("root").alias("key"), "root").distinct())
    members = materialize(members.join(held.select("key", "rows", "embedding", "size"), "key"), "vector-members")
    sizes = members.groupBy("root").agg(F.count("*").alias("n"), F.max("size").alias("numbers")).filter("n > 2")
    parts = F.ceil(F.greatest(F.col("n") / PART_CLASSES, F.col("n") * F.col("numbers") / PART_NUMBERS)).cast("int")
    sizes = materialize(sizes.select("root", "n", (F.col("n") * F.col("numbers")).alias("numbers"), parts.alias("parts")), "vector-sizes")
    small = sizes.filter("parts = 1").agg(F.sum("n") / PART_CLASSES, F.sum("numbers") / PART_NUMBERS).first()
    units = max(1, *(math.ceil(x or 0) for x in small))
    placed = members.join(sizes.select("root", "parts"), "root")
    placed = placed.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    unit = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("root"), F.lit(units))).otherwise(F.xxhash64("root", "low", "high"))
    placed = placed.select("key", "root", "rows", "embedding", "size", "part", "low", "high", unit.alias("unit"))

    def count(table: pa.Table) -> pa.Table:
        keys, roots, rows, sizes, part, low, high = (
            table[c].to_numpy() for c in ("key", "root", "rows", "size", "part", "low", "high")
        )
        embeddings, weights = table["embedding"].combine_chunks(), rows.astype(np.float64)
        links = np.zeros(len(keys))
        order = np.lexsort((high, low, roots))
        change = (np.diff(roots[order]) != 0) | (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        for own in np.split(order, np.flatnonzero(change) + 1):
            vectors = _unit_vectors(embeddings.take(pa.array(own)), int(sizes[own[0]]))
            one = np.flatnonzero(part[own] == low[own[0]])
            other = one if low[own[0]] == high[own[0]] else np.flatnonzero(part[own] == high[own[0]])
            links[own] = _counted(vectors, weights[own], one, other, threshold)
        return pa.table({"key": keys, "links": links.astype(np.int64)})

    found = placed.groupBy("unit").applyInArrow(count, "key bigint, links bigint")
    return materialize(found.groupBy("key").agg(F.sum("links").alias("inside")), "vector-inside")


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    window: int = WINDOW,
    recall: float = RECALL,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors`` (vec_id, embedding and any other columns).

    Copies of a vector are linked with each other. A null vec_id counts as the largest; a row whose vec_id repeats is kept
    or not like its equals.
    """
    if block < window:
        raise ValueError("a block must hold a window")
    keyed, classes = _classes(vectors)
    number = plan_passes(threshold, classes.count(), window, recall)
    places = _places(classes, number)
    held = classes.join(places, "key").select("key", "rows", "embedding", "places", F.size("embedding").alias("size"))
    held = materialize(held, "vector-places-rows")

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        found = _compare(key[0].as_py(), table, threshold, window)
        return pa.table(dict(zip(("key", "links", "reaches"), found, strict=True)))

    links = None
    for first in range(0, number, TOGETHER):
        some = F.array(*(F.lit(i) for i in range(first, min(number, first + TOGETHER))))
        rows = held.withColumn("pass", F.explode(some)).withColumn("place", F.element_at("places", F.col("pass") + 1))
        own = F.floor(F.col("place") / block)
        after = F.floor((F.col("place") + window) / block)
        rows = rows.withColumn("block", F.explode(F.array_distinct(F.array(own, after)))).withColumn("context", F.col("block") != own)
        found = rows.groupBy("pass", "block").applyInArrow(compare, "key bigint, links bigint, reaches bigint")
        found = materialize(found, "vector-links")
        links = found if links is None else links.unionByName(found)
    roots = components(links.select(F.col("key").alias("a"), F.col("reaches").alias("b"))).withColumnRenamed("node", "key")
    roots = materialize(roots, "vector-roots")
    counted = links.groupBy("key").agg(F.sum("links").alias("links"))
    known = classes.select("key", "first_id", "rows").join(counted, "key", "left").join(roots, "key", "left")
    known = known.join(_inside_components(held, roots, threshold), "key", "left")
    known = known.withColumns({"root": F.coalesce("root", "key"), "links": F.coalesce("inside", "links", F.lit(0))}).drop("inside")
    known = materialize(known, "vector-known")
    firsts = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = materialize(known.join(firsts, "root").select("key", "rows", "links", "component_id"), "vector-components")
    joined = keyed.join(known, "key", "left")
    component = F.when(F.col("rows").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.when(F.col("rows").isNull(), 0).otherwise(F.col("rows") - 1 + F.col("links")).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


QUERIES = {"op10_embedding_near_dedup": op10_embedding_near_dedup}
ORACLE: dict[str, str] = {}

"""Operator 9: join of documents whose sets of word n-grams have a Jaccard similarity of at least a threshold.

1. Texts with the same words in the same order form a class; from here on a class counts once, with its number of rows.
2. MinHash values of each class are combined into bands. Numbers of bands and rows follow from the similarity and the
   wanted recall (``plan_bands``).
3. Classes are shuffled on their band hashes. A bucket links its members to its smallest one; components of these links
   are groups of classes that may be similar. Most documents share no bucket and are done.
4. The full n-gram sets of a group are brought together once and every pair is verified. A large group is cut into blocks, and
   each pair of blocks is a task of its own; a task returns per class its links and the smallest class that it reaches in
   the block, so that no list of pairs is ever built.

A class of texts that have fewer than n words has one n-gram, the whole text. Null texts and texts without words link with
nothing. Repeated rows and ties are ordinary copies. Two n-grams are equal if their 32-bit hashes are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.columns import put_back, set_aside
from pagetrail.llm.links import components
from pagetrail.llm.textcodes import _OF_PLACE, grams, mix, slices, word_codes
from pagetrail.session import materialize, scratch_path, scratch_scope

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.998
MOST_HASHES = 288
#: A group beyond either bound is cut into blocks of about this size.
BLOCK_CLASSES, BLOCK_GRAMS = 1024, 2_000_000
_DENSE_FROM = 12
_COLUMNS = 2048


def plan_bands(similarity: float, recall: float, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most selective rows for which that many hashes find a pair with the wanted recall."""
    best = None
    for rows in range(1, most_hashes + 1):
        hit = similarity**rows
        if hit < 1e-12:
            break
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("the recall cannot be reached with so few hashes")
    return best


def _signatures(codes: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of each non-empty run of n-gram hashes, one column per band."""
    x = (codes >> np.uint64(32)).astype(np.uint32)
    starts = offsets[:-1]
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64))
    out = np.empty((len(starts), bands), np.int64)
    for band in range(bands):
        total = np.full(len(starts), band + 1, np.uint64)
        for row in range(rows):
            f = factors[band * rows + row]
            h = x * np.uint32(f & np.uint64(0xFFFFFFFF) | np.uint64(1)) + np.uint32(f >> np.uint64(32))
            total += np.minimum.reduceat(h, starts).astype(np.uint64) * _OF_PLACE[row]
        out[:, band] = mix(total).view(np.int64)
    return out


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, class_key (null without words), bands and grams of every row of ``docs``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            codes, offsets = word_codes(batch["text"])
            count = np.diff(offsets)
            some = count > 0
            place = np.arange(len(codes), dtype=np.uint64) - np.repeat(offsets[:-1], count).astype(np.uint64)
            terms = codes * (mix(place + np.uint64(1)) | np.uint64(1))
            key = np.zeros(batch.num_rows, np.uint64)
            bytes_of = [b""] * batch.num_rows
            signs: list = [None] * batch.num_rows
            if some.any():
                key[some] = mix(np.add.reduceat(terms, offsets[:-1][some]))
                hashes, ends = grams(codes, offsets, words)
                own = ends[np.append(np.flatnonzero(some), len(some))]
                found = _signatures(hashes, own, bands, rows)
                small = (hashes >> np.uint64(32)).astype(np.uint32)
                for i, row in enumerate(np.flatnonzero(some)):
                    signs[row] = found[i]
                    bytes_of[row] = small[own[i] : own[i + 1]].tobytes()
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "text_key": batch["text_key"],
                    "class_key": pa.array(key.view(np.int64), mask=~some),
                    "bands": pa.array(signs, pa.list_(pa.int64())),
                    "grams": pa.array(bytes_of, pa.binary()),
                }
            )

    rows_in = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    schema = f"doc_id {rows_in.schema['doc_id'].dataType.simpleString()}, text_key bigint, class_key bigint, bands array<bigint>, grams binary"
    return rows_in.mapInArrow(sign, schema)


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets without repeats."""
    n = len(sets)
    common = np.zeros((n, n), np.int64)
    if n == 2:
        common[0, 1] = common[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
        return common
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    times = np.diff(np.append(new, len(values)))
    often = np.repeat(times, times)
    # an n-gram of few sets: count its pairs; one of many sets: a column of a matrix product
    v, o = values[(often > 1) & (often < _DENSE_FROM)], owner[(often > 1) & (often < _DENSE_FROM)]
    for step in range(1, _DENSE_FROM - 1):
        same = np.flatnonzero(v[step:] == v[:-step])
        if not len(same):
            break
        np.add.at(common, (o[same], o[same + step]), 1)
    common += common.T
    dense = times >= _DENSE_FROM
    column = np.repeat(np.cumsum(dense) - 1, times)[often >= _DENSE_FROM]
    rows = owner[often >= _DENSE_FROM]
    for first in range(0, int(dense.sum()), _COLUMNS):
        own = (column >= first) & (column < first + _COLUMNS)
        held = np.zeros((n, _COLUMNS), np.float32)
        held[rows[own], column[own] - first] = 1
        common += (held @ held.T).astype(np.int64)
    return common


def _verified(keys: np.ndarray, weights: np.ndarray, blocks: np.ndarray, sets: list, similarity: float, within: bool):
    """Links of each class of a pair of blocks and the smallest class it reaches there."""
    order = np.argsort(keys)
    keys, weights, blocks, sets = keys[order], weights[order], blocks[order], [np.unique(sets[i]) for i in order]
    sizes = np.array([len(s) for s in sets])
    common = _common(sets)
    either = sizes[:, None] + sizes[None, :] - common
    linked = common >= similarity * either - 1e-9
    np.fill_diagonal(linked, False)
    if not within:
        linked &= blocks[:, None] != blocks[None, :]
    label = np.arange(len(keys))
    while True:
        near = np.where(linked, label[None, :], len(keys)).min(axis=1)
        better = np.minimum(label, near)
        better = better[better]
        if (better == label).all():
            break
        label = better
    return keys, linked @ weights, keys[label]


def similar_classes(signed: DataFrame, bands: int, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Classes (class_key, first_doc, rows) of ``signed`` and, for those that may be similar to another one, the number
    of rows of other classes linked with it (class_key, links, root); root is the smallest class key of its component."""
    classes = (
        signed.filter(F.col("class_key").isNotNull())
        .groupBy("class_key")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "text_key")).alias("first_doc"),
            F.count("*").alias("rows"),
            F.first("bands").alias("bands"),
        )
    )
    classes = materialize(classes, "jaccard-classes")
    members = classes.select("class_key", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("class_key").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    links = members.join(buckets, "bucket").filter("class_key != hub").select(F.col("class_key").alias("a"), F.col("hub").alias("b"))
    near = components(links)
    members = near.select(F.col("node").alias("class_key"), "root")
    members = members.unionByName(near.select(F.col("root").alias("class_key"), "root").distinct())

    # one row per class holds the grams: that of its first document
    firsts = members.join(classes.select("class_key", "rows", "first_doc"), "class_key")
    firsts = firsts.select("class_key", "root", "rows", F.col("first_doc.doc_id").alias("doc_id"))
    own = signed.select("class_key", "doc_id", "grams")
    same = (own["class_key"] == firsts["class_key"]) & own["doc_id"].eqNullSafe(firsts["doc_id"])
    sets = own.join(firsts, same).select(firsts["class_key"], "root", "rows", "grams").dropDuplicates(["class_key"])
    sets = materialize(sets, "jaccard-sets")

    sizes = sets.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.octet_length("grams") / 4).alias("g"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_CLASSES, F.col("g") / BLOCK_GRAMS)).cast("int")
    sizes = materialize(sizes.select("root", "g", blocks.alias("blocks")), "jaccard-sizes")
    total = sizes.filter("blocks = 1").agg(F.sum("g")).first()[0] or 0
    units = max(1, math.ceil(total / BLOCK_GRAMS))
    block = F.pmod(F.xxhash64("class_key"), F.col("blocks")).cast("int")
    placed = sets.join(sizes.drop("g"), "root").withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.withColumn("other", other)
    placed = placed.select(
        "class_key", "root", "rows", "grams", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(units))).otherwise(
            F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other"))
        ).alias("unit"),
    )

    def verify(table: pa.Table) -> pa.Table:
        keys, roots, weights, block, low, high = (
            table[c].to_numpy() for c in ("class_key", "root", "rows", "block", "low", "high")
        )
        raw = table["grams"].to_pylist()
        order = np.lexsort((high, low, roots))
        change = (np.diff(roots[order]) != 0) | (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        ends = [*(np.flatnonzero(change) + 1), len(order)]
        out, start = [], 0
        for stop in ends:
            own = order[start:stop]
            sets = [np.frombuffer(raw[i], np.uint32) for i in own]
            out.append(_verified(keys[own], weights[own], block[own], sets, similarity, low[own[0]] == high[own[0]]))
            start = stop
        return pa.table(dict(zip(("class_key", "links", "reaches"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    found = placed.groupBy("unit").applyInArrow(verify, "class_key bigint, links bigint, reaches bigint")
    found = materialize(found, "jaccard-links")
    roots = components(found.select(F.col("class_key").alias("a"), F.col("reaches").alias("b")))
    linked = found.groupBy("class_key").agg(F.sum("links").alias("links"))
    linked = linked.join(roots.withColumnRenamed("node", "class_key"), "class_key", "left")
    return classes.drop("bands"), linked.withColumn("root", F.coalesce("root", "class_key"))


def jaccard_join(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL
) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` (doc_id, text and any other columns): the signed rows, and per class class_key, rows, links (rows of
    other classes linked with it), first_doc (its smallest document) and component_first (that of its component)."""
    bands, rows = plan_bands(similarity, recall)
    signed = materialize(signatures(docs, words, bands, rows), "jaccard-signatures")
    classes, linked = similar_classes(signed, bands, similarity)
    known = classes.join(linked, "class_key", "left")
    known = known.select(
        "class_key", "rows", "first_doc", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "class_key").alias("root")
    )
    known = materialize(known, "jaccard-known")
    firsts = known.groupBy("root").agg(F.min("first_doc").alias("component_first"))
    return signed, materialize(known.join(firsts, "root").drop("root"), "jaccard-components")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, class_id (smallest doc_id with the same words), class_rows, n_links (other documents with a
    similarity of at least 0.8, copies included), component_id (smallest doc_id that links lead to)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    signed, classes = jaccard_join(docs)
    joined = signed.select("doc_id", "class_key").join(classes, "class_key", "left")
    alone = F.col("rows").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first_doc.doc_id")).alias("class_id"),
        F.coalesce("rows", F.lit(1)).alias("class_rows"),
        F.when(alone, F.lit(0)).otherwise(F.col("rows") - 1 + F.col("links")).alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_first.doc_id")).alias("component_id"),
    )


_WORDLESS = r"^[\x00-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F]*$"


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row of each component of linked documents: that of the smallest doc_id (nulls last), of repeated rows any one.
    Null texts and texts without words stay as they are. The columns are those of ``docs``."""
    spark, added = docs.sparkSession, ("_doc", "_null", "_text")
    once, often = (scratch_path(spark, f"jaccard-{name}") for name in ("once", "often"))
    with scratch_scope(spark):
        # from here on only the kept documents count: what led to them goes before the texts are shuffled
        signed, classes = jaccard_join(docs, **options)
        first = F.col("component_first")
        kept = classes.filter(F.col("first_doc") == first).select(
            "class_key", first["doc_id"].alias("_doc"), first["null"].alias("_null"), first["text_key"].alias("_text")
        )
        rows = signed.select("class_key", "doc_id", "text_key")
        same = (
            (rows["class_key"] == kept["class_key"])
            & (rows["text_key"] == kept["_text"])
            & rows["doc_id"].eqNullSafe(kept["_doc"])
        )
        counted = materialize(rows.join(kept, same).groupBy(*added).agg(F.count("*").alias("rows")), "jaccard-kept")
        one = materialize(counted.filter("rows = 1").drop("rows"), "", once)
        more = materialize(counted.filter("rows > 1").drop("rows"), "", often)
    keyed = set_aside(docs, added)
    keyed = keyed.withColumns({"_doc": F.col("doc_id"), "_null": F.col("doc_id").isNull(), "_text": F.xxhash64("text")})
    wordless = F.col("text").isNull() | F.col("text").rlike(_WORDLESS)

    def held(kept: DataFrame) -> DataFrame:
        same = (keyed["_text"] == kept["_text"]) & (keyed["_null"] == kept["_null"]) & keyed["_doc"].eqNullSafe(kept["_doc"])
        return keyed.filter(~wordless).join(kept, same, "left_semi")

    # only rows that repeat need a further shuffle
    found = held(one).unionByName(held(more).dropDuplicates([*added])).unionByName(keyed.filter(wordless))
    return put_back(found, docs, added)


QUERIES = {"op9_ngram_jaccard_join": op9_ngram_jaccard_join}
ORACLE: dict[str, str] = {}

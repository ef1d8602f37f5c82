"""Operator 1: documents that hold passages of a benchmark, found by spaced seeds.

A mask such as ``1101101`` is laid over the words at every place of a text; the words under ``1`` are hashed, the others
ignored, so a hit survives substitutions under ``0``. Hashes of the benchmark and of the documents are joined; around
each hit the two word sequences are compared along its diagonal, and a substitution-tolerant overlap is accepted if

* words equal on the diagonal make up ``item_share`` of the item, or
* a stretch of at least ``stretch_words`` words has at most one different word in five.

Masks are the lighter the shorter an item is, so that an overlap at the limit of acceptance is hit with odds of 0.99 and more
wherever its substitutions are, and always if every third to tenth word is replaced. Items of fewer than ``SHORTEST`` words have to be
there word for word. Items without words match nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.columns import put_back, set_aside
from pagetrail.llm.textcodes import _OF_PLACE, keep_columns, mix, slices, word_codes
from pagetrail.session import materialize, remove_scratch, scratch_path

SHORTEST = 8
#: Masks by the least number of words of the items they are for.
MASKS = (
    (SHORTEST, ("111", "1101", "1011", "10101", "11001", "10011", "100101", "1010001")),
    (12, ("1111", "11101", "11011", "110101", "101101", "1100101", "1001101", "10110001")),
    (25, ("11111", "111101", "111011", "1101101", "1011011", "11010101", "110010011", "1010110001")),
)
ITEM_SHARE = 0.6
STRETCH_WORDS = 13
#: Words of the benchmark that one scan of the documents compares with; a larger benchmark is scanned for in blocks, one
#: after the other. A word has up to eight seeds of 24 bytes.
BLOCK_WORDS = 250_000
_FILTER_BITS = 22
#: Pairs of words that are compared at once.
_PAIRS = 1 << 20

SPAN = "array<struct<item_id:bigint,first_word:bigint,last_word:bigint,equal_words:bigint>>"


def _mask_hashes(codes: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash of the masked words at every place where the mask fits into ``codes``."""
    n = len(codes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, number + 1, np.uint64)
    for k, i in enumerate(i for i, bit in enumerate(mask) if bit == "1"):
        total += codes[i : i + n] * _OF_PLACE[k]
    return mix(total)


class _Seeds(NamedTuple):
    """Sorted seed hashes of a block of items, and where each comes from."""

    ids: np.ndarray
    codes: np.ndarray
    offsets: np.ndarray
    masks: list[str]
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    filled: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str], masks: tuple[tuple[int, tuple[str, ...]], ...]) -> _Seeds:
        codes, offsets = word_codes(pa.array(texts, pa.string()))
        every: dict[str, int] = {}
        hashes, item, place = [], [], []
        for i, n in enumerate(np.diff(offsets).tolist()):
            own = codes[offsets[i] : offsets[i + 1]]
            fitting = [found for least, found in masks if least <= n]
            for mask in fitting[-1] if fitting else ("1" * n,) if n else ():
                found = _mask_hashes(own, mask, every.setdefault(mask, len(every)))
                hashes.append(found)
                item.append(np.full(len(found), i))
                place.append(np.arange(len(found)))
        if hashes:
            hashes, item, place = map(np.concatenate, (hashes, item, place))
        else:
            hashes, item, place = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        order = np.argsort(hashes, kind="stable")
        filled = np.zeros(1 << _FILTER_BITS, bool)
        filled[hashes >> np.uint64(64 - _FILTER_BITS)] = True
        return cls(np.asarray(ids), codes, offsets, list(every), hashes[order], item[order], place[order], filled)

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and diagonals (place in ``codes`` minus place in the item), each pair once."""
        found = []
        for k, mask in enumerate(self.masks):
            own = _mask_hashes(codes, mask, k)
            at = np.flatnonzero(self.filled[own >> np.uint64(64 - _FILTER_BITS)])
            first = np.searchsorted(self.hashes, own[at], "left")
            count = np.searchsorted(self.hashes, own[at], "right") - first
            at, first, count = at[count > 0], first[count > 0], count[count > 0]
            if not len(at):
                continue
            seed = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            found.append(np.stack([self.item[seed], np.repeat(at, count) - self.place[seed]]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        item, diagonal = np.concatenate(found, axis=1)
        wide = np.int64(len(codes) + len(self.codes) + 1)  # diagonals run from minus an item's words to the text's words
        item, diagonal = np.divmod(np.unique(item * wide + diagonal + len(self.codes)), wide)
        return item, diagonal - len(self.codes)

    def equal_words(self, codes: np.ndarray, item: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Equal words on each whole diagonal, whatever texts it crosses."""
        sizes = np.diff(self.offsets)[item]
        ends = np.cumsum(sizes)
        out = np.zeros(len(item), np.int64)
        start = 0
        while start < len(item):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _PAIRS, "right")))
            size = sizes[start:stop]
            first = np.cumsum(size) - size
            step = np.arange(size.sum()) - np.repeat(first, size)
            at = step + np.repeat(diagonal[start:stop], size)
            inside = (at >= 0) & (at < len(codes))
            same = inside & (codes[np.where(inside, at, 0)] == self.codes[step + np.repeat(self.offsets[item[start:stop]], size)])
            out[start:stop] = np.add.reduceat(same.astype(np.int64), first)
            start = stop
        return out


def _longest_stretch(equal: np.ndarray) -> tuple[int, int]:
    """The longest stretch that starts and ends with equal words and of which at most a fifth differs: start and end."""
    gain = np.concatenate([[0], np.cumsum(np.where(equal, 1, -4))])
    # the longest i < j with gain[i] <= gain[j]: the lowest prefix so far against the highest suffix
    low, high = np.minimum.accumulate(gain), np.maximum.accumulate(gain[::-1])[::-1]
    end = np.searchsorted(-high, -low, "right") - 1  # last j whose suffix still reaches low[i]
    i = int(np.argmax(end - np.arange(len(gain))))
    start, stop = int(np.argmin(gain[: i + 1])), int(end[i])
    inside = np.flatnonzero(equal[start:stop])
    return (start + int(inside[0]), start + int(inside[-1]) + 1) if len(inside) else (0, 0)


def _overlaps(seeds: _Seeds, codes: np.ndarray, offsets: np.ndarray, item_share: float, stretch_words: int) -> list[list]:
    """For each text the accepted overlaps, by place."""
    out: list[dict] = [{} for _ in range(len(offsets) - 1)]
    item, diagonal = seeds.hits(codes)
    if len(item):
        # what neither rule can accept goes before anything is looked at one by one
        least = np.minimum(np.ceil(item_share * np.diff(seeds.offsets)[item] - 1e-9), -(-4 * stretch_words // 5))
        promising = seeds.equal_words(codes, item, diagonal) >= least
        item, diagonal = item[promising], diagonal[promising]
    for i, d in zip(item.tolist(), diagonal.tolist(), strict=True):
        own = seeds.codes[seeds.offsets[i] : seeds.offsets[i + 1]]
        # the diagonal may cross texts that stand next to each other here; each has its own part of it
        low, high = max(d, 0), min(d + len(own), len(codes))
        text = int(np.searchsorted(offsets, low, "right")) - 1
        while low < high:
            stop = min(high, int(offsets[text + 1]))
            if stop > low:
                equal = codes[low:stop] == own[low - d : stop - d]
                total = int(equal.sum())
                if total >= item_share * len(own):
                    at = np.flatnonzero(equal)
                    a, b = int(at[0]), int(at[-1]) + 1
                else:
                    a, b = _longest_stretch(equal)
                    total = int(equal[a:b].sum())
                if total and (total >= item_share * len(own) or b - a >= stretch_words):
                    base = int(offsets[text])
                    span = (int(seeds.ids[i]), low - base + a, low - base + b - 1, total)
                    key = span[:2]
                    if key not in out[text] or out[text][key][3] < total:
                        out[text][key] = span
            low, text = max(low, stop), text + 1
    return [sorted(x.values()) for x in out]


def find_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[tuple[int, tuple[str, ...]], ...] = MASKS,
    item_share: float = ITEM_SHARE,
    stretch_words: int = STRETCH_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` (any columns, ``text`` among them) with ``overlaps``: accepted overlaps with ``benchmark`` (item_id, text).

    ``first_word`` and ``last_word`` count the words of the document from 0. Null and empty texts have no overlaps;
    repeated rows are repeated; an overlap with two equal items names both. Null item ids are taken as -1. A column
    named ``overlaps`` is replaced. The benchmark is read in blocks of about ``block_words`` words. The rows pass a block in one
    scan without a shuffle and are written before the next block, so that tasks hold one block at a time.
    """
    spark = docs.sparkSession
    docs = docs.drop("overlaps")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("bigint"), F.lit(-1)).alias("item_id"), "text").filter(
        F.length(F.trim("text")) > 0
    )
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-int(words) // block_words))
    held = docs.withColumn("overlaps", F.array().cast(SPAN))
    written, scanned = None, False
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        if rows:
            rows.sort(key=lambda r: (r.item_id, r.text))
            seeds = _Seeds.of([r.item_id for r in rows], [r.text for r in rows], masks)
            seeds = spark.sparkContext.broadcast(tuple(seeds))
            if scanned:
                path = scratch_path(spark, "overlaps")
                held = materialize(held, "overlaps", path)
                if written:
                    remove_scratch(spark, written)
                written = path
            held, scanned = _scan(held, seeds, item_share, stretch_words), True
    return held


def _scan(docs: DataFrame, seeds, item_share: float, stretch_words: int) -> DataFrame:
    names = [c for c in docs.columns if c != "overlaps"]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "first_word", "last_word", "equal_words")]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Seeds(*seeds.value)
        for batch in slices(batches):
            codes, offsets = word_codes(batch["text"])
            found = _overlaps(own, codes, offsets, item_share, stretch_words)
            before = batch["overlaps"].to_pylist()
            rows = [
                [*old, *({"item_id": a, "first_word": b, "last_word": c, "equal_words": d} for a, b, c, d in new)]
                for old, new in zip(before, found, strict=True)
            ]
            yield keep_columns(batch, names, {"overlaps": pa.array(rows, kind)})

    schema = T.StructType([docs.schema[c] for c in names] + [docs.schema["overlaps"]])
    return docs.select(*(F.col(f"`{c}`") for c in names), "overlaps").mapInArrow(scan, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without an accepted overlap, with the columns of ``docs``."""
    clean = find_overlaps(set_aside(docs, ("overlaps",)), benchmark, **options).filter(F.size("overlaps") == 0)
    return put_back(clean, docs, ("overlaps",))


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, contaminated, item_ids (sorted, each once), overlaps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    return found.select(
        "doc_id",
        (F.size("overlaps") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(F.col("overlaps.item_id"))).alias("item_ids"),
        "overlaps",
    )


QUERIES = {"op1_benchmark_decontamination": op1_benchmark_decontamination}
ORACLE: dict[str, str] = {}

"""Operator 12: document fingerprints by a randomised edit embedding.

A text is read by a walk: at each step the present character is put out, and a random bit that belongs to the step and the
character tells whether the walk goes on to the next one. All texts share these bits. Two walks that stand on equal characters
therefore move alike, and after an insertion or a deletion they find each other again, so a small edit distance becomes a small
Hamming distance of what they put out. A text of n characters takes about 2n steps; the random bits repeat every 4,096 steps.

The fingerprint is a sample of that: eight places a step, of which each block of 2^level keeps one, and of each kept place a bit
that is hashed from the place and the character there. The level follows from the length, so that about 512 to 1,024 bits are
kept, all of them for texts of up to 64 characters. The place that a block keeps is that of one of its two halves, so a fingerprint
can be brought to a higher level and compared with one of a longer text.

Likeness is the estimated share of equal places, 2 * (equal bits) / (bits) - 1 where both walks are, over the longer walk.
Near texts are found by bands of sampled bits and verified by their edit distance (``near_texts``).

Null texts are empty. Two empty fingerprints are equal. Equal texts have equal fingerprints. Repeated rows are rows like others;
rows with the same id are ordered by text, those without an id come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.textcodes import mix, slices
from pagetrail.session import materialize

#: Fingerprints have at most about so many bits, and a step of the walk so many places.
BITS, PLACES = 1024, 8
PERIOD = 4096
#: Characters fall into so many classes with random bits of their own.
CLASSES = 256
#: Texts that are walked side by side; fewer are walked one after the other.
ABREAST = 64
#: Bands and bits of a band: a pair of likeness 0.8 shares one with a probability of 0.99.
BANDS, BAND_BITS = 24, 16
SIMILARITY = 0.9
_REGION_BITS = 8


def _jumps() -> np.ndarray:
    """Steps that a walk spends on a character, by class of the character and step of its arrival."""
    go = np.random.default_rng(12).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
    go[:, -1] |= ~go.any(1)
    wait = np.zeros((CLASSES, PERIOD), np.int64)
    ahead = np.argmax(go, axis=1) + 1
    for step in range(PERIOD - 1, -1, -1):
        ahead = np.where(go[:, step], 1, ahead + 1)
        wait[:, step] = ahead
    return wait.ravel()


_WAIT = _jumps()
_WAIT_LIST = _WAIT.tolist()


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) if text else np.zeros(0, np.int64)


def walks(texts: list[np.ndarray], starts: np.ndarray) -> list[np.ndarray]:
    """For each text the steps at which its characters and its end are reached, if the first is at the given step."""
    order = np.argsort([-len(x) for x in texts], kind="stable")
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    ends = np.cumsum(lengths)
    offsets = ends - lengths
    flat = np.concatenate([texts[i] for i in order]) if len(order) else np.zeros(0, np.int64)
    rows = (mix(flat.astype(np.uint64)) & np.uint64(CLASSES - 1)).astype(np.int64) * PERIOD
    reached = np.empty(len(flat), np.int64)  # when a character is left
    now = starts[order].astype(np.int64)
    at, active = 0, int((lengths > 0).sum())
    while active >= ABREAST:
        stop = int(lengths[active - 1])  # the shortest one that is still walked
        place, step = offsets[:active] + at, now[:active]
        for _ in range(stop - at):
            step += _WAIT[rows[place] + (step & (PERIOD - 1))]
            reached[place] = step
            place += 1
        at = stop
        active = int((lengths > at).sum())
    for lane in range(active):
        step, out = int(now[lane]), []
        for row in rows[offsets[lane] + at : ends[lane]].tolist():
            step += _WAIT_LIST[row + (step & (PERIOD - 1))]
            out.append(step)
        reached[offsets[lane] + at : ends[lane]] = out
    result: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
    for lane, i in enumerate(order):
        result[i] = np.concatenate([starts[i : i + 1], reached[offsets[lane] : ends[lane]]])
    return result


def _half(level: int, block: np.ndarray) -> np.ndarray:
    """Which half of a block holds the place that it keeps."""
    return block * 2 + (mix(block.astype(np.uint64) + np.uint64(level << 48)) & np.uint64(1)).astype(np.int64)


def level_of(characters_: int) -> int:
    return max(0, (max(characters_, 1) - 1).bit_length() + (2 * PLACES).bit_length() - 1 - (BITS.bit_length() - 1))


class _Kept:
    """The places that the blocks of a level keep, as many as were asked for so far."""

    def __init__(self):
        self.of_level: dict[int, np.ndarray] = {}

    def __call__(self, level: int, blocks: int) -> np.ndarray:
        held = self.of_level.get(level, np.zeros(0, np.int64))
        if len(held) < blocks:
            held = np.arange(max(blocks, 2 * BITS))
            for step in range(level, 0, -1):
                held = _half(step, held)
            self.of_level[level] = held
        return held[:blocks]


_KEPT = _Kept()


def sketch(text: np.ndarray, steps: np.ndarray) -> tuple[int, np.ndarray]:
    """Level and bits of a text, given when its walk reaches its characters and its end."""
    level, end = level_of(len(text)), int(steps[-1]) * PLACES
    places = _KEPT(level, -(-end >> level)) if end else np.zeros(0, np.int64)
    places = places[: np.searchsorted(places, end)]
    there = text[np.searchsorted(steps, places // PLACES, "right") - 1] if end else places
    bits = mix(there.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(places.astype(np.uint64) + np.uint64(1)))
    return level, (bits >> np.uint64(40) & np.uint64(1)).astype(np.uint8)


def raised(level: int, bits: np.ndarray, to: int) -> np.ndarray:
    """The bits of a fingerprint of this level at a higher one."""
    while level < to:
        level += 1
        kept = _half(level, np.arange((len(bits) + 1) // 2))
        bits = bits[kept[kept < len(bits)]]
    return bits


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """0 to 1: the estimated share of the longer walk on which both put out the same characters."""
    level = max(a[0], b[0])
    x, y = raised(*a, level), raised(*b, level)
    both, most = min(len(x), len(y)), max(len(x), len(y))
    if not most:
        return 1.0
    return max(0, 2 * int((x[:both] == y[:both]).sum()) - both) / most


def written(level: int, bits: np.ndarray) -> str:
    return f"{level:02x}.{len(bits):x}.{np.packbits(bits).tobytes().hex()}"


def read(fingerprint: str) -> tuple[int, np.ndarray]:
    level, number, bits = fingerprint.split(".")
    return int(level, 16), np.unpackbits(np.frombuffer(bytes.fromhex(bits), np.uint8))[: int(number, 16)]


def bands(level: int, bits: np.ndarray, number: int = BANDS, size: int = BAND_BITS) -> list[str]:
    """Keys of a fingerprint; texts of similar length share a region of the walk, from which bits of each band are drawn."""
    if not len(bits):
        return ["empty"]
    keys = []
    top = level + len(bits).bit_length() - 1
    for region in (top, top - 1):
        at = max(0, region - _REGION_BITS)
        if at < level or region < 0:
            continue
        own = raised(level, bits, at)[: 1 << (region - at)]
        if not len(own):
            continue
        drawn = np.random.default_rng([region, len(own), number, size]).integers(0, len(own), (number, size))
        keys += [f"{region}.{i}.{row.tobytes().hex()}" for i, row in enumerate(np.packbits(own[drawn], axis=1))]
    return keys


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint, bands for each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [characters(x) for x in pc.fill_null(batch["text"], "").to_pylist()]
            found = [sketch(x, steps) for x, steps in zip(texts, walks(texts, np.zeros(len(texts), np.int64)), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(x) for x in texts], pa.int64()), pa.array([written(*x) for x in found], pa.string()),
                 pa.array([bands(*x) for x in found], pa.list_(pa.string()))],
                names=["doc_id", "n_chars", "fingerprint", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_chars bigint, fingerprint string, bands array<string>")


def near_texts(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, distance) of different texts that share a band and whose edit distance is at most 1 - ``similarity`` of the longer
    one, between the smallest ids of equal texts, a < b; and the members (doc_id, class_id) of each such class.

    Rows without an id take no part. A pair that meets in several bands is compared once, and only ids meet in them; texts are
    joined to the distinct pairs.
    """
    named = docs.filter("doc_id IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.sha2("text", 256).alias("digest")
    members = materialize(named.select("doc_id", digest), "walk-digests")
    heads = materialize(members.groupBy("digest").agg(F.min("doc_id").alias("class_id")), "walk-classes")
    members = members.join(heads, "digest").select("doc_id", "class_id")
    firsts = heads.select(F.col("class_id").alias("doc_id"), "digest")
    texts = named.withColumn("digest", digest).join(firsts, ["doc_id", "digest"]).groupBy("doc_id").agg(F.first("text").alias("text"))
    texts = materialize(texts, "walk-texts")
    keys = materialize(fingerprints(texts).select("doc_id", F.explode(F.array_distinct("bands")).alias("key")), "walk-bands")
    pairs = keys.select("key", F.col("doc_id").alias("a")).join(keys.select("key", F.col("doc_id").alias("b")), "key").filter("a < b")
    pairs = materialize(pairs.select("a", "b").distinct(), "walk-pairs")
    held = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
    held = held.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
    most = F.floor(F.greatest(F.length("x"), F.length("y")) * (1 - similarity) + 1e-9).cast("int")
    apart = F.call_function("levenshtein", F.col("x"), F.col("y"), most)
    return held.select("a", "b", apart.cast("bigint").alias("distance")).filter("distance >= 0"), members


def _dealt(docs: DataFrame) -> DataFrame:
    """part, ahead, doc_id, text: parts are ranges of ids, the largest ids first. The first row of a part is also the last of the
    part before it, where it is ``ahead``; that of the first part closes the last one."""
    spark = docs.sparkSession
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / wanted for i in range(1, wanted)]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, shares)), F.lit(10 * wanted)).alias("at")).first()["at"]
    bounds = np.array(sorted(set(found or [])), np.int64)

    def parts(ids: pa.Array) -> np.ndarray:
        known = pc.fill_null(ids, 0).to_numpy()
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(bounds) + 1, len(bounds) - np.searchsorted(bounds, known, "left"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"part": pa.array(parts(batch["doc_id"])), "doc_id": batch["doc_id"]})

    firsts = docs.select("doc_id").mapInArrow(number, "part bigint, doc_id bigint").groupBy("part").agg(F.max("doc_id"))
    heads = sorted(tuple(row) for row in firsts.collect())  # a row for each part
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(list(before), pa.int64())
        for batch in batches:
            own = parts(batch["doc_id"])
            head = pc.index_in(batch["doc_id"], known)
            again = np.flatnonzero(head.is_valid().to_numpy(zero_copy_only=False))
            earlier = np.array([before[x] for x in batch["doc_id"].take(pa.array(again)).to_pylist()], np.int64)
            rows = pa.array(np.concatenate([np.arange(len(own)), again]))
            yield pa.record_batch(
                {
                    "part": pa.array(np.concatenate([own, earlier])),
                    "ahead": pa.array(np.arange(len(rows)) >= len(own)),
                    "doc_id": batch["doc_id"].take(rows),
                    "text": batch["text"].take(rows),
                }
            )

    rows = docs.mapInArrow(deal, "part bigint, ahead boolean, doc_id bigint, text string").repartition(wanted, "part")
    return rows.sortWithinPartitions("part", "ahead", F.col("doc_id").desc_nulls_last(), "text")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and banded for each row of ``docs``.

    The edited text has its last third replaced by as many characters of the next document, descending by doc_id. ``banded``
    tells whether text and edited text share a band, so that a search would compare them.
    """

    def compare(rows: list[tuple[int, bool, int | None, str]]) -> pa.RecordBatch:
        texts = [characters(row[3]) for row in rows]
        steps = walks(texts, np.zeros(len(texts), np.int64))
        found = [sketch(text, step) for text, step in zip(texts, steps, strict=True)]
        own = [i for i, row in enumerate(rows[:-1]) if not row[1]]
        thirds = [len(texts[i]) // 3 for i in own]
        stay = [len(texts[i]) - third for i, third in zip(own, thirds, strict=True)]
        tails = [texts[i + 1][:third] for i, third in zip(own, thirds, strict=True)]
        # up to the edit both walks are the same
        after = walks(tails, np.array([steps[i][n] for i, n in zip(own, stay, strict=True)], np.int64))
        out: dict[str, list] = {name: [] for name, _ in _COLUMNS}
        for i, n, third, tail, late in zip(own, stay, thirds, tails, after, strict=True):
            edited = sketch(np.concatenate([texts[i][:n], tail]), np.concatenate([steps[i][:n], late]))
            text = (rows[i][3][:n] + rows[i + 1][3][:third]).encode("utf-8", "surrogatepass")
            shared = not set(bands(*found[i])).isdisjoint(bands(*edited))
            values = (
                rows[i][2], len(texts[i]), hashlib.sha256(text).hexdigest(), written(*found[i]), written(*edited),
                likeness(found[i], edited), likeness(found[i], found[i + 1]), shared,
            )
            for (name, _), value in zip(_COLUMNS, values, strict=True):
                out[name].append(value)
        return pa.record_batch({name: pa.array(out[name], kind) for name, kind in _COLUMNS})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple] = []
        for batch in slices(batches):
            columns = (batch["part"], batch["ahead"], batch["doc_id"], pc.fill_null(batch["text"], ""))
            rows = last + list(zip(*(column.to_pylist() for column in columns), strict=True))
            yield compare(rows)
            last = rows[-1:]

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, banded boolean"
    return _dealt(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")).mapInArrow(run, schema)


_COLUMNS = (
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("banded", pa.bool_()),
)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how near it is to that and to the next document."""
    return edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op12_fingerprints": op12_fingerprints}
ORACLE: dict[str, str] = {}

"""Operator 5: language of a text by sparse multinomial logistic regression on TF-IDF character n-grams.

* Features: hashed n-grams of 1 to 3 characters of the lower-cased text, in which every run of other characters than letters
  counts as one space; value (1 + ln count) * idf, scaled to length 1. Document frequencies are counted over all
  documents with a label.
* Training: follow-the-regularised-leader with L1 and L2 penalties, on a bounded sample (``per_language`` rows of each
  language at most, in expectation). Rows are dealt into a fixed number of shards by hash; each shard trains its own
  model, the weights are averaged.
* Calibration: one temperature that minimises the log loss of sampled rows that were kept out of training; a share ``DOUBT``
  of each label is spread over all languages, so that rows without any mistake do not ask for certainty.

* Rejection (``keep_recognised``): texts whose calibrated score is nearer to what guessing gives than to the lowest thousandth of the scores
  of rows that were kept out of training. Letters that are no text, and languages that were never learned, score near a guess.

Null texts and texts without letters are ``und`` with score 0. Without any labelled row every text is ``und``. Ties go to
the alphabetically first language. Extra columns are kept; columns named ``lang_pred`` or ``score`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.columns import put_back, set_aside
from pagetrail.llm.textcodes import SLICE_BYTES, keep_columns, slices
from pagetrail.session import materialize

BITS = 15
ORDERS = 3
PER_LANGUAGE = 4000
SHARDS = 8
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 0.05, 0.002, 0.001
CALIBRATION_SHARE = 0.2
DOUBT = 0.001
#: Share of the rows kept out of training that may score lower than what the rejection takes as low for a text.
LOW_SHARE = 0.001
TEMPERATURES = tuple(2 ** (i / 4) for i in range(-24, 13))
UNDETERMINED = "und"
_SIZE = 1 << BITS
_FACTORS = np.array([2654435761, 2246822519, 3266489917], np.uint32)


class Model(NamedTuple):
    languages: list[str]
    idf: np.ndarray  # per feature
    weights: np.ndarray  # features plus a constant, by language
    temperature: float
    least: float = 0.0  # score below which a text counts as not recognised


_KEPT: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Whether a code point is a letter, worked out once per process."""
    if not _KEPT:
        _KEPT["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _KEPT["letters"]


def _normal(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters kept, each run of other characters one space; offsets follow."""
    letter = _letters()[points]
    first = np.zeros(len(points), bool)
    first[offsets[:-1][offsets[:-1] < len(points)]] = True
    before = np.empty_like(letter)
    before[:1] = True
    before[1:] = letter[:-1]
    keep = letter | before | first
    kept = np.zeros(len(points) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return np.where(letter, points, 32)[keep].astype(np.uint32), kept[offsets]


def _grams(points: np.ndarray, order: int) -> np.ndarray:
    total = np.full(len(points) - order + 1, order * 0x9E3779B1 % (1 << 32), np.uint32)
    for i in range(order):
        total += points[i : i + len(total)] * _FACTORS[i]
    total = (total ^ (total >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (total >> np.uint32(32 - BITS)).astype(np.int32)


def counts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """For each text its features and how often each occurs; None without letters."""
    texts = pc.utf8_lower(pc.fill_null(texts, ""))
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(texts) == 1 and lengths[0] > 2 * SLICE_BYTES:
        yield _long_counts(texts[0].as_py())
        return
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    raw = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32)
    points, offsets = _normal(raw, offsets)
    hashed = [_grams(points, n) if len(points) >= n else np.zeros(0, np.int32) for n in range(1, ORDERS + 1)]
    for start, stop in zip(offsets[:-1], offsets[1:], strict=True):
        if stop - start == 0 or (stop - start == 1 and points[start] == 32):
            yield None
            continue
        own = np.concatenate([h[start : max(start, stop - n)] for n, h in enumerate(hashed)])
        if len(own) < _SIZE // 16:
            yield np.unique(own, return_counts=True)
        else:
            times = np.bincount(own, minlength=_SIZE)
            at = np.flatnonzero(times)
            yield at, times[at]


def _long_counts(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """As ``counts`` for one text, holding one piece of it at a time."""
    times, tail, seen = np.zeros(_SIZE, np.int64), np.zeros(0, np.uint32), False
    for start in range(0, len(text), SLICE_BYTES):
        raw = np.frombuffer(text[start : start + SLICE_BYTES].encode("utf-32-le"), np.uint32)
        points, _ = _normal(raw, np.array([0, len(raw)]))
        seen = seen or bool((points != 32).any())
        if len(tail) and len(points) and tail[-1] == points[0] == 32:
            points = points[1:]
        for n in range(1, ORDERS + 1):
            run = np.concatenate([tail[len(tail) - min(n - 1, len(tail)) :], points])
            if len(run) >= n:
                times += np.bincount(_grams(run, n), minlength=_SIZE)
        tail = np.concatenate([tail, points])[-(ORDERS - 1) :]
    at = np.flatnonzero(times)
    return (at, times[at]) if seen else None


def _vector(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(found[1])) * idf[found[0]]
    return value / max(np.sqrt((value * value).sum()), 1e-12)


def _document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(_SIZE, np.int64), 0
        for batch in slices(batches):
            for found in counts(batch["text"]):
                if found is not None:
                    total[found[0]] += 1
                    rows += 1
        at = np.flatnonzero(total)
        yield pa.record_batch({"feature": pa.array([*at, -1], pa.int32()), "n": pa.array([*total[at], rows], pa.int64())})

    summed = docs.select("text").mapInArrow(count, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    table = summed.toArrow()  # one row per feature
    feature, n = table["feature"].to_numpy(), table["n"].to_numpy()
    out = np.zeros(_SIZE, np.int64)
    out[feature[feature >= 0]] = n[feature >= 0]
    return int(n[feature < 0].sum()), out


def _features(sample: DataFrame, idf: np.ndarray) -> DataFrame:
    """label, share, shard, places and values of each sampled text with letters."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = list(counts(batch["text"]))
            at = [i for i, x in enumerate(found) if x is not None]
            yield pa.record_batch(
                {
                    "label": batch["label"].take(pa.array(at, pa.int64())),
                    "share": batch["share"].take(pa.array(at, pa.int64())),
                    "places": pa.array([found[i][0].astype(np.int32) for i in at], pa.list_(pa.int32())),
                    "values": pa.array([_vector(found[i], idf).astype(np.float32) for i in at], pa.list_(pa.float32())),
                }
            )

    return sample.select("text", "label", "share").mapInArrow(
        vectors, "label int, share double, places array<int>, values array<float>"
    )


def _rows(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in table.to_batches():
        places, values = batch["places"], batch["values"]
        at, offsets = places.flatten().to_numpy(), places.offsets.to_numpy() - places.offsets[0].as_py()
        value = values.flatten().to_numpy()
        for i, label in enumerate(batch["label"].to_numpy()):
            yield label, at[offsets[i] : offsets[i + 1]], value[offsets[i] : offsets[i + 1]].astype(np.float64)


def _softmax(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def _trained(rows: list, classes: int, seed: int) -> np.ndarray:
    """FTRL weights after some passes over the rows of a shard."""
    z, n = np.zeros((_SIZE + 1, classes)), np.zeros((_SIZE + 1, classes))

    def weights(z, n):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            label, at, value = rows[i]
            at, value = np.append(at, _SIZE), np.append(value, 0.1)
            w = weights(z[at], n[at])
            miss = _softmax(value @ w)
            miss[label] -= 1
            g = value[:, None] * miss
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / ALPHA * w
            n[at] = more
    return weights(z, n)


def fit(
    docs: DataFrame,
    label: str = "lang",
    learn_from: Column | None = None,
    per_language: int = PER_LANGUAGE,
) -> Model:
    """A model from ``text`` and ``label`` of the rows for which ``learn_from`` is true and the label is not null."""
    rows = docs.filter(F.col(label).isNotNull() & F.length("text").cast("boolean"))
    if learn_from is not None:
        rows = rows.filter(learn_from)
    sizes = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(_SIZE), np.zeros((_SIZE + 1, 0)), 1.0)
    total, with_feature = _document_frequencies(rows)
    idf = np.log((1 + total) / (1 + with_feature)) + 1

    chance = F.lit(0.0)
    number = F.lit(0)
    for i, name in enumerate(languages):
        chance = F.when(F.col(label) == name, F.lit(min(1.0, per_language / sizes[name]))).otherwise(chance)
        number = F.when(F.col(label) == name, F.lit(i)).otherwise(number)
    whole = float(1 << 40)
    key = [F.col(f"`{c}`") for c in docs.columns]

    def draw(salt):
        return F.pmod(F.xxhash64(F.lit(salt), *key), F.lit(1 << 40)) / whole

    sample = rows.filter(draw(1) < chance).select("text", number.alias("label"), draw(2).alias("share"))
    features = materialize(_features(sample, idf), "language-features")
    classes = len(languages)

    def train(key: tuple, table: pa.Table) -> pa.Table:
        own = list(_rows(table.combine_chunks()))
        w = _trained(own, classes, seed=int(key[0].as_py()))
        at = np.flatnonzero((w != 0).any(axis=1))
        return pa.table(
            {
                "feature": pa.array(np.repeat(at, classes), pa.int32()),
                "class": pa.array(np.tile(np.arange(classes), len(at)), pa.int32()),
                "weight": pa.array(w[at].ravel(), pa.float64()),
            }
        )

    shard = F.pmod(F.floor(F.col("share") * 1e6), F.lit(SHARDS)).cast("int")
    learning = features.filter(F.col("share") >= CALIBRATION_SHARE).withColumn("shard", shard)
    shards = max(1, learning.select("shard").distinct().count())
    averaged = (
        learning.groupBy("shard")
        .applyInArrow(train, "feature int, class int, weight double")
        .groupBy("feature", "class")
        .agg((F.sum("weight") / shards).alias("weight"))
        .toArrow()  # at most a row per feature and language
    )
    weights = np.zeros((_SIZE + 1, classes))
    weights[averaged["feature"].to_numpy(), averaged["class"].to_numpy()] = averaged["weight"].to_numpy()

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss = np.zeros(len(TEMPERATURES))
        for batch in batches:
            for label, at, value in _rows(pa.Table.from_batches([batch])):
                scores = value @ weights[at] + 0.1 * weights[_SIZE]
                wanted = np.full(classes, DOUBT / classes)
                wanted[label] += 1 - DOUBT
                for i, t in enumerate(TEMPERATURES):
                    logs = scores / t - scores.max() / t
                    loss[i] -= wanted @ (logs - np.log(np.exp(logs).sum()))
        yield pa.record_batch({"i": pa.array(range(len(loss)), pa.int32()), "loss": loss})

    kept = features.filter(F.col("share") < CALIBRATION_SHARE)
    summed = kept.mapInArrow(losses, "i int, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).collect()
    best = min(summed, key=lambda r: (r.loss, abs(TEMPERATURES[r.i] - 1)), default=None)
    temperature = 1.0 if best is None or best.loss == 0 else TEMPERATURES[best.i]

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(pa.Table.from_batches([batch]))
            found = [float(_softmax((value @ weights[at] + 0.1 * weights[_SIZE]) / temperature).max()) for _, at, value in rows]
            yield pa.record_batch({"score": pa.array(found, pa.float64())})

    low = F.percentile_approx("score", F.lit(LOW_SHARE), F.lit(100_000)).alias("low")
    low = kept.mapInArrow(scores, "score double").agg(low).first()["low"]
    return Model(languages, idf, weights, temperature, 0.0 if low is None else (1 / classes + low) / 2)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability of that language."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))  # features times languages, whatever the input

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, idf, weights, temperature, _ = sent.value
        for batch in slices(batches):
            lang, score = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            for i, found in enumerate(counts(batch["text"]) if languages else ()):
                if found is not None:
                    p = _softmax((_vector(found, idf) @ weights[found[0]] + 0.1 * weights[_SIZE]) / temperature)
                    best = int(p.argmax())
                    lang[i], score[i] = languages[best], min(float(p[best]), 1.0)
            yield keep_columns(batch, names, {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score)})

    schema = T.StructType(
        [docs.schema[c] for c in names] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return docs.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(classify, schema)


def keep_recognised(docs: DataFrame, label: str = "lang", learn_from: Column | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is recognised as one of the learned languages, with the columns of ``docs``. Where no row is
    labelled, those with letters."""
    model = fit(docs, label, learn_from)
    if not model.languages:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    added = ("lang_pred", "score")
    found = predict(set_aside(docs, added), model)
    found = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= model.least))
    return put_back(found, docs, added)


def held_out() -> Column:
    """True for the quarter of documents that is never learned from; null ids belong to it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs, learn_from=~held_out())
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


QUERIES = {"op5_language_id": op5_language_id}
ORACLE: dict[str, str] = {}

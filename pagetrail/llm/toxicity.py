"""Operator 2: toxicity of a text by a factorization machine over hashed terms.

Terms of a text are its words, the beginnings of its words (insults are inflected and compounded) and its length class, each
a 64-bit hash; x_i is log2(1 + occurrences), and 1 for the length class. The score is the logistic function of
``w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j``: the pairwise part learns combinations that a sum of weights
misses, such as two terms together or a few occurrences in a short rather than a long text.

* Terms: those in at least ``min_documents`` sampled rows whose frequency differs between the labels (likelihood ratio of
  at least ``min_ratio``).
* Training: AdaGrad on a bounded sample (``sample_rows`` rows in expectation). Rows are dealt into a fixed number of shards
  by hash; in each round every shard goes on from the shared parameters, and the results are averaged, weighted by the
  rows in which a term occurs.

Null and empty texts are scored by their length class alone. Without labelled rows every score is 0. Columns named
``score`` or ``predicted`` are replaced, other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.textcodes import keep_columns, slices, word_codes
from pagetrail.session import materialize

SAMPLE_ROWS = 16_000
MIN_DOCUMENTS = 5
MIN_RATIO = 10.0
#: Lengths in bytes of the beginnings of words.
BEGINNINGS = (4, 5, 6, 7)
FACTORS = 4
SHARDS = 8
ROUNDS = 4
RATE = 0.5
#: Pull of the factors of each term towards 0 at every row that holds it.
DECAY = 0.001
_START = 0.05
_LENGTHS = 48
_FILTER_BITS = 20


class Model(NamedTuple):
    terms: np.ndarray  # sorted hashes
    constant: float
    weights: np.ndarray  # of the terms, then of the length classes
    factors: np.ndarray


def _all_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words and beginnings, the text of each, and the number of words of each text."""
    codes, offsets, *beginnings = word_codes(texts, BEGINNINGS)
    words = np.diff(offsets)
    text = np.repeat(np.arange(len(words)), words)
    every = np.concatenate([codes, *beginnings])
    return every, np.tile(text, 1 + len(BEGINNINGS)), words


def _vectors(texts: pa.Array, terms: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and value of each known term, by text. ``held`` says which leading bits the terms have."""
    codes, text, words = _all_terms(texts)
    keep = held[codes >> np.uint64(64 - _FILTER_BITS)]
    codes, text = codes[keep], text[keep]
    at = np.minimum(np.searchsorted(terms, codes), max(len(terms) - 1, 0))
    same = terms[at] == codes if len(terms) else np.zeros(0, bool)
    width = len(terms) + _LENGTHS
    found, times = np.unique(text[same] * width + at[same], return_counts=True)
    length = np.arange(len(words)) * width + len(terms) + np.log2(words + 1).astype(np.int64)
    key = np.concatenate([found, length])
    value = np.concatenate([np.log2(1 + times), np.ones(len(length))])
    order = np.argsort(key, kind="stable")
    return key[order] // width, key[order] % width, value[order]


def _filter(terms: np.ndarray) -> np.ndarray:
    held = np.zeros(1 << _FILTER_BITS, bool)
    held[terms >> np.uint64(64 - _FILTER_BITS)] = True
    return held


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _scores(texts: pa.Array, model: Model, held: np.ndarray) -> np.ndarray:
    text, at, x = _vectors(texts, model.terms, held)
    n = len(texts)
    raw = model.constant + np.bincount(text, model.weights[at] * x, minlength=n)
    for f in range(model.factors.shape[1]):
        part = model.factors[at, f] * x
        raw += 0.5 * (np.bincount(text, part, minlength=n) ** 2 - np.bincount(text, part * part, minlength=n))
    return _logistic(raw)


def _passed(rows: list, start: tuple, seed: int) -> tuple[float, np.ndarray, np.ndarray]:
    """One pass over the rows of a shard from the shared parameters."""
    w0, w, v = start[0], start[1].copy(), start[2].copy()
    g0, gw, gv = 1.0, np.ones(len(w)), np.ones(len(w))
    for i in np.random.default_rng(seed).permutation(len(rows)):
        label, at, x = rows[i]
        own = v[at] * x[:, None]
        total = own.sum(axis=0)
        raw = w0 + (w[at] * x).sum() + 0.5 * float((total * total).sum() - (own * own).sum())
        miss = float(_logistic(raw)) - label
        g0 += miss * miss
        w0 -= 0.1 * miss / np.sqrt(g0)
        step = miss * x
        gw[at] += step * step
        w[at] -= RATE * step / np.sqrt(gw[at])
        step = miss * x[:, None] * (total - own) + DECAY * v[at]
        gv[at] += (step * step).mean(axis=1)
        v[at] -= RATE * step / np.sqrt(gv[at])[:, None]
    return w0, w, v


def _trainer(shared, number: int):
    """The round's work on one shard: parameters of the terms it holds, and of the constant as term -1."""

    def train(key: tuple, table: pa.Table) -> pa.Table:
        start = shared.value
        rows = [
            (label, np.asarray(at), np.asarray(x))
            for label, at, x in zip(*(table[c].to_numpy() for c in ("label", "places", "values")), strict=True)
        ]
        w0, w, v = _passed(rows, start, seed=1000 * number + int(key[0].as_py()))
        seen = np.bincount(np.concatenate([at for _, at, _ in rows]), minlength=len(w))
        at = np.flatnonzero(seen)
        parts = {"term": pa.array([*at, -1], pa.int32()), "n": [*seen[at].astype(float), float(len(rows))]}
        parts |= {"w": [*w[at], w0]} | {f"v{f}": [*v[at, f], 0.0] for f in range(FACTORS)}
        return pa.table(parts)

    return train


def _terms(sample: DataFrame, rows: int, toxic: int, min_documents: int, min_ratio: float) -> np.ndarray:
    """Sorted hashes of the terms that tell the labels apart."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=4 << 20):
            codes, text, _ = _all_terms(batch["text"])
            order = np.lexsort((text, codes))
            codes, text = codes[order], text[order]
            new = codes != 0
            new[1:] &= (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])
            codes, label = codes[new], batch["label"].to_numpy()[text[new]]
            first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
            both = [np.add.reduceat(x, first) if len(first) else first for x in (np.ones(len(codes), np.int64), label)]
            yield pa.record_batch(
                {"code": codes[first].view(np.int64), "n": pa.array(both[0], pa.int64()), "t": pa.array(both[1], pa.int64())}
            )

    summed = sample.mapInArrow(count, "code bigint, n bigint, t bigint").groupBy("code").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))

    def part(seen, of, total):
        return F.when(seen > 0, seen * F.log(seen * total / of)).otherwise(0.0)

    n, t, all_rows, all_toxic = F.col("n"), F.col("t"), F.lit(float(rows)), F.lit(float(toxic))
    ratio = 2 * (
        part(t, n * all_toxic, all_rows)
        + part(n - t, n * (all_rows - all_toxic), all_rows)
        + part(all_toxic - t, (all_rows - n) * all_toxic, all_rows)
        + part(all_rows - all_toxic - n + t, (all_rows - n) * (all_rows - all_toxic), all_rows)
    )
    chosen = summed.filter((n >= min_documents) & (ratio >= min_ratio)).select("code").toArrow()
    return np.sort(chosen["code"].to_numpy().view(np.uint64))


def _drawn(key: Column, rows: int, wanted: int) -> Column:
    """True for about ``wanted`` of so many rows, chosen by a hash."""
    whole = 1 << 40
    return F.pmod(key, F.lit(whole)) / float(whole) < min(1.0, wanted / max(rows, 1))


def fit(
    rows: DataFrame,
    label: str = "toxic",
    learn_from: Column | None = None,
    sample_rows: int = SAMPLE_ROWS,
    min_documents: int = MIN_DOCUMENTS,
    min_ratio: float = MIN_RATIO,
    rounds: int = ROUNDS,
) -> Model:
    """A model from ``text`` and the 0/1 column ``label`` of rows for which ``learn_from`` is true and the label is set."""
    known = rows.filter(F.col(label).isNotNull() & F.col("text").isNotNull())
    if learn_from is not None:
        known = known.filter(learn_from)
    key = F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns))
    known = known.select("text", F.col(label).cast("bigint").alias("label"), key.alias("key"))
    sample = materialize(known.filter(_drawn(F.col("key"), known.count(), sample_rows)), "toxicity-sample")
    number, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not number:
        return Model(np.zeros(0, np.uint64), -60.0, np.zeros(_LENGTHS), np.zeros((_LENGTHS, FACTORS)))
    terms = _terms(sample.select("text", "label"), number, toxic, min_documents, min_ratio)
    held = _filter(terms)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            text, at, x = _vectors(batch["text"], terms, held)
            ends = pa.array(np.searchsorted(text, np.arange(batch.num_rows + 1)), pa.int32())
            added = {
                "places": pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())),
                "values": pa.ListArray.from_arrays(ends, pa.array(x, pa.float64())),
            }
            yield keep_columns(batch, ["label", "key"], added)

    schema = "label bigint, key bigint, places array<int>, values array<double>"
    vectors = materialize(sample.mapInArrow(features, schema), "toxicity-features")
    dealt = vectors.withColumn("shard", F.pmod(F.shiftright("key", 40), F.lit(SHARDS)).cast("int")).drop("key")

    width = len(terms) + _LENGTHS
    start = np.modf(np.arange(1, width * FACTORS + 1) * 0.6180339887498949)[0].reshape(width, FACTORS)
    odds = np.clip(toxic / number, 1e-3, 1 - 1e-3)
    state = (float(np.log(odds / (1 - odds))), np.zeros(width), (start - 0.5) * 2 * _START)
    names = [f"v{f}" for f in range(FACTORS)]
    sums = [(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in ("w", *names)]
    schema = "term int, n double, w double, " + ", ".join(f"{n} double" for n in names)
    for i in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(state)  # bounded by the sample
        table = dealt.groupBy("shard").applyInArrow(_trainer(shared, i), schema).groupBy("term").agg(*sums).toArrow()
        term, weight = table["term"].to_numpy(), table["w"].to_numpy()
        w, v = state[1].copy(), state[2].copy()
        w[term[term >= 0]] = weight[term >= 0]
        v[term[term >= 0]] = np.stack([table[n].to_numpy() for n in names], axis=1)[term >= 0]
        state = (float(weight[term < 0][0]), w, v)
    return Model(terms, *state)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 if the score is at least 0.5)."""
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))  # bounded by the sample

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        held = _filter(own.terms)
        for batch in slices(batches):
            found = _scores(batch["text"], own, held)
            added = {"score": pa.array(found, pa.float64()), "predicted": pa.array(found >= 0.5).cast(pa.int32())}
            yield keep_columns(batch, names, added)

    schema = T.StructType(
        [docs.schema[c] for c in names] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    )
    return docs.select(*(F.col(f"`{c}`") for c in names)).mapInArrow(score, schema)


def held_out() -> Column:
    """True for the fifth of documents that is never learned from; null ids belong to it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. A document labelled twice counts as toxic if one label says so."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(F.col("toxic").isNotNull())
    labels = labels.filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # the sample is drawn from the labels, so that texts meet a bounded number of rows and are not shuffled
    sample = materialize(labels.filter(_drawn(F.xxhash64("doc_id"), labels.count(), SAMPLE_ROWS)), "toxicity-labels")
    model = fit(docs.join(F.broadcast(sample), "doc_id").select("text", "toxic", "doc_id"))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLE: dict[str, str] = {}

"""Operator 13: vectors as short codes, one codebook per part of the vector.

Vectors become integers and are cut into equal parts. Each part position has a codebook, fitted by rounds of exact k-means and
then used for the codes. All arithmetic is on integers, so results don't depend on how rows are dealt out.

Most distances to entries needn't be computed, because each part of a vector keeps two bounds with the round they are of: how
far its entry was (upper), and how far the second nearest was (lower). All codebooks so far are retained. In a later round the
upper bound grows by the distance between its entry then and now, the lower one shrinks by the largest such distance of
any other entry. These are norms of the sum of an entry's moves since the bound's own round, which are never more
than the sum of the norms that bounds drifting from round to round add up. A part whose bounds overlap gets its distance
to its entry computed, and if they still overlap, those to all entries.

Vectors that are null, empty or hold null or non-finite components get no row. Neither do those with a component of 16,384
and more in size, whose sums would leave 64 bits, nor those with another number of components than the vector of the smallest
id. Vectors whose components don't divide into parts are filled with zeros. Repeated rows and ids are rows like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.session import materialize, remove_scratch, scratch_path

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Components from this size on aren't coded.
LARGEST = 16_384
#: Rows that are compared with a codebook at once.
ROWS = 4096
#: Bounds that are closer than this share of them count as overlapping, which covers what rounding may change.
SLACK = 1e-9
_STATE = "vector array<int>, entry array<int>, upper array<double>, upper_round array<int>, lower array<double>, lower_round array<int>, scans int"


@dataclass
class Codebooks:
    """``history[t][part]`` has the entries that round ``t`` assigns to, an integer row each; the last are the final ones."""

    history: list[np.ndarray]

    @property
    def final(self) -> np.ndarray:
        return self.history[-1]

    def digest(self) -> str:
        """SHA-256 of all final components in decimal, by part, entry and place, with commas between them."""
        return hashlib.sha256(",".join(map(str, self.final.ravel().tolist())).encode()).hexdigest()


def _kept(vectors: DataFrame, parts: int) -> DataFrame:
    """The rows that get a code, their vectors as integers."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST))
    rows = vectors.filter(v.isNotNull() & (F.size(v) > 0)).filter(F.coalesce(fine, F.lit(False)))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last()).select(F.size(v)).first()
    size = first[0] if first else parts
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    fill = F.array_repeat(F.lit(0), -size % parts)
    return rows.filter(F.size(v) == size).withColumn("vector", F.concat(whole, fill)).drop("embedding")


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))


def _squares(vectors: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all vectors to all entries, exact."""
    most = max(np.abs(vectors).max(initial=0), np.abs(book).max(initial=0))
    kind = np.float64 if 4 * int(most) ** 2 * book.shape[1] < 1 << 53 else np.int64
    x, c = vectors.astype(kind), book.astype(kind)
    return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)


class _Round:
    """Assigns vectors of one part to the newest codebook, given all codebooks of this part so far."""

    def __init__(self, books: np.ndarray):
        self.now, self.book = len(books) - 1, books[-1]
        self.moved = np.sqrt(((books[-1] - books).astype(np.float64) ** 2).sum(2))  # by round of the bound, and entry
        order = np.argsort(self.moved, axis=1)
        self.farthest = order[:, -1]
        top = np.take_along_axis(self.moved, order[:, -2:], axis=1)
        self.most, self.other = top[:, -1], top[:, 0] if len(self.book) > 1 else np.zeros(len(books))

    def assign(self, x, entry, upper, upper_round, lower, lower_round, scans) -> None:
        """Bring the state up to this round in place."""
        others = np.where(self.farthest[lower_round] == entry, self.other[lower_round], self.most[lower_round])
        floor = (lower - others) * (1 - SLACK)
        open_ = np.flatnonzero(~((upper + self.moved[upper_round, entry]) * (1 + SLACK) < floor))
        gap = (x[open_] - self.book[entry[open_]]).astype(np.int64)
        upper[open_] = np.sqrt((gap * gap).sum(1).astype(np.float64))
        upper_round[open_] = self.now
        open_ = open_[~(upper[open_] * (1 + SLACK) < floor[open_])]
        self.scan(x, entry, upper, upper_round, lower, lower_round, scans, open_)

    def scan(self, x, entry, upper, upper_round, lower, lower_round, scans, at) -> None:
        """Compare the vectors ``at`` with all entries."""
        if not len(at):
            return
        squares = _squares(x[at], self.book)
        nearest = squares.argmin(1)
        entry[at] = nearest
        rows = np.arange(len(at))
        upper[at] = np.sqrt(squares[rows, nearest].astype(np.float64))
        squares[rows, nearest] = np.iinfo(np.int64).max
        lower[at] = np.sqrt(squares.min(1).astype(np.float64)) if len(self.book) > 1 else np.inf
        upper_round[at] = lower_round[at] = self.now
        scans[at] += 1


def _assigned(rows: DataFrame, history: list[np.ndarray]) -> DataFrame:
    """``rows`` with their state after the round of the newest codebook; they have a state from the second round on."""
    parts, names = len(history[0]), [c for c in rows.columns if c in ("vec_id", "label")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = [_Round(np.stack([books[p] for books in history])) for p in range(parts)]
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                x = _matrix(batch["vector"], np.int64)
                shape = (len(x), parts)
                if len(history) == 1:
                    entry, upper_round, lower_round = (np.zeros(shape, np.int64) for _ in range(3))
                    upper, lower, scans = np.zeros(shape), np.zeros(shape), np.zeros(len(x), np.int64)
                else:
                    entry, upper_round, lower_round = (
                        _matrix(batch[c], np.int64) for c in ("entry", "upper_round", "lower_round")
                    )
                    upper, lower = _matrix(batch["upper"], np.float64), _matrix(batch["lower"], np.float64)
                    scans = batch["scans"].to_numpy(zero_copy_only=False).astype(np.int64)
                cut = x.shape[1] // parts
                for p, own in enumerate(rounds):
                    part = x[:, p * cut : (p + 1) * cut]
                    state = entry[:, p], upper[:, p], upper_round[:, p], lower[:, p], lower_round[:, p], scans
                    if len(history) == 1:
                        own.scan(part, *state, np.arange(len(part)))
                    else:
                        own.assign(part, *state)
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c] for c in names), batch["vector"], _lists(entry, pa.int32()), _lists(upper, pa.float64()),
                     _lists(upper_round, pa.int32()), _lists(lower, pa.float64()), _lists(lower_round, pa.int32()),
                     pa.array(scans, pa.int32())],
                    names=[*names, "vector", "entry", "upper", "upper_round", "lower", "lower_round", "scans"],
                )

    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(run, f"{kept}, {_STATE}")


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks of the next round: floors of the means, entries that nothing is assigned to as they were."""
    parts, entries, cut = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, cut + 1), np.int64)
        for batch in batches:
            x, entry = _matrix(batch["vector"], np.int64), _matrix(batch["entry"], np.int64)
            for p in range(parts):
                np.add.at(total, p * entries + entry[:, p], np.pad(x[:, p * cut : (p + 1) * cut], ((0, 0), (0, 1)), constant_values=1))
        slot = np.flatnonzero(total)
        yield pa.record_batch({"slot": pa.array(slot), "total": pa.array(total.ravel()[slot])})

    # as many rows as the codebooks have numbers
    found = state.select("vector", "entry").mapInArrow(sums, "slot bigint, total bigint").groupBy("slot").agg(F.sum("total"))
    total = np.zeros(parts * entries * (cut + 1), np.int64)
    for slot, value in found.collect():
        total[slot] = value
    total = total.reshape(parts, entries, cut + 1)
    count = total[:, :, cut:]
    return np.where(count > 0, total[:, :, :cut] // np.maximum(count, 1), books)


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """vec_id, code, error, label_error and scans for the rows of ``vectors`` (vec_id, embedding, label) that can be coded, and the codebooks.

    ``error`` sums the squared distances of the parts to their entries, ``label_error`` the errors of the rows with the
    same label, null being one. ``scans`` counts how often a part was compared with all entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number has to fit into two hexadecimal digits")
    spark = vectors.sparkSession
    labels = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    path = scratch_path(spark, "codes")
    rows = materialize(_kept(vectors.select("vec_id", labels, "embedding"), parts), "codes", path)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    if not first:
        empty = "vec_id bigint, code string, error bigint, label_error bigint, scans int"
        return spark.createDataFrame([], empty), Codebooks([np.zeros((parts, 0, 0), np.int64)])
    start = np.array([row[0] for row in first], np.int64)
    history = [start.reshape(len(start), parts, -1).transpose(1, 0, 2)]
    for number in range(rounds + 1):
        before, path = path, scratch_path(spark, "codes")
        rows = materialize(_assigned(rows, history), "codes", path)
        remove_scratch(spark, before)
        if number < rounds:
            history.append(_means(rows, history[-1]))
    books = Codebooks(history)
    codes = materialize(_finished(rows, books.final), "codes-errors")
    # a label may have a third of all rows: errors are summed before they meet rows, and the join of a hot label can be split
    sums = materialize(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels")
    joined = codes.join(sums.withColumnRenamed("label", "own"), F.col("label").eqNullSafe(F.col("own")))
    return joined.select("vec_id", "code", "error", "label_error", "scans"), books


def _finished(rows: DataFrame, books: np.ndarray) -> DataFrame:
    parts, _, cut = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, entry = _matrix(batch["vector"], np.int64), _matrix(batch["entry"], np.int64)
            error = np.zeros(len(x), np.int64)
            for p in range(parts):
                gap = x[:, p * cut : (p + 1) * cut] - books[p][entry[:, p]]
                error += (gap * gap).sum(1)
            code = pa.array([row.tobytes().hex() for row in entry.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], code, pa.array(error), batch["scans"]],
                names=["vec_id", "label", "code", "error", "scans"],
            )

    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    return rows.mapInArrow(run, f"{kept}, code string, error bigint, scans int")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: vec_id, code, error, label_error, codebooks_sha256."""
    codes, books = encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _sql() -> str:
    """All rounds written out: parts in long form, entries in long form, one table each."""
    ctes = [
        f"""kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""part AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x
            FROM kept, range({PARTS}) r(p))""",
        f"""book0 AS MATERIALIZED (SELECT p, rn - 1 AS e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS rn
            FROM part) WHERE rn <= {ENTRIES})""",
    ]
    for t in range(ROUNDS + 1):
        gap = "CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
        ctes.append(
            f"""near{t} AS MATERIALIZED (SELECT vec_id, label, p, x, m.e AS e, m.d AS d FROM (SELECT a.vec_id, a.label, a.p, ANY_VALUE(a.x) AS x,
            MIN({{'d': {gap}, 'e': b.e}}) AS m FROM part a JOIN book{t} b ON a.p = b.p GROUP BY 1, 2, 3))"""
        )
        if t < ROUNDS:
            ctes.append(
                f"""book{t + 1} AS MATERIALIZED (SELECT b.p, b.e, COALESCE(n.x, b.x) AS x FROM book{t} b LEFT JOIN (
                SELECT p, e, list(CAST(floor(s / c) AS BIGINT) ORDER BY i) AS x FROM (
                SELECT p, e, i, SUM(y) AS s, COUNT(*) AS c FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM near{t})
                GROUP BY 1, 2, 3) GROUP BY 1, 2) n ON n.p = b.p AND n.e = b.e)"""
            )
    return f"""WITH {", ".join(ctes)},
        coded AS (SELECT vec_id, ANY_VALUE(label) AS label, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code,
                  CAST(SUM(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id),
        sha AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM book{ROUNDS})
        SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
        FROM coded, sha"""


QUERIES = {"op13_vector_codes": op13_vector_codes}
ORACLE = {"op13_vector_codes": _sql()}

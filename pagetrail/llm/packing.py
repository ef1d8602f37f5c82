"""Operator 3: batches of sequences in length buckets that waste least.

1. Texts are encoded whole by a tokenizer. Those of more than ``max_length`` tokens become several sequences, so nothing is cut off.
2. Lengths of all sequences are counted; the histogram has at most ``max_length`` + 1 rows, whatever the corpus.
3. Dynamic programming over the histogram finds the bucket boundaries with the smallest total padding.
4. Within its bucket each sequence gets a place in a hash order, numbered without any task holding a bucket; as many
   sequences as fit into ``token_budget`` at the bucket's length form a batch, so only the last batch of a bucket is short.

A text without tokens, null included, is one sequence of length 0. Repeated rows are sequences of their own. Of rows that a hash
order can't tell apart (repeated or missing ids) any comes first. Columns other than doc_id and text aren't read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.tokens import token_counts, token_ids, vocabulary_path
from pagetrail.operators.ranking import hash_rank
from pagetrail.session import materialize

MAX_LENGTH = 4096
BUCKETS = 16
TOKEN_BUDGET = 65_536
_ROWS = 256


def optimal_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The at most ``buckets`` of the lengths that as upper bounds waste least; of equals those with the shortest buckets first."""
    order = np.argsort(lengths)
    at, n = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    if not len(at):
        return []
    rows = np.concatenate([[0], np.cumsum(n)])
    # best[j]: least number of cells that the first j lengths fill; a bucket over i+1..j fills at[j-1] * (rows[j] - rows[i])
    best = np.concatenate([[0], np.full(len(at), np.iinfo(np.int64).max // 4)])
    back = []
    for _ in range(min(buckets, len(at))):
        new, came = best.copy(), np.full(len(best), -1)
        for first in range(1, len(best), _ROWS):
            j = np.arange(first, min(len(best), first + _ROWS))
            cells = best[None, :] + at[j - 1][:, None] * (rows[j][:, None] - rows[None, :])
            cells[np.arange(len(best))[None, :] >= j[:, None]] = np.iinfo(np.int64).max
            i = cells.argmin(axis=1)
            less = cells[np.arange(len(j)), i]
            better = less < new[j]
            new[j], came[j] = np.where(better, less, new[j]), np.where(better, i, came[j])
        best = new
        back.append(came)
    j, bounds = len(at), []
    for came in reversed(back):
        if j and came[j] >= 0:
            bounds.append(int(at[j - 1]))
            j = int(came[j])
    return bounds[::-1]


def pack(
    docs: DataFrame,
    tokens: Column | None = None,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    seed: int = 0,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per sequence of ``docs`` (doc_id, text and any other columns): doc_id, piece, first_token, n_tokens, bucket,
    bucket_length, batch (unique with the bucket), slot (from 0) and padding.

    Tokens are those of ``vocabulary`` (default: the installed one); ``with_ids`` adds ``token_ids``, what a batch is filled with.
    ``tokens`` gives the number of tokens of a row instead.
    """
    if tokens is not None:
        whole = docs.select("doc_id", F.coalesce(tokens, F.lit(0)).cast("bigint").alias("total"))
    elif with_ids:
        whole = token_ids(docs, vocabulary or vocabulary_path()).withColumn("total", F.size("token_ids").cast("bigint"))
    else:
        whole = token_counts(docs, vocabulary or vocabulary_path()).withColumnRenamed("n_tokens", "total")
    carried = ["token_ids"] if with_ids and tokens is None else []
    last = F.greatest(F.ceil(F.col("total") / max_length) - 1, F.lit(0)).cast("int")

    def piece(number: Column) -> Column:
        own = [F.slice("token_ids", number * max_length + 1, F.lit(max_length)).alias("token_ids")] if carried else []
        return F.struct(number.alias("piece"), *own)

    pieces = whole.select("doc_id", "total", F.inline(F.transform(F.sequence(F.lit(0), last), piece)))
    first = F.col("piece").cast("bigint") * max_length
    pieces = pieces.select(
        "doc_id", "piece", first.alias("first_token"), F.least(F.col("total") - first, F.lit(max_length)).cast("int").alias("n_tokens"), *carried
    )
    pieces = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()) if carried else pieces, "packing-pieces")
    ids = pieces.select("_row", "token_ids") if carried else None
    pieces = pieces.drop("token_ids")
    histogram = pieces.groupBy("n_tokens").count().collect()  # at most max_length + 1 rows
    bounds = optimal_boundaries([r.n_tokens for r in histogram], [r["count"] for r in histogram], buckets) or [0]
    limits = F.array(*(F.lit(b) for b in bounds))
    bucket = F.size(F.filter(limits, lambda b: b < F.col("n_tokens")))
    placed = pieces.withColumn("bucket", bucket).withColumn("bucket_length", F.element_at(limits, F.col("bucket") + 1))
    placed = placed.withColumn("_id", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "piece"))
    ranked = hash_rank(placed, "bucket", "_id", seed)
    fit = F.greatest(F.floor(F.lit(token_budget) / F.greatest("bucket_length", F.lit(1))), F.lit(1))
    place = F.col("rank") - 1
    packed = ranked.select(
        "doc_id",
        "piece",
        "first_token",
        "n_tokens",
        "bucket",
        "bucket_length",
        F.floor(place / fit).alias("batch"),
        (place % fit).alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
        *(["_row"] if carried else []),
    )
    # token ids stay where they are until the places are known, and are shuffled once
    return packed.join(ids, "_row").drop("_row") if carried else packed


def op3_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sequence of at most 4096 tokens: doc_id, piece, first_token, n_tokens, bucket, bucket_length, batch, slot, padding."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op3_length_buckets": op3_length_buckets}
ORACLE: dict[str, str] = {}

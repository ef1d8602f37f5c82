"""Operator 4: tokens of a document attributed to its sections.

The whole text is encoded once by a byte-level BPE tokenizer. Lengths of tokens in bytes give the span of each token; spans
are joined with the spans of the sections. A token that crosses a boundary goes, by ``rule``, to

* ``most``: the section that holds most of its bytes, of equals the earlier one;
* ``first``: the section that holds its first byte.

Tokens of no section (sections may leave gaps) are counted under section -1, so the counts of a document always add up to
its number of tokens. Null and empty texts have their sections with 0 tokens; a document without sections has the row -1.
Repeated rows have their sections each; columns of ``docs`` other than doc_id and text aren't read, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from pagetrail.llm.textcodes import slices

# Fixed value: how the tokenizer's vocabulary expects texts to be split.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPAN = T.ArrayType(
    T.StructType([T.StructField("name", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
)
_ENCODERS: dict = {}


def vocabulary_path() -> str:
    """The installed vocabulary that the registered query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _lines(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines of a text start and stop, in bytes; a line holds its line break, an empty text is one line."""
    stops = np.flatnonzero(data == 10) + 1
    if not len(stops) or stops[-1] < len(data):
        stops = np.append(stops, len(data))
    return np.concatenate([[0], stops[:-1]]), stops


def _encoder(ranks: bytes, split: str):
    import tiktoken

    key = (hash(ranks), split)
    if key not in _ENCODERS:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        lengths = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            lengths[rank] = len(token)
        _ENCODERS[key] = tiktoken.Encoding("given", pat_str=split, mergeable_ranks=table, special_tokens={}), lengths
    return _ENCODERS[key]


def token_ends(text: str, encoder, lengths: np.ndarray) -> np.ndarray:
    """Where each token of a text ends, in bytes."""
    return np.cumsum(lengths[np.asarray(encoder.encode_ordinary(text), np.int64)])


def token_ids(docs: DataFrame, vocabulary: str, split: str = SPLIT) -> DataFrame:
    """doc_id and token_ids for each row of ``docs`` (doc_id, text), each text encoded whole; none for null and empty texts."""
    return _encoded(docs, vocabulary, split, "token_ids array<int>", lambda rows: pa.array(rows, pa.list_(pa.int32())))


def token_counts(docs: DataFrame, vocabulary: str, split: str = SPLIT) -> DataFrame:
    """doc_id and n_tokens for each row of ``docs`` (doc_id, text), each text encoded whole; 0 for null and empty texts."""
    return _encoded(docs, vocabulary, split, "n_tokens bigint", lambda rows: pa.array(map(len, rows), pa.int64()))


def _encoded(docs: DataFrame, vocabulary: str, split: str, field: str, column: Callable[[list], pa.Array]) -> DataFrame:
    ranks = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _encoder(ranks.value, split)
        for batch in slices(batches):
            rows = [encoder.encode_ordinary(text) if text else [] for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], column(rows)], names=["doc_id", field.split()[0]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, {field}")


def attribute(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str) -> np.ndarray:
    """For each token its section, -1 for none. All in bytes; sections are in order and do not overlap."""
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    if not len(starts):
        return np.full(len(ends), -1)
    first = np.searchsorted(stops, begins, "right")  # the first section that ends behind the token's first byte
    inside = (first < len(starts)) & (starts[np.minimum(first, len(starts) - 1)] <= begins)
    out = np.where(inside, first, -1)
    if rule == "first":
        return out
    last = np.searchsorted(starts, ends, "left") - 1  # the last one that starts before its end
    over = ends > stops[np.minimum(first, len(stops) - 1)]
    for i in np.flatnonzero((last > first) | (last == first) & (~inside | over)):  # tokens that cross a boundary
        held = np.arange(first[i], last[i] + 1)
        own = np.minimum(ends[i], stops[held]) - np.maximum(begins[i], starts[held])
        gap = ends[i] - begins[i] - own.sum()
        out[i] = held[own.argmax()] if own.max() > 0 and own.max() >= gap else -1
    return out


def section_tokens(docs: DataFrame, vocabulary: str, sections: Column | None = None, rule: str = "most", split: str = SPLIT) -> DataFrame:
    """One row per section of ``docs`` (doc_id, text and any other columns): doc_id, section_no, name, start, stop
    (characters, half-open), n_tokens and doc_tokens, and a row with section_no -1 for tokens outside all sections.

    ``sections`` is an array of (name, start, stop) in order and without overlaps, lines by default. ``vocabulary`` is a path on
    the driver; its content, less than a megabyte, is sent to the executors.
    """
    if rule not in ("most", "first"):
        raise ValueError(f"no rule {rule}")
    ranks = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    by_line = sections is None
    rows = docs.select("doc_id", "text") if by_line else docs.select("doc_id", "text", sections.cast(_SPAN).alias("sections"))

    def spans(batch: pa.RecordBatch, i: int) -> tuple[list, np.ndarray, np.ndarray]:
        found = batch["sections"][i].as_py() or []
        return [x["name"] for x in found], *(np.array([x[c] for x in found], np.int64) for c in ("start", "stop"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = _encoder(ranks.value, split)
        for batch in slices(batches):
            out = []
            for i, text in enumerate(batch["text"].to_pylist()):
                text = text or ""
                data = np.frombuffer(text.encode(), np.uint8)
                at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # bytes of the characters
                if by_line:
                    a, b = _lines(data)
                    names = ["title"] + ["line"] * (len(a) - 1)
                    start, stop = np.searchsorted(at, a), np.searchsorted(at, b)
                else:
                    names, start, stop = spans(batch, i)
                    a, b = at[np.clip(start, 0, len(at) - 1)], at[np.clip(stop, 0, len(at) - 1)]
                ends = token_ends(text, encoder, lengths)
                number = np.bincount(attribute(ends, a, b, rule) + 1, minlength=len(a) + 1)
                alone = number[0] > 0 or not len(a)  # tokens of no section, or no section
                if alone:
                    names, start, stop = [None, *names], np.append(-1, start), np.append(-1, stop)
                out.append((np.arange(len(a) + alone) - alone, names, start, stop, number if alone else number[1:], len(ends)))
            sizes = [len(x[1]) for x in out]
            row = pa.array(np.repeat(np.arange(len(out)), sizes))
            number, start, stop, tokens = (np.concatenate([x[k] for x in out]) for k in (0, 2, 3, 4))
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"].take(row),
                    "section_no": pa.array(number, pa.int32()),
                    "name": pa.array([n for x in out for n in x[1]], pa.string()),
                    "start": pa.array(start, pa.int64(), mask=number < 0),
                    "stop": pa.array(stop, pa.int64(), mask=number < 0),
                    "n_tokens": pa.array(tokens, pa.int64()),
                    "doc_tokens": pa.array(np.repeat([x[5] for x in out], sizes), pa.int64()),
                }
            )

    kinds = "section_no int, name string, start bigint, stop bigint, n_tokens bigint, doc_tokens bigint"
    return rows.mapInArrow(count, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {kinds}")


def op4_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line of each document: doc_id, section_no, name, start, stop, n_tokens, doc_tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return section_tokens(docs, vocabulary_path())


QUERIES = {"op4_section_tokens": op4_section_tokens}
ORACLE: dict[str, str] = {}

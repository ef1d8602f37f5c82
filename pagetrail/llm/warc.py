r"""Operator 6: WARC archives written from and read to a table of chunks.

A payload is a run of rows (record, chunk_no, chunks, data). Pages are cut where they are read; what is shuffled, sorted and written
are chunks. Digests are carried from chunk to chunk, and each chunk becomes a WARC record of its own, a ``response`` followed by ``continuation``
records with segment numbers as the WARC format defines them. Archives are written and read by Spark's own text format with
``\r\n\r\n`` as the separator, which ends a WARC record, gzip compressed, so any store that Spark knows will do.

Of payloads with at least ``LEAST_BYTES`` bytes and equal digests, the one with the smallest id is a response, the others
are ``revisit`` records without a payload that name it; smaller ones are always responses. Payloads are told equal by
SHA-256 and length. Rows whose id repeats and whose payload is equal have the same type. A null id counts as larger than
all ids; if a payload has null ids only, all its records are responses. Null payloads are empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.session import materialize, scratch_path

CHUNK_BYTES = 1 << 20
LEAST_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
SEPARATOR = "\r\n\r\n"
_END = SEPARATOR.encode()


def chunks(rows: DataFrame, payload: Column, key: list[str], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``rows`` without long columns as a chunk table: the columns ``key``, chunk_no, chunks and data, the chunks of a row
    next to each other and in order."""
    data = F.coalesce(payload.cast("binary"), F.lit(b""))
    number = F.greatest(F.ceil(F.octet_length(data) / chunk_bytes), F.lit(1)).cast("int")
    split = rows.select(*key, data.alias("_data"), number.alias("chunks"))
    split = split.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk_no"))
    piece = F.substring("_data", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))
    return split.select(*key, "chunk_no", "chunks", piece.alias("data"))


def digested(table: DataFrame, key: list[str]) -> DataFrame:
    """A chunk table, whose chunks stand in order, with payload_bytes and payload_digest at the last chunk of every payload.

    Digest and length are carried from chunk to chunk; a task holds a batch of chunks at a time.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, size = None, 0
        for batch in batches:
            numbers, totals = batch["chunk_no"].to_numpy(), batch["chunks"].to_numpy()
            sizes, found = [None] * len(numbers), [None] * len(numbers)
            for i, data in enumerate(batch["data"]):
                if numbers[i] == 0:
                    running, size = hashlib.sha256(), 0
                running.update(data.as_buffer())
                size += len(data.as_buffer())
                if numbers[i] == totals[i] - 1:
                    sizes[i], found[i] = size, running.hexdigest()
            added = [pa.array(sizes, pa.int64()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in held), *added], names=[*held, "payload_bytes", "payload_digest"]
            )

    held = [*key, "chunk_no", "chunks", "data"]
    kinds = ", ".join(f"`{c}` {table.schema[c].dataType.simpleString()}" for c in held)
    return table.select(*held).mapInArrow(digest, f"{kinds}, payload_bytes bigint, payload_digest string")


def typed(found: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``found`` (page_id, payload_bytes, payload_digest and any other columns) with record_type and refers_to."""
    firsts = found.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
    firsts = firsts.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    firsts = materialize(firsts, "warc-firsts")
    joined = found.join(firsts, ["payload_digest", "payload_bytes"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        *found.columns,
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:pagetrail:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def records(table: DataFrame) -> DataFrame:
    """``value``, a WARC record without its final separator, for each row of a chunk table that has url, record_type,
    refers_to, payload_bytes and payload_digest. Line breaks of a url are escaped."""
    first, several = F.col("chunk_no") == 0, F.col("chunks") > 1
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"\r\n{name}: "), value)
        return F.coalesce(text if when is None else F.when(when, text), F.lit(""))

    uri = _uri(F.col("page_id"))
    number = (F.col("chunk_no") + 1).cast("string")
    head = F.concat(
        F.lit("WARC/1.1"),
        line("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        line("WARC-Record-ID", F.when(first, uri).otherwise(F.concat(F.expr("'<urn:pagetrail:part:'"), number, F.lit(":"), F.substring(uri, 2, 1 << 30)))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest")), first),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string"), first),
        line("WARC-Refers-To", _uri(F.col("refers_to")), first & F.col("refers_to").isNotNull()),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), F.col("refers_to").isNotNull()),
        line("WARC-Segment-Number", number, several),
        line("WARC-Segment-Origin-ID", uri, ~first),
        line("WARC-Segment-Total-Length", F.col("payload_bytes").cast("string"), several & (F.col("chunk_no") == F.col("chunks") - 1)),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length("data").cast("string")),
        F.lit(SEPARATOR),
    )
    return table.select(F.concat(head.cast("binary"), F.col("data")).cast("string").alias("value"))


def write_warc(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Archives of ``pages`` (page_id, url, html and any other columns) in a folder, one file per task.

    Pages are numbered and cut into chunks once. From then on only chunks move: their records' types, which follow from the digests,
    are joined to them by the number, and those of a record go to one task in order.
    """
    own = pages.select("page_id", "url", "html").withColumn("record", F.monotonically_increasing_id())
    key = ["record", "page_id", "url"]
    table = materialize(digested(chunks(own, F.col("html"), key, chunk_bytes), key), "warc-chunks")
    found = table.filter("payload_digest IS NOT NULL").select("record", "page_id", "payload_bytes", "payload_digest")
    types = materialize(typed(found).drop("page_id"), "warc-types")
    # the one shuffle of chunks; the join and the order of a record build on it
    rows = table.drop("payload_bytes", "payload_digest").repartition("record").join(types, "record")
    response = F.col("record_type") == "response"
    rows = rows.filter(response | (F.col("chunk_no") == 0)).withColumns(
        {"data": F.when(response, F.col("data")).otherwise(F.lit(b"")), "chunks": F.when(response, F.col("chunks")).otherwise(1)}
    )
    ordered = rows.sortWithinPartitions("record", "chunk_no")
    records(ordered).write.option("lineSep", SEPARATOR).option("compression", "gzip").mode("errorifexists").text(path)


class _Reader:
    """Splits the bytes of an archive, which come in pieces of any size, into headers and runs of payload."""

    def __init__(self):
        self.head, self.left, self.skip, self.fields = bytearray(), 0, 0, None

    def feed(self, data: memoryview) -> Iterator[tuple[dict, memoryview, bool]]:
        """(fields, part of the payload, whether it is the last part) of the records."""
        while len(data):
            if self.skip:
                n = min(self.skip, len(data))
                self.skip, data = self.skip - n, data[n:]
            elif self.fields is None:
                before = len(self.head)
                if not before:  # a file whose last payload ends like a separator ends with spare line breaks
                    n = next((i for i, c in enumerate(data) if c not in b"\r\n"), len(data))
                    data = data[n:]
                    if n and not len(data):
                        return
                self.head += data
                end = self.head.find(_END, max(before - 3, 0))
                if end < 0:
                    return
                data = data[end + 4 - before :]
                lines = bytes(self.head[:end]).decode().split("\r\n")
                if not lines[0].startswith("WARC/"):
                    raise ValueError("not a WARC record")
                self.fields = dict(x.split(": ", 1) for x in lines[1:])
                self.left, self.head = int(self.fields["Content-Length"]), bytearray()
                if not self.left:
                    yield self.fields, data[:0], True
                    self.fields, self.skip = None, 4
            else:
                n = min(self.left, len(data))
                self.left -= n
                yield self.fields, data[:n], not self.left
                data = data[n:]
                if not self.left:
                    self.fields, self.skip = None, 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record but continuations, with what is found by streaming its payload through all segments: page_id, url,
    record_type, refers_to, stated_bytes, stated_digest, read_bytes and read_digest (of the payload as read)."""

    def page(uri: str | None) -> int | None:
        number = uri.rsplit(":", 1)[1][:-1] if uri else "null"
        return None if number == "null" else int(number)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, rows, running = _Reader(), [], None

        def emitted(rows):
            names = ("page_id", "url", "record_type", "refers_to", "stated_bytes", "stated_digest", "read_bytes", "read_digest")
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

        for batch in batches:
            for piece in batch["value"]:
                for part in (piece.as_buffer(), _END):
                    for fields, data, _ in reader.feed(memoryview(part)):
                        if fields["WARC-Type"] != "continuation" and (running is None or running[0] is not fields):
                            if running is not None:
                                rows.append(_row(running, page))
                            running = [fields, hashlib.sha256(), 0]
                        running[1].update(data)
                        running[2] += len(data)
            yield emitted(rows)
            rows = []
        if running is not None:
            rows.append(_row(running, page))
        yield emitted(rows)

    text = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("value").cast("binary").alias("value"))
    return text.mapInArrow(
        parse,
        "page_id bigint, url string, record_type string, refers_to bigint, stated_bytes bigint, stated_digest string, "
        "read_bytes bigint, read_digest string",
    )


def _row(running: list, page) -> tuple:
    fields, digest, size = running
    return (
        page(fields["WARC-Record-ID"]),
        fields.get("WARC-Target-URI"),
        fields["WARC-Type"],
        page(fields.get("WARC-Refers-To")),
        int(fields["WARC-Payload-Length"]),
        fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        size,
        digest.hexdigest(),
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to; of responses the length and digest of what was
    read back, of revisits those that their record states."""
    path = scratch_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    own = F.col("record_type") == "response"
    return read_warc(spark, path).select(
        "page_id",
        F.when(own, F.col("read_bytes")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(own, F.col("read_digest")).otherwise(F.col("stated_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


QUERIES = {"op6_warc": op6_warc}
ORACLE = {
    "op6_warc": """
        WITH payload AS (
            SELECT page_id, encode(coalesce(html, '')) AS data FROM pages
        ), digest AS (
            SELECT page_id, CAST(octet_length(data) AS BIGINT) AS payload_bytes, sha256(data) AS payload_digest FROM payload
        ), first AS (
            SELECT payload_digest, min(page_id) AS page_id FROM digest WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT d.page_id, payload_bytes, d.payload_digest,
               CASE WHEN f.page_id < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.page_id < d.page_id THEN f.page_id END AS refers_to
        FROM digest d LEFT JOIN first f ON d.payload_digest = f.payload_digest
    """
}

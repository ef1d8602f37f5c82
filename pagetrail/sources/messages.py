"""A queue of messages in a folder, as a streaming source that is read with offsets and acknowledged by commits.

A publisher adds numbered batches of parquet files. A consumer reads the batches behind its offset; when the stream commits an
offset, the batches up to it are acknowledged for the subscription. A batch that failed, or a consumer that was stopped before its
commit, gets the same messages again: from its checkpoint, or, without one, from the last acknowledged batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from pagetrail.session import hadoop_path, qualified

# workers run the source as the driver sends it and need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SOURCE = "message_queue"
SCHEMA = "message_id bigint, published timestamp, value binary"


def publish(messages: DataFrame, queue: str) -> int:
    """Add ``messages`` (message_id, published, value) as the next batch of a queue; its number. A queue has one publisher."""
    spark = messages.sparkSession
    folder, store = hadoop_path(spark, f"{queue}/batches")
    taken = [int(s.getPath().getName()) for s in store.listStatus(folder)] if store.exists(folder) else []
    number = max(taken, default=0) + 1
    columns = [messages[name].cast(kind).alias(name) for name, kind in (column.split() for column in SCHEMA.split(", "))]
    messages.select(*columns).write.parquet(f"{queue}/batches/{number:012d}")
    return number


def subscribe(spark: SparkSession, queue: str, subscription: str = "default") -> DataFrame:
    """Stream of the messages of a queue."""
    spark.dataSource.register(MessageQueue)
    options = {"queue": qualified(spark, queue), "subscription": subscription}
    return spark.readStream.format(SOURCE).options(**options).load()


class MessageQueue(DataSource):
    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["queue"], self.options["subscription"])


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


def _store(queue: str) -> tuple[fs.FileSystem, str]:
    if queue.startswith("file:"):
        return fs.LocalFileSystem(), "/" + queue.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(queue)


class _Reader(DataSourceStreamReader):
    """Offsets are ``{"batch": number}``, the last batch that was read."""

    def __init__(self, queue: str, subscription: str):
        self.queue, self.subscription = queue, subscription

    def _children(self, folder: str) -> list[fs.FileInfo]:
        store, root = _store(self.queue)
        return store.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True))

    def _complete(self) -> list[int]:
        """Numbers of the batches whose writing has ended."""
        store, _ = _store(self.queue)
        batches = [info for info in self._children("batches") if info.type == fs.FileType.Directory]
        ended = store.get_file_info([f"{info.path}/_SUCCESS" for info in batches])
        return [int(info.base_name) for info, end in zip(batches, ended, strict=True) if end.type == fs.FileType.File]

    def acknowledged(self) -> int:
        return max((int(info.base_name) for info in self._children(f"acknowledged/{self.subscription}")), default=0)

    def initialOffset(self) -> dict:
        return {"batch": self.acknowledged()}

    def latestOffset(self) -> dict:
        return {"batch": max(self._complete(), default=self.acknowledged())}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        wanted = [n for n in self._complete() if start["batch"] < n <= end["batch"]]
        files = [info for n in sorted(wanted) for info in self._children(f"batches/{n:012d}")]
        return [_File(info.path) for info in files if info.base_name.endswith(".parquet")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        store, _ = _store(self.queue)
        with store.open_input_file(partition.path) as file:
            for batch in pq.ParquetFile(file).iter_batches():
                moment = batch["published"].cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([batch["message_id"], moment, batch["value"]], names=["message_id", "published", "value"])

    def commit(self, end: dict) -> None:
        """Acknowledge everything up to ``end``. Only the newest acknowledgement is kept."""
        store, root = _store(self.queue)
        folder = f"{root}/acknowledged/{self.subscription}"
        store.create_dir(folder, recursive=True)
        store.open_output_stream(f"{folder}/{end['batch']:012d}").close()
        for info in store.get_file_info(fs.FileSelector(folder)):
            if int(info.base_name) < end["batch"]:
                store.delete_file(info.path)

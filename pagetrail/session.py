"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCOPES: list[list[str]] = []


def build_session(app_name: str = "pagetrail", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the jobs are designed for; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # many small page files: count each open as 256 KB, so thousands share a task
        "spark.sql.files.openCostInBytes": str(256 * 1024),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({key: str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: what the cluster names in ``spark.checkpoint.dir``. Where all tasks run in the
    driver's own process, a folder of its warehouse serves as well."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used yet, below the shared folder."""
    path = f"{shared_root(spark)}/pagetrail/{purpose}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what was written to scratch paths inside it. Results must be written elsewhere by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove_scratch(spark, path)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder that nothing reads any more."""
    if not path.startswith(f"{shared_root(spark)}/pagetrail/"):
        raise ValueError(f"{path} is not a scratch table")
    target, store = hadoop_path(spark, path)
    store.delete(target, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and host Spark would use for it."""
    target, store = hadoop_path(spark, path)
    return store.makeQualified(target).toString()


def hadoop_path(spark: SparkSession, path: str):
    """The path and the file system it is on, as objects of the JVM."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(context._jsc.hadoopConfiguration())


def materialize(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    The result has no lineage beyond its files, so a lost executor costs a re-read and not a re-computation,
    and its file sizes give the optimizer real statistics.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, purpose)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

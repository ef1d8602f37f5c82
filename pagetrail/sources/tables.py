"""Star tables in parquet or behind JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.operators.star import Star, same_keys
from pagetrail.session import materialize
from pagetrail.sources.generations import current, publish

STAR_TABLES = ("countries", "ip_addresses", "demographics", "request_events", "failed_request_events")
KEY_BUCKETS = 256


def write_star(star: Star, path: str) -> None:
    """Replace the five tables of the store ``path``; facts are reloaded whole, so a rerun adds nothing twice.

    Readers see all five tables of one load, also while or after a load fails.
    """

    def write(folder: str) -> None:
        for name, table in star.tables().items():
            table.write.parquet(f"{folder}/{name}")

    publish(star.countries.sparkSession, path, write)


def read_star(spark: SparkSession, path: str) -> Star:
    """The tables of the last load that was finished."""
    folder = current(spark, path)
    if folder is None:
        raise ValueError(f"no star has been published under {path}")
    return Star(**{name: spark.read.parquet(f"{folder}/{name}") for name in STAR_TABLES})


def write_keyed(rows: DataFrame, path: str, keys: list[str], buckets: int = KEY_BUCKETS) -> None:
    """Replace a table that is kept in ``buckets`` folders by a hash of its ``keys``."""
    _bucketed(rows, keys, buckets).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def upsert_keyed(incoming: DataFrame, path: str, keys: list[str], buckets: int = KEY_BUCKETS) -> list[int]:
    """Replace or add the rows of ``incoming``, which has each key once, in a table of ``write_keyed``; the rewritten buckets.

    Only the folders of buckets that ``incoming`` has keys of are read and written. NULL is a key like others.
    """
    spark = incoming.sparkSession
    fresh = materialize(_bucketed(incoming, keys, buckets), "upsert")
    touched = sorted(row[0] for row in fresh.select("bucket").distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return []
    existing = spark.read.parquet(path)
    stored = existing.filter(F.col("bucket").isin(touched))
    same = (stored["bucket"] == fresh["bucket"]) & same_keys(stored, fresh, keys)
    merged = stored.join(fresh, same, "left_anti").unionByName(fresh.select(*existing.columns))
    # written aside first: the folders it comes from are replaced
    merged = materialize(merged, "upserted")
    dealt = merged.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    dealt.partitionBy("bucket").parquet(path)
    return touched


def _bucketed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def read_star_jdbc(spark: SparkSession, url: str, properties: dict[str, str], event_ranges: int = 1) -> Star:
    """The tables of a database, one scan each; Spark joins them.

    With ``event_ranges`` above 1 the request facts are read in that many parallel ranges of event_id.
    """

    def table(name: str, **options) -> DataFrame:
        reader = spark.read.format("jdbc").options(url=url, dbtable=name, **properties)
        return reader.options(**options).load()

    ranges = {}
    if event_ranges > 1:
        ends = table("(SELECT MIN(event_id) AS low, MAX(event_id) AS high FROM request_events) ends").first()
        ranges = {
            "partitionColumn": "event_id",
            "lowerBound": ends["low"],
            "upperBound": ends["high"],
            "numPartitions": event_ranges,
        }
    return Star(**{name: table(name, **(ranges if name == "request_events" else {})) for name in STAR_TABLES})

"""From raw documents to packed training batches: five stages, each a Spark job whose result is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagetrail.llm import decontaminate, jaccard, language, packing, surrogates
from pagetrail.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts and texts without letters go."""
    return language.keep_recognised(docs, learn_from=~language.held_out())


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word similarity of at least 0.8 hold together: that with the smallest id."""
    return jaccard.keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates. A real run sets ``spark.pagetrail.secret``."""
    return surrogates.pseudonymise(docs, spark.conf.get("spark.pagetrail.secret", surrogates.QUERY_SECRET))


def length_buckets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of all documents, their token ids, bucket, batch and slot."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("length_buckets", length_buckets),
]

#: Training, minimum hashes and dynamic programming have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}

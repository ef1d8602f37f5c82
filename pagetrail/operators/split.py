"""Train/test splits that are repeatable and safe for large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetrail.operators.ranking import hash_rank

TEST_SHARE = 0.2
COUNTRY_SEED = 42
INCOME_SEED = 7
FOLDS = 5


def country_split(rows: DataFrame, seed: int = COUNTRY_SEED) -> DataFrame:
    """Rows with ``is_test``: of each IP's n rows, ceil(0.2 n) are test rows; IPs with one row are all train.

    If no IP has two rows, the split is over all rows at once. Rows without IP or country are left out, and only
    event_id, client_ip and country are carried.
    """
    data = rows.select("event_id", "client_ip", "country").dropna(subset=["client_ip", "country"])
    largest = data.groupBy("client_ip").agg(F.count("*").alias("n")).agg(F.max("n")).scalar()
    grouped = data.withColumn("_group", F.when(largest >= 2, F.col("client_ip")).otherwise(F.lit("")))
    ranked = hash_rank(grouped, "_group", "event_id", seed)
    wanted = F.ceil(F.lit(TEST_SHARE) * F.col("group_rows"))
    is_test = (F.col("group_rows") >= 2) & (F.col("rank") <= wanted)
    return ranked.withColumn("is_test", is_test).drop("_group", "rank", "group_rows")


def income_split(rows: DataFrame, seed: int = INCOME_SEED) -> DataFrame:
    """Rows with ``is_test``: ceil(0.2 N) test rows overall, shared out over incomes in proportion.

    Train rows per income are the rounded-down share plus one for the largest remainders, ties by name.
    """
    data = rows.withColumn("income", F.coalesce("income", F.lit("Unknown")))
    return hash_rank(data, "income", "event_id", seed, _test_quota(data)).withColumn(
        "is_test", F.col("rank") <= F.col("_quota")
    ).drop("rank", "group_rows", "_quota")


def _test_quota(data: DataFrame) -> DataFrame:
    """(income, _quota). Works on one row per income."""
    sizes = data.groupBy("income").agg(F.count("*").alias("n"))
    total = data.agg(F.count("*")).scalar()
    shares = sizes.withColumn("_total", total).select(
        "income",
        "n",
        (F.col("_total") - F.ceil(F.lit(TEST_SHARE) * F.col("_total"))).alias("_train"),
        "_total",
    )
    exact = shares.withColumn("_exact", F.col("n").cast("double") / F.col("_total") * F.col("_train"))
    floored = exact.withColumn("_floor", F.floor("_exact"))
    every = Window.partitionBy(F.lit(0))
    by_remainder = every.orderBy(F.desc(F.col("_exact") - F.col("_floor")), "income")
    extra = F.row_number().over(by_remainder) <= F.col("_train") - F.sum("_floor").over(every)
    return floored.select("income", (F.col("n") - F.col("_floor") - extra.cast("int")).alias("_quota"))


def split_drift(split: DataFrame) -> DataFrame:
    """One row (max_drift): largest difference of an income's share between the test rows and all rows."""
    sizes = split.groupBy("income").agg(F.count("*").alias("n"), F.count_if("is_test").alias("n_test"))
    totals = sizes.agg(F.sum("n").alias("n"), F.sum("n_test").alias("n_test"))
    share = F.abs(F.col("n_test") / F.col("_test_total") - F.col("n") / F.col("_total"))
    return (
        sizes.withColumn("_total", totals.select("n").scalar())
        .withColumn("_test_total", totals.select("n_test").scalar())
        .agg(F.max(share).alias("max_drift"))
    )


def with_folds(train: DataFrame, label: str, row_id: str, seed: int, folds: int = FOLDS) -> DataFrame:
    """Rows with ``fold``, dealt out evenly inside each label."""
    ranked = hash_rank(train, label, row_id, seed)
    return ranked.withColumn("fold", F.pmod(F.col("rank") - 1, F.lit(folds)).cast("int")).drop("rank", "group_rows")

"""IP-to-country memoriser: modal country per IP, the overall majority for IPs never seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def majority(train: DataFrame, label: str = "country") -> DataFrame:
    """One row, one column: the most frequent label, ties to the smallest."""
    counted = train.groupBy(label).agg(F.count("*").alias("_n"))
    return counted.orderBy(F.desc("_n"), F.asc(label)).limit(1).select(label)


def country_model(split: DataFrame) -> DataFrame:
    """(client_ip, predicted_country) learned from the train rows."""
    pairs = split.filter("NOT is_test").groupBy("client_ip", "country").agg(F.count("*").alias("_n"))
    order = Window.partitionBy("client_ip").orderBy(F.desc("_n"), F.asc("country"))
    best = pairs.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1")
    return best.select("client_ip", F.col("country").alias("predicted_country"))


def country_predictions(split: DataFrame, model: DataFrame | None = None) -> DataFrame:
    """(event_id, client_ip, country, predicted_country) for the test rows."""
    model = country_model(split) if model is None else model
    fallback = majority(split.filter("NOT is_test")).scalar()
    tested = split.filter("is_test").join(model, "client_ip", "left")
    return tested.select(
        "event_id", "client_ip", "country", F.coalesce("predicted_country", fallback).alias("predicted_country")
    )


def accuracy(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row (accuracy): share of rows where both columns agree."""
    return predictions.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))

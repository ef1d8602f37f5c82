"""Stream of refused requests: filter, message, both report channels, running log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.operators.requests import channel_lines, forbidden_events


def forbidden_stream(requests: DataFrame, profile: str = "v5", pod: str = "") -> DataFrame:
    """(request_id, ts, channel, line) of a request stream, for an append sink."""
    return channel_lines(forbidden_events(requests, profile, pod), profile)


def received_messages(payloads: DataFrame) -> DataFrame:
    """Queue payloads (value binary) as text lines; the sink's checkpoint takes the place of acknowledgements."""
    return payloads.withColumn("value", F.col("value").cast("string"))


def drop_redelivered(messages: DataFrame, message_id: str, moment: str, within: str) -> DataFrame:
    """Messages delivered more than once within ``within`` are kept once."""
    return messages.withWatermark(moment, within).dropDuplicatesWithinWatermark([message_id])

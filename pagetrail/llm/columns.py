"""Columns of the input that have the name of a column an operator adds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_aside(docs: DataFrame, added: tuple[str, ...]) -> DataFrame:
    """``docs`` with its columns of these names under other ones (names differ in more than case)."""
    return docs.withColumnsRenamed({c: f"{c}__aside" for c in docs.columns if c.lower() in added})


def put_back(result: DataFrame, docs: DataFrame, added: tuple[str, ...]) -> DataFrame:
    """The columns of ``docs`` of a result that was made from ``set_aside(docs, added)``."""
    own = [(c, f"{c}__aside" if c.lower() in added else c) for c in docs.columns]
    return result.select(*(F.col(f"`{held}`").alias(c) for c, held in own))

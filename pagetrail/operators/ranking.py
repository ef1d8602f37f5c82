"""Positions of rows in a hash order of their group, without any task holding a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A group larger than this is cut into slices of about this many rows or fewer.
SLICE_ROWS = 65_536
# The order is that of the first 15 hex digits of a hash, read as a number of 60 bits.
_HEX_DIGITS = 15
_BITS = 60
_MOST_SLICE_BITS = 32


def hash_rank(
    rows: DataFrame,
    group: str,
    row_id: str,
    seed: int,
    per_group: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Adds ``rank``, the 1-based position of each row in its group, and ``group_rows``.

    The order is that of the first 15 hex digits of md5("<seed>:<id>"), then of id: repeatable and the same in any SQL
    engine. Leading bits of the hash cut a large group into slices of equal size, as many as its size asks for. Slice
    sizes give every slice its first position, and rows are numbered per slice, so even a group with a third of all
    rows is spread over all tasks.

    ``group`` must not be NULL. Columns of ``per_group`` (one row per group) are carried along.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("_size"))
    bits = F.least(F.ceil(F.log2(F.col("_size") / slice_rows)), F.lit(_MOST_SLICE_BITS)).cast("int")
    large = sizes.filter(F.col("_size") > slice_rows).select(group, bits.alias("_bits"))
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))), 1, _HEX_DIGITS)
    keyed = (
        rows.withColumn("_hash", F.conv(digest, 16, 10).cast("bigint"))
        .join(large, group, "left")
        .withColumn("_slice", F.call_function("shiftright", F.col("_hash"), _BITS - F.coalesce("_bits", F.lit(0))))
        .drop("_bits")
    )

    counted = keyed.groupBy(group, "_slice").agg(F.count("*").alias("_rows"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = counted.select(
        group,
        "_slice",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("group_rows"),
    )
    if per_group is not None:
        slices = slices.join(per_group, group)

    # an explicit exchange on both keys: partitioning by the group alone would also satisfy the window below
    spread = keyed.repartition("_slice", group).join(slices, ["_slice", group])
    inside = Window.partitionBy("_slice", group).orderBy("_hash", row_id)
    return spread.withColumn("rank", F.col("_before") + F.row_number().over(inside)).drop(
        "_hash", "_slice", "_before"
    )

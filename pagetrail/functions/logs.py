"""Column expressions over log rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound (exclusive) and label of each age group.
AGE_GROUPS = ((18, "0-17"), (25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
OLDEST_GROUP = "55+"
UNKNOWN = "Unknown"


def blank_to(value: Column, default: str) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def age_group(age: Column) -> Column:
    label = F.when(age.isNull(), F.lit(UNKNOWN))
    for bound, name in AGE_GROUPS:
        label = label.when(age < bound, F.lit(name))
    return label.otherwise(F.lit(OLDEST_GROUP))


def time_of_day(moment: Column) -> Column:
    return F.date_format(moment, "HH:mm:ss")

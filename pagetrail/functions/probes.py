"""Column expressions over availability probes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagetrail.functions.http import strip

MISSING_ZONE = "missing"
UNKNOWN_ZONE = "unknown"


def base_url(server: Column) -> Column:
    """Server address with a scheme and without trailing slashes."""
    has_scheme = F.startswith(server, F.lit("http://")) | F.startswith(server, F.lit("https://"))
    return F.rtrim(F.when(has_scheme, server).otherwise(F.concat(F.lit("http://"), server)), F.lit("/"))


def probe_url(server: Column, path: Column) -> Column:
    return F.concat(base_url(server), F.lit("/"), F.ltrim(strip(path), F.lit("/")))


def succeeded(status: Column) -> Column:
    return F.coalesce(status < 400, F.lit(False))


def zone_label(zone: Column) -> Column:
    """Zone a response named, or ``missing`` when it named none."""
    return F.coalesce(F.nullif(zone, F.lit("")), F.lit(MISSING_ZONE))


def zone_of_metadata(path: Column) -> Column:
    """Zone of an instance: last segment of its metadata path, ``unknown`` without one."""
    return F.coalesce(F.nullif(F.substring_index(strip(path), "/", -1), F.lit("")), F.lit(UNKNOWN_ZONE))


def error_label(status: Column, error: Column) -> Column:
    """``http_<code>`` for an answered failure, else the error's class name; NULL for a success."""
    return F.when(status >= 400, F.concat(F.lit("http_"), status.cast("string"))).when(
        status.isNull(), F.substring_index(error, ":", 1)
    )

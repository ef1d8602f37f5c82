"""The request log as a star: three dimensions, two facts, maintenance and audits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pagetrail.functions.logs import UNKNOWN, blank_to
from pagetrail.session import materialize

NO_IP = "0.0.0.0"
NO_TIME = "00:00:00"
# Surrogate ids are dealt out in this many independent lanes.
ID_LANES = 4096
DEMOGRAPHIC_KEY = ["gender", "age", "income"]
CASE_AND_ACCENT_BLIND = "UNICODE_CI_AI"


@dataclass
class Star:
    countries: DataFrame
    ip_addresses: DataFrame
    demographics: DataFrame
    request_events: DataFrame
    failed_request_events: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def country_name() -> Column:
    return blank_to(F.col("country"), UNKNOWN)


def normal_ip() -> Column:
    return blank_to(F.col("client_ip"), NO_IP)


def _collated(value: Column, collation: str | None) -> Column:
    return F.collate(value, collation) if collation else value


def with_ids(rows: DataFrame, keys: list[str], id_name: str, existing: DataFrame | None = None) -> DataFrame:
    """``rows`` (distinct ``keys``, other columns carried) with a unique bigint id each, the same on every run.

    Keys hash into lanes and are numbered inside their lane, so no task sees all keys and no two keys share an id.
    ``existing`` holds ids already taken; numbering goes on above them.
    """
    lane = F.pmod(F.xxhash64(*keys), F.lit(ID_LANES))
    order = Window.partitionBy("_lane").orderBy(*keys)
    numbered = rows.withColumn("_lane", lane).withColumn("_place", F.row_number().over(order).cast("bigint"))
    start = F.lit(0)
    if existing is not None:
        place = F.floor((F.col(id_name) - 1) / ID_LANES) + 1
        taken = existing.groupBy(F.pmod(F.col(id_name) - 1, F.lit(ID_LANES)).alias("_lane")).agg(
            F.max(place).alias("_taken")
        )
        # at most ID_LANES rows
        numbered = numbered.join(F.broadcast(taken), "_lane", "left")
        start = F.coalesce("_taken", F.lit(0))
    number = (start + F.col("_place") - 1) * ID_LANES + F.col("_lane") + 1
    return numbered.select(number.cast("bigint").alias(id_name), *rows.columns)


def spellings(rows: DataFrame, collation: str | None = None) -> DataFrame:
    """Distinct rows. Those whose strings compare equal under ``collation`` become one, with the smallest spelling of each."""
    if not collation:
        return rows.distinct()
    text = [f.name for f in rows.schema if isinstance(f.dataType, StringType)]
    keys = [_collated(F.col(name), collation).alias(f"_{name}") if name in text else F.col(name) for name in rows.columns]
    grouped = rows.groupBy(*keys).agg(*(F.min(name).alias(name) for name in text))
    return grouped.select(*rows.columns)


def dim_countries(logs: DataFrame, collation: str | None = None) -> DataFrame:
    """(country_id, country_name)."""
    names = logs.select(country_name().alias("country_name"))
    return with_ids(spellings(names, collation), ["country_name"], "country_id")


def modal_country(logs: DataFrame, collation: str | None = None) -> DataFrame:
    """(client_ip, country_name): most frequent country of each IP, ties to the smallest name.

    Rows are reduced to one per IP and country first; the rank filter then runs before and after the exchange.
    """
    named = logs.select(normal_ip().alias("client_ip"), country_name().alias("country_name"))
    key = [_collated(F.col(name), collation).alias(f"_{name}") for name in named.columns]
    pairs = named.groupBy(*key).agg(F.count("*").alias("cnt"), *(F.min(name).alias(name) for name in named.columns))
    order = Window.partitionBy("_client_ip").orderBy(F.desc("cnt"), F.asc("country_name"))
    ranked = pairs.withColumn("rn", F.row_number().over(order))
    return ranked.filter("rn = 1").select("client_ip", "country_name")


def _country_ids(logs: DataFrame, countries: DataFrame, collation: str | None) -> DataFrame:
    """(client_ip, country_id) of the modal countries."""
    modal = modal_country(logs, collation)
    return modal.join(countries, same_keys(modal, countries, ["country_name"], collation)).select("client_ip", "country_id")


def dim_ip_addresses(logs: DataFrame, countries: DataFrame, collation: str | None = None) -> DataFrame:
    """(ip_id, client_ip, country_id)."""
    return with_ids(_country_ids(logs, countries, collation), ["client_ip"], "ip_id")


def demographic_keys(logs: DataFrame, collation: str | None = None) -> DataFrame:
    """Distinct (gender, age, income); a missing age is one value."""
    keys = logs.select(
        blank_to(F.col("gender"), UNKNOWN).alias("gender"), "age", blank_to(F.col("income"), UNKNOWN).alias("income")
    )
    return spellings(keys, collation)


def dim_demographics(logs: DataFrame, collation: str | None = None) -> DataFrame:
    """(demographic_id, gender, age, income)."""
    return with_ids(demographic_keys(logs, collation), DEMOGRAPHIC_KEY, "demographic_id")


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], collation: str | None = None) -> Column:
    condition = F.lit(True)
    for key in keys:
        text = collation if isinstance(left.schema[key].dataType, StringType) else None
        condition = condition & _collated(left[key], text).eqNullSafe(_collated(right[key], text))
    return condition


def merge_dimension(existing: DataFrame, incoming_keys: DataFrame, id_name: str, collation: str | None = None) -> DataFrame:
    """Insert-ignore: ``existing`` plus a row for each incoming key not in it yet. NULLs count as equal."""
    keys = [name for name in existing.columns if name != id_name]
    # both sides are read several times below
    existing = materialize(existing, "dimension")
    fresh = materialize(spellings(incoming_keys.select(*keys), collation), "incoming-keys")
    unseen = fresh.join(existing, same_keys(fresh, existing, keys, collation), "left_anti")
    return existing.unionByName(with_ids(unseen, keys, id_name, existing))


def upsert_ip_addresses(existing: DataFrame, incoming: DataFrame, collation: str | None = None) -> DataFrame:
    """Upsert: (ip_id, client_ip, country_id) with ``incoming`` (client_ip, country_id) replacing or adding countries."""
    # both sides are read several times below
    existing, incoming = materialize(existing, "dimension"), materialize(incoming, "incoming")
    fresh = incoming.select(F.col("client_ip").alias("_ip"), F.col("country_id").alias("_new"))
    same = _collated(F.col("client_ip"), collation).eqNullSafe(_collated(F.col("_ip"), collation))
    updated = existing.join(fresh, same, "left").select(
        "ip_id", "client_ip", F.coalesce("_new", "country_id").alias("country_id")
    )
    added = incoming.join(existing, same_keys(incoming, existing, ["client_ip"], collation), "left_anti")
    return updated.unionByName(with_ids(added.select("client_ip", "country_id"), ["client_ip"], "ip_id", existing))


def fact_request_events(
    logs: DataFrame, ip_addresses: DataFrame, demographics: DataFrame, collation: str | None = None
) -> DataFrame:
    """(event_id, ip_id, demographic_id, is_banned, time_of_day, requested_file, request_time), one per log row."""
    rows = logs.select(
        F.col("id").alias("event_id"),
        normal_ip().alias("client_ip"),
        blank_to(F.col("gender"), UNKNOWN).alias("gender"),
        "age",
        blank_to(F.col("income"), UNKNOWN).alias("income"),
        "is_banned",
        blank_to(F.col("time_of_day"), NO_TIME).alias("time_of_day"),
        F.coalesce("requested_file", F.lit("")).alias("requested_file"),
        "request_time",
    )
    known = ip_addresses.select(F.col("client_ip").alias("_ip"), "ip_id")
    same_ip = _collated(F.col("client_ip"), collation) == _collated(F.col("_ip"), collation)
    with_ip = rows.join(known, same_ip).drop("_ip")
    return with_ip.join(demographics, same_keys(with_ip, demographics, DEMOGRAPHIC_KEY, collation)).select(
        "event_id", "ip_id", "demographic_id", "is_banned", "time_of_day", "requested_file", "request_time"
    )


def fact_failed_events(failed: DataFrame) -> DataFrame:
    """(failed_event_id, request_time, requested_file, error_code)."""
    return failed.select(F.col("id").alias("failed_event_id"), "request_time", "requested_file", "error_code")


def build_star(logs: DataFrame, failed: DataFrame, existing: Star | None = None, collation: str | None = None) -> Star:
    """The five tables. With ``existing`` its dimensions are extended and keep their ids; facts are built anew.

    Under a ``collation`` strings that compare equal are one key in all dimensions, shown in the smallest spelling; None
    compares bytes.

    Dimensions are written before the facts use them, so each is computed from the log once.
    """
    if existing is None:
        countries = materialize(dim_countries(logs, collation), "countries")
        ip_addresses = dim_ip_addresses(logs, countries, collation)
        demographics = dim_demographics(logs, collation)
    else:
        names = logs.select(country_name().alias("country_name"))
        countries = materialize(merge_dimension(existing.countries, names, "country_id", collation), "countries")
        placed = _country_ids(logs, countries, collation)
        ip_addresses = upsert_ip_addresses(existing.ip_addresses, placed, collation)
        keys = demographic_keys(logs, collation)
        demographics = merge_dimension(existing.demographics, keys, "demographic_id", collation)
    ip_addresses = materialize(ip_addresses, "ip-addresses")
    demographics = materialize(demographics, "demographics")
    return Star(
        countries,
        ip_addresses,
        demographics,
        fact_request_events(logs, ip_addresses, demographics, collation),
        fact_failed_events(failed),
    )


def denormalize(star: Star) -> DataFrame:
    """Facts with their dimension values; country is the modal country of the IP, not the logged one."""
    located = star.ip_addresses.join(star.countries, "country_id").select(
        "ip_id", "client_ip", F.col("country_name").alias("country")
    )
    return (
        star.request_events.join(located, "ip_id")
        .join(star.demographics, "demographic_id")
        .select(
            "event_id",
            "client_ip",
            "country",
            "gender",
            "age",
            "income",
            "is_banned",
            "time_of_day",
            "requested_file",
            "request_time",
        )
    )


def ip_conflicts(logs: DataFrame) -> DataFrame:
    """One row: IPs logged with more than one country, on the columns as logged."""
    pairs = logs.select("client_ip", "country").filter("country IS NOT NULL").distinct()
    per_ip = pairs.groupBy("client_ip").agg(F.count("*").alias("countries"))
    return per_ip.filter("countries > 1").agg(F.count("*").alias("ip_conflicts_in_source"))


def row_counts(star: Star) -> DataFrame:
    """(table_name, n)."""
    counts = None
    for name, table in star.tables().items():
        one = table.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts

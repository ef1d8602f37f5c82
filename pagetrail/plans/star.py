"""Registered queries over the star. Surrogate ids are arbitrary, so results show natural keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagetrail.adapters import duckdb, request_logs
from pagetrail.operators import star as ops
from pagetrail.plans.requests import FAILED_LOG_SQL, REQUEST_LOG_SQL, ROUTED_CTES, build_failed_log, build_request_log
from pagetrail.session import scratch_path
from pagetrail.sources import tables


def star_of(spark, sf_dir):
    return ops.build_star(request_logs(spark, sf_dir), build_failed_log(spark, sf_dir))


def dim_countries(spark, sf_dir):
    return ops.dim_countries(request_logs(spark, sf_dir)).select("country_name")


def _placed(ip_addresses, countries):
    return ip_addresses.join(countries, "country_id").select("client_ip", "country_name")


def dim_ip_addresses(spark, sf_dir):
    logs = request_logs(spark, sf_dir)
    countries = ops.dim_countries(logs)
    return _placed(ops.dim_ip_addresses(logs, countries), countries)


def dim_demographics(spark, sf_dir):
    return ops.dim_demographics(request_logs(spark, sf_dir)).select(*ops.DEMOGRAPHIC_KEY)


def merge_dimension(spark, sf_dir):
    """Demographics of the log, then those of the routed requests on top."""
    existing = ops.dim_demographics(request_logs(spark, sf_dir))
    incoming = ops.demographic_keys(build_request_log(spark, sf_dir))
    return ops.merge_dimension(existing, incoming, "demographic_id").select(*ops.DEMOGRAPHIC_KEY)


def upsert_ip_addresses(spark, sf_dir):
    """IP countries of the log, replaced or joined by those of the routed requests."""
    logs, later = request_logs(spark, sf_dir), build_request_log(spark, sf_dir)
    countries = ops.dim_countries(logs)
    existing = ops.dim_ip_addresses(logs, countries)
    names = later.select(ops.country_name().alias("country_name")).distinct()
    merged = ops.merge_dimension(countries, names, "country_id")
    incoming = ops.modal_country(later).join(merged, "country_name").select("client_ip", "country_id")
    return _placed(ops.upsert_ip_addresses(existing, incoming), merged)


def fact_request_events(spark, sf_dir):
    star = star_of(spark, sf_dir)
    keyed = star.request_events.join(star.ip_addresses.drop("country_id"), "ip_id").join(
        star.demographics, "demographic_id"
    )
    return keyed.drop("ip_id", "demographic_id")


def fact_failed_events(spark, sf_dir):
    return ops.fact_failed_events(build_failed_log(spark, sf_dir))


def ip_conflicts(spark, sf_dir):
    return ops.ip_conflicts(request_logs(spark, sf_dir))


def star_row_counts(spark, sf_dir):
    return ops.row_counts(star_of(spark, sf_dir))


def star_denormalize(spark, sf_dir):
    return ops.denormalize(star_of(spark, sf_dir))


def star_collated(spark, sf_dir):
    """The star of a log that spells every country, gender and income in three ways, re-joined."""
    logs = request_logs(spark, sf_dir).withColumns({name: _spelled(name) for name in ("country", "gender", "income")})
    return ops.denormalize(ops.build_star(logs, build_failed_log(spark, sf_dir), collation=ops.CASE_AND_ACCENT_BLIND))


def _spelled(name):
    text = F.col(name)
    return F.when(F.col("id") % 3 == 0, F.upper(text)).when(F.col("id") % 3 == 1, F.translate(text, "ae", "áé")).otherwise(text)


def ip_upsert_partial(spark, sf_dir):
    """The IPs of the log in a table by key hash, of which ten are replaced or added; rows and rewritten folders."""
    logs = request_logs(spark, sf_dir)
    path = scratch_path(spark, "ip-table")
    stored = ops.modal_country(logs)
    tables.write_keyed(stored, path, ["client_ip"])
    number = F.concat(F.lit("10.0.0."), F.col("id").cast("string"))
    changed = spark.range(60, 70).select(number.alias("client_ip"), F.lit("Chile").alias("country_name"))
    folders = len(tables.upsert_keyed(changed, path, ["client_ip"]))
    return tables.read_keyed(spark, path).withColumn("few_folders", F.lit(folders <= 10))


QUERIES = {
    f.__name__: f
    for f in (
        dim_countries, dim_ip_addresses, dim_demographics, merge_dimension, upsert_ip_addresses, fact_request_events,
        fact_failed_events, ip_conflicts, star_row_counts, star_denormalize, star_collated, ip_upsert_partial,
    )
}


# What stands in place of a missing or empty field.
_COUNTRY = "COALESCE(NULLIF(country, ''), 'Unknown')"
_IP = "COALESCE(NULLIF(client_ip, ''), '0.0.0.0')"
_GENDER = "COALESCE(NULLIF(gender, ''), 'Unknown')"
_INCOME = "COALESCE(NULLIF(income, ''), 'Unknown')"
_TIME = "COALESCE(NULLIF(time_of_day, ''), '00:00:00')"


def _ips(source: str) -> str:
    """The most frequent country of each address, of equals the first by name."""
    return f"""SELECT client_ip, country_name FROM (
        SELECT {_IP} AS client_ip, {_COUNTRY} AS country_name, COUNT(*) AS n FROM {source} GROUP BY 1, 2)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY client_ip ORDER BY n DESC, country_name) = 1"""


def _demographics(source: str) -> str:
    return f"SELECT DISTINCT {_GENDER} AS gender, age, {_INCOME} AS income FROM {source}"


_COUNTRIES = f"SELECT DISTINCT {_COUNTRY} AS country_name FROM request_logs"
_FACTS = f"""SELECT id AS event_id, {_IP} AS client_ip, {_GENDER} AS gender, age, {_INCOME} AS income, is_banned,
    {_TIME} AS time_of_day, COALESCE(requested_file, '') AS requested_file, request_time FROM request_logs"""
STAR_CTES = {"ips": _ips("request_logs"), "demographics": _demographics("request_logs"), "facts": _FACTS}
DENORMALIZED_SQL = """SELECT event_id, client_ip, country_name AS country, gender, age, income, is_banned, time_of_day,
    requested_file, request_time FROM facts JOIN ips USING (client_ip)"""

_SPELLED = "SELECT * REPLACE (" + ", ".join(
    f"CASE id % 3 WHEN 0 THEN upper({name}) WHEN 1 THEN translate({name}, 'ae', 'áé') ELSE {name} END AS {name}"
    for name in ("country", "gender", "income")) + ") FROM request_logs"
_KEPT = f"""SELECT id, {_IP} AS client_ip, age, is_banned, {_TIME} AS time_of_day, COALESCE(requested_file, '') AS requested_file, request_time,
    {_COUNTRY} AS country_, {_GENDER} AS gender_, {_INCOME} AS income_, lower(strip_accents({_COUNTRY})) AS country,
    lower(strip_accents({_GENDER})) AS gender, lower(strip_accents({_INCOME})) AS income FROM spelled"""

ORACLE = {
    "dim_countries": duckdb(_COUNTRIES, "request_logs"),
    "dim_ip_addresses": duckdb(_ips("request_logs"), "request_logs"),
    "dim_demographics": duckdb(_demographics("request_logs"), "request_logs"),
    "merge_dimension": duckdb(
        f"{_demographics('request_logs')} UNION {_demographics('later')}",
        "request_logs", "http_requests", **ROUTED_CTES, later=REQUEST_LOG_SQL),
    "upsert_ip_addresses": duckdb(
        """SELECT client_ip, country_name FROM incoming
           UNION ALL SELECT client_ip, country_name FROM existing WHERE client_ip NOT IN (SELECT client_ip FROM incoming)""",
        "request_logs", "http_requests", **ROUTED_CTES, later=REQUEST_LOG_SQL,
        existing=_ips("request_logs"), incoming=_ips("later")),
    "fact_request_events": duckdb("SELECT * FROM facts", "request_logs", **STAR_CTES),
    "fact_failed_events": duckdb(
        "SELECT id AS failed_event_id, request_time, requested_file, error_code FROM failed",
        "http_requests", **ROUTED_CTES, failed=FAILED_LOG_SQL),
    "ip_conflicts": duckdb(
        """SELECT COUNT(*) AS ip_conflicts_in_source
           FROM (SELECT client_ip FROM request_logs GROUP BY client_ip HAVING COUNT(DISTINCT country) > 1)""",
        "request_logs"),
    "star_row_counts": duckdb(
        """SELECT 'countries' AS table_name, COUNT(*) AS n FROM countries UNION ALL SELECT 'ip_addresses', COUNT(*) FROM ips
           UNION ALL SELECT 'demographics', COUNT(*) FROM demographics
           UNION ALL SELECT 'request_events', COUNT(*) FROM facts
           UNION ALL SELECT 'failed_request_events', COUNT(*) FROM failed""",
        "request_logs", "http_requests", **ROUTED_CTES, failed=FAILED_LOG_SQL, countries=_COUNTRIES, **STAR_CTES),
    "star_denormalize": duckdb(DENORMALIZED_SQL, "request_logs", **STAR_CTES),
    "star_collated": duckdb(
        """SELECT k.id AS event_id, k.client_ip, c.shown AS country, g.shown AS gender, k.age, i.shown AS income, is_banned, time_of_day,
             requested_file, request_time
           FROM kept k JOIN ips ON ips.client_ip = k.client_ip JOIN names c ON c.kind = 'c' AND c.folded = ips.folded
           JOIN names g ON g.kind = 'g' AND g.folded = k.gender AND g.age IS NOT DISTINCT FROM k.age AND g.other = k.income
           JOIN names i ON i.kind = 'i' AND i.folded = k.income AND i.age IS NOT DISTINCT FROM k.age AND i.other = k.gender""",
        "request_logs", spelled=_SPELLED, kept=_KEPT,
        ips="""SELECT client_ip, folded FROM (SELECT client_ip, country AS folded, COUNT(*) AS n, MIN(country_) AS shown FROM kept GROUP BY 1, 2)
               QUALIFY ROW_NUMBER() OVER (PARTITION BY client_ip ORDER BY n DESC, shown) = 1""",
        names="""SELECT 'c' AS kind, country AS folded, NULL AS age, NULL AS other, MIN(country_) AS shown FROM kept GROUP BY 2
                 UNION ALL SELECT 'g', gender, age, income, MIN(gender_) FROM kept GROUP BY 2, 3, 4
                 UNION ALL SELECT 'i', income, age, gender, MIN(income_) FROM kept GROUP BY 2, 3, 4"""),
    "ip_upsert_partial": duckdb(
        """SELECT client_ip, country_name, TRUE AS few_folders FROM ips WHERE client_ip NOT IN (SELECT client_ip FROM changed)
           UNION ALL SELECT client_ip, 'Chile', TRUE FROM changed""",
        "request_logs", ips=_ips("request_logs"), changed="SELECT '10.0.0.' || i AS client_ip FROM range(60, 70) r(i)"),
}

"""Registered queries of the usage report."""

from __future__ import annotations

from pagetrail.adapters import duckdb, request_logs
from pagetrail.operators import stats
from pagetrail.plans.requests import FAILED_LOG_SQL, ROUTED_CTES, build_failed_log


def stats_success_vs_failure(spark, sf_dir):
    return stats.success_vs_failure(request_logs(spark, sf_dir), build_failed_log(spark, sf_dir))


def stats_banned_requests(spark, sf_dir):
    return stats.banned_requests(request_logs(spark, sf_dir))


def stats_by_gender(spark, sf_dir):
    return stats.by_gender(request_logs(spark, sf_dir))


def stats_top_countries(spark, sf_dir):
    return stats.top_countries(request_logs(spark, sf_dir))


def stats_top_age_group(spark, sf_dir):
    return stats.top_age_group(request_logs(spark, sf_dir))


def stats_top_income_group(spark, sf_dir):
    return stats.top_income_group(request_logs(spark, sf_dir))


def stats_report(spark, sf_dir):
    return stats.stats_report(request_logs(spark, sf_dir), build_failed_log(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        stats_success_vs_failure, stats_banned_requests, stats_by_gender, stats_top_countries, stats_top_age_group,
        stats_top_income_group, stats_report,
    )
}

# The age groups of the report.
AGE_GROUP_SQL = "CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 18 THEN '0-17' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' ELSE '55+' END"
_COMPARED = """SELECT r.n - f.n AS successful, f.n AS unsuccessful
    FROM (SELECT COUNT(*) AS n FROM request_logs) r, (SELECT COUNT(*) AS n FROM failed) f"""
_BANNED = "SELECT COUNT(*) AS banned_requests FROM request_logs WHERE is_banned"
_GENDER = "SELECT gender, COUNT(*) AS count FROM request_logs GROUP BY 1"
_COUNTRY = "SELECT country, COUNT(*) AS count FROM request_logs GROUP BY 1 ORDER BY count DESC, country LIMIT 5"
_AGE = f"SELECT {AGE_GROUP_SQL} AS age_group, COUNT(*) AS count FROM request_logs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"
_INCOME = "SELECT income, COUNT(*) AS count FROM request_logs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"
_FAILED = {**ROUTED_CTES, "failed": FAILED_LOG_SQL}


def _line(position: int, name: str, source: str, order: str, *columns: str) -> str:
    fields = ", ".join(f"'{column}', {column}" for column in columns)
    rows = f"string_agg(CAST(json_object({fields}) AS VARCHAR), ',' ORDER BY {order})"
    return f"SELECT {position} AS position, '{name}' AS metric, '[' || {rows} || ']' AS \"rows\" FROM ({source})"


ORACLE = {
    "stats_success_vs_failure": duckdb(_COMPARED, "request_logs", "http_requests", **_FAILED),
    "stats_banned_requests": duckdb(_BANNED, "request_logs"),
    "stats_by_gender": duckdb(_GENDER, "request_logs"),
    "stats_top_countries": duckdb(_COUNTRY, "request_logs"),
    "stats_top_age_group": duckdb(_AGE, "request_logs"),
    "stats_top_income_group": duckdb(_INCOME, "request_logs"),
    "stats_report": duckdb(
        " UNION ALL ".join([
            _line(1, "success_vs_failure", _COMPARED, "successful", "successful", "unsuccessful"),
            _line(2, "banned_requests", _BANNED, "banned_requests", "banned_requests"),
            _line(3, "male_vs_female", _GENDER, "count DESC, gender", "gender", "count"),
            _line(4, "top_5_countries", _COUNTRY, "count DESC, country", "country", "count"),
            _line(5, "top_age_group", _AGE, "count DESC", "age_group", "count"),
            _line(6, "top_income_group", _INCOME, "count DESC", "income", "count"),
        ]), "request_logs", "http_requests", **_FAILED),
}

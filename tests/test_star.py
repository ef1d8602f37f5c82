from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagetrail import jobs
from pagetrail.operators import star as ops
from pagetrail.operators import stats
from pagetrail.sources import tables

SCHEMA = (
    "id long, country string, client_ip string, gender string, age int, income string, is_banned boolean, "
    "time_of_day string, requested_file string, request_time timestamp"
)
NOW = datetime(2024, 1, 2, 3, 4, 5)


def log(spark, *items):
    rows = [(i, c, ip, g, a, inc, c == "Iran", "03:04:05", f"{i}.html", NOW) for i, (c, ip, g, a, inc) in enumerate(items)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def logs(spark):
    return log(
        spark,
        ("A", "1", "Male", None, "low"),
        ("A", "1", "Male", None, "low"),
        ("B", "1", "Female", 30, ""),
        ("B", "2", "", 17, "high"),
        ("A", "2", "Male", 18, "high"),
        ("", "", "Male", 55, "high"),
        ("Iran", "3", "Male", 54, "high"),
    )


@pytest.fixture(scope="module")
def failed(spark):
    return spark.createDataFrame([(9, NOW, "x", 404)], "id long, request_time timestamp, requested_file string, error_code int")


def test_dimensions_and_facts(spark, logs, failed, rows):
    star = ops.build_star(logs, failed)
    assert rows(star.countries, "country_name") == [("A",), ("B",), ("Iran",), ("Unknown",)]
    assert rows(star.demographics.filter("age IS NULL"), "gender", "income") == [("Male", "low")]
    flat = ops.denormalize(star)
    assert flat.count() == logs.count()
    assert rows(flat, "event_id", "client_ip", "country") == [
        (0, "1", "A"), (1, "1", "A"), (2, "1", "A"), (3, "2", "A"), (4, "2", "A"), (5, "0.0.0.0", "Unknown"), (6, "3", "Iran"),
    ]
    assert flat.filter("event_id = 2").first().income == "Unknown"
    assert rows(ops.row_counts(star)) == [
        ("countries", 4), ("demographics", 6), ("failed_request_events", 1), ("ip_addresses", 4), ("request_events", 7),
    ]
    assert ops.ip_conflicts(logs).first()[0] == 2


def test_ids_are_unique_and_repeatable(spark, rows):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    first, again = ops.with_ids(keys, ["k"], "kid"), ops.with_ids(keys.repartition(7), ["k"], "kid")
    assert first.select("kid").distinct().count() == 20_000
    assert first.exceptAll(again).isEmpty()
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_merge_keeps_ids_and_ignores_known_keys(spark, rows):
    schema = "demographic_id long, gender string, age int, income string"
    existing = spark.createDataFrame([(1, "Male", None, "low"), (4097, "Female", 30, "low")], schema)
    incoming = spark.createDataFrame(
        [("Male", None, "low"), ("Male", 1, "low"), ("Male", 1, "low"), ("X", None, "y")], "gender string, age int, income string"
    )
    merged = ops.merge_dimension(existing, incoming, "demographic_id")
    assert merged.count() == 4
    assert merged.select("demographic_id").distinct().count() == 4
    assert rows(merged.filter("demographic_id IN (1, 4097)"), *existing.columns) == rows(existing)
    assert merged.filter("demographic_id > 4097").count() + merged.filter("demographic_id BETWEEN 2 AND 4096").count() == 2


def test_upsert_replaces_and_adds(spark, rows):
    existing = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], "ip_id long, client_ip string, country_id long")
    incoming = spark.createDataFrame([("b", 20), ("c", 30)], "client_ip string, country_id long")
    merged = ops.upsert_ip_addresses(existing, incoming)
    assert rows(merged, "client_ip", "country_id") == [("a", 10), ("b", 20), ("c", 30)]
    assert rows(merged.filter("client_ip <> 'c'"), "client_ip", "ip_id") == [("a", 1), ("b", 2)]
    assert merged.select("ip_id").distinct().count() == 3


def test_collation(spark, rows):
    logs = log(spark, ("Iran", "1", "", None, ""), ("iran", "1", "", None, ""), ("IRÁN", "1", "", None, ""))
    assert ops.dim_countries(logs).count() == 3
    assert rows(ops.dim_countries(logs, ops.CASE_AND_ACCENT_BLIND), "country_name") == [("IRÁN",)]


def test_a_collated_star_loses_no_ip_and_no_fact(spark, failed, rows):
    spelled = log(
        spark, ("Iran", "a", "Male", 20, "low"), ("IRÁN", "A", "male", 20, "Low"), ("iran", "b", "MALE", 20, "LOW"),
        ("Peru", "b", "Male", None, "low"), ("peru", "B", "Mále", None, "low"), ("", "", "", None, ""),
    )
    star = ops.build_star(spelled, failed, collation=ops.CASE_AND_ACCENT_BLIND)
    assert rows(star.countries, "country_name") == [("IRÁN",), ("Peru",), ("Unknown",)]
    assert rows(star.ip_addresses, "client_ip") == [("0.0.0.0",), ("A",), ("B",)]
    assert rows(star.demographics, "gender", "age", "income") == [("MALE", 20, "LOW"), ("Male", None, "low"), ("Unknown", None, "Unknown")]
    flat = ops.denormalize(star)
    assert rows(flat, "event_id", "client_ip", "country") == [
        (0, "A", "IRÁN"), (1, "A", "IRÁN"), (2, "B", "Peru"), (3, "B", "Peru"), (4, "B", "Peru"), (5, "0.0.0.0", "Unknown"),
    ]
    later = log(spark, ("IRAN", "a", "mAle", 20, "lOw"), ("Chile", "c", "Male", 20, "low"))
    longer = ops.build_star(later, failed, star, ops.CASE_AND_ACCENT_BLIND)
    assert rows(longer.countries, "country_name") == [("Chile",), ("IRÁN",), ("Peru",), ("Unknown",)]
    assert longer.ip_addresses.count() == 4 and longer.demographics.count() == 3
    assert ops.denormalize(longer).count() == 2
    assert rows(star.ip_addresses, "client_ip", "ip_id") == rows(longer.ip_addresses.filter("client_ip <> 'c'"), "client_ip", "ip_id")


def test_readers_see_one_load_while_another_fails(spark, logs, failed, tmp_path, rows):
    path = f"{tmp_path}/star"
    star = ops.build_star(logs, failed)
    tables.write_star(star, path)
    before = tables.read_star(spark, path)
    broken = ops.build_star(logs.limit(3), failed)
    broken.request_events = broken.request_events.withColumn("is_banned", F.raise_error(F.lit("lost")).cast("boolean"))
    with pytest.raises(Exception, match="lost"):
        tables.write_star(broken, path)
    after = tables.read_star(spark, path)
    for name, table in after.tables().items():
        assert rows(table) == rows(before.tables()[name]) == rows(star.tables()[name])
    tables.write_star(ops.build_star(logs.limit(3), failed), path)
    assert tables.read_star(spark, path).request_events.count() == 3
    assert before.request_events.count() == logs.count()  # a reader of the load before is not disturbed
    with pytest.raises(ValueError):
        tables.read_star(spark, f"{tmp_path}/none")


def test_upsert_rewrites_only_touched_folders(spark, tmp_path, rows):
    path = f"{tmp_path}/keyed"
    stored = spark.range(5000).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v"))
    tables.write_keyed(stored.unionByName(spark.createDataFrame([(None, "old")], "k string, v string")), path, ["k"], 64)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "keyed").glob("bucket=*/*.parquet")}
    incoming = spark.createDataFrame([(str(i), "new") for i in range(4996, 5005)] + [(None, "new")], "k string, v string")
    touched = tables.upsert_keyed(incoming, path, ["k"], 64)
    assert 0 < len(touched) <= 10
    left = {f: f.stat().st_mtime_ns for f in (tmp_path / "keyed").glob("bucket=*/*.parquet")}
    same = {f.parent.name for f in files if left.get(f) == files[f]}
    assert len(same) == 64 - len(touched)
    found = tables.read_keyed(spark, path)
    assert found.count() == 5006
    assert rows(found.filter("v = 'new'"), "k") == rows(incoming, "k")
    assert tables.upsert_keyed(incoming.limit(0), path, ["k"], 64) == []


def test_stats(spark, logs, failed, rows):
    assert rows(stats.success_vs_failure(logs, failed)) == [(6, 1)]
    assert rows(stats.banned_requests(logs)) == [(1,)]
    assert [tuple(r) for r in stats.by_gender(logs).collect()] == [("Male", 5), ("", 1), ("Female", 1)]
    assert [tuple(r) for r in stats.top_countries(logs, 2).collect()] == [("A", 3), ("B", 2)]
    assert rows(stats.top_age_group(logs)) == [("Unknown", 2)]
    assert rows(stats.top_income_group(logs)) == [("high", 4)]
    report = [tuple(r) for r in stats.stats_report(logs, failed).orderBy("position").collect()]
    assert report[0] == (1, "success_vs_failure", '[{"successful":6,"unsuccessful":1}]')
    assert report[1] == (2, "banned_requests", '[{"banned_requests":1}]')
    assert report[2][2] == '[{"gender":"Male","count":5},{"gender":"","count":1},{"gender":"Female","count":1}]'
    assert [r[1] for r in report[3:]] == ["top_5_countries", "top_age_group", "top_income_group"]
    plan = stats.stats_report(logs, failed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 3 and "Window" not in plan and "time_of_day" not in plan


def test_stats_of_empty_logs(logs, failed):
    report = stats.stats_report(logs.limit(0), failed.limit(0)).orderBy("position").collect()
    assert [r.rows for r in report] == ['[{"successful":0,"unsuccessful":0}]', '[{"banned_requests":0}]', "[]", "[]", "[]", "[]"]


def test_age_group_bounds(spark):
    ages = spark.createDataFrame([(a,) for a in (0, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, None)], "age int")
    from pagetrail.functions.logs import age_group

    assert [r[0] for r in ages.select(age_group(F.col("age"))).collect()] == [
        "0-17", "0-17", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55+", "Unknown",
    ]


def test_migration_job_is_repeatable_and_extends(spark, logs, failed, tmp_path, rows):
    logs.write.parquet(f"{tmp_path}/logs/request_logs")
    failed.write.parquet(f"{tmp_path}/logs/failed_request_logs")
    for target, previous in (("one", None), ("one", None), ("two", f"{tmp_path}/one")):
        jobs.migrate(spark, f"{tmp_path}/logs", f"{tmp_path}/{target}", previous)
        star = tables.read_star(spark, f"{tmp_path}/{target}")
        assert star.request_events.count() == 7
        assert star.demographics.count() == 6
    first, second = (tables.read_star(spark, f"{tmp_path}/{t}") for t in ("one", "two"))
    assert rows(first.ip_addresses) == rows(second.ip_addresses)
    audit = [r.value for r in spark.read.text(f"{tmp_path}/two/audit").collect()]
    assert "ip_conflicts_in_source=2" in audit and "request_events=7" in audit

"""Every registered query against its SQL in DuckDB on the smallest tables, plus properties of the plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# the operators on training data have tests of their own
QUERIES, ORACLE = (
    {name: x for name, x in found.items() if not name.startswith("op") and name != "pipeline"}
    for found in (entry.queries(), entry.oracle_sql())
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, name):
    result, expected = QUERIES[name](spark, SF_DIR), duck.sql(ORACLE[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert sorted_rows(result.columns, result.collect()) == sorted_rows(expected.columns, expected.fetchall())


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"income_predicted"}


# the booster sums gradients in Arrow batches
TRAINED = {"income_model", "income_predictions", "model_metrics"}
EAGER = ("pagerank", "probe_scan", "parse_probe_log")
LAZY = sorted(name for name in set(ORACLE) - TRAINED if not name.startswith(EAGER))


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_or_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


def test_scans_read_only_what_is_used(spark):
    def plan(name):
        return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()

    assert "ReadSchema: struct<user_id:bigint>" in plan("stats_top_countries")
    assert "WindowGroupLimit" in plan("dim_ip_addresses") and "WindowGroupLimit" in plan("format_top_links")
    assert "TakeOrderedAndProject" in plan("top_bigrams")


def test_entry(spark):
    assert entry.entry(spark).count() == 5

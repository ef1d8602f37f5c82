import hashlib
import math
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagetrail import jobs
from pagetrail.operators import country, encoding, income, split
from pagetrail.operators.ranking import hash_rank
from pagetrail.plans import models


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows of which one group holds more than a third."""
    key = F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
    return spark.range(3000).select(F.col("id").alias("event_id"), key.alias("g"))


@pytest.mark.parametrize("slice_rows", [5, 100, 65_536])
def test_rank_of_a_hot_group_equals_brute_force(skewed, slice_rows):
    groups = defaultdict(list)
    for row in skewed.collect():
        groups[row.g].append((hashlib.md5(f"3:{row.event_id}".encode()).hexdigest()[:15], row.event_id))
    expected = {e: (i, len(v)) for v in groups.values() for i, (_, e) in enumerate(sorted(v), 1)}
    ranked = hash_rank(skewed, "g", "event_id", 3, slice_rows=slice_rows).collect()
    assert {r.event_id: (r["rank"], r.group_rows) for r in ranked} == expected


def test_rank_spreads_a_group_over_tasks(skewed):
    plan = hash_rank(skewed, "g", "event_id", 3)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_slice#" in plan
    row_window = [line for line in plan.splitlines() if "Window" in line and "row_number" in line]
    assert row_window and all("_slice" in line for line in row_window)


def ip_rows(spark, sizes):
    rows = [(f"ip{n}-{i}", n) for n in sizes for i in range(n)]
    data = [(i, ip.split("-")[0], "A" if n % 2 else "B") for i, (ip, n) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id long, client_ip string, country string")


def test_country_split_sizes(spark):
    parts = split.country_split(ip_rows(spark, [1, 2, 5, 10]))
    sizes = {r.client_ip: r.n for r in parts.groupBy("client_ip").agg(F.count_if("is_test").alias("n")).collect()}
    assert sizes == {"ip1": 0, "ip2": 1, "ip5": 1, "ip10": 2}


def test_country_split_falls_back_to_all_rows(spark):
    singles = spark.createDataFrame([(i, f"ip{i}", "A") for i in range(11)], "event_id long, client_ip string, country string")
    assert split.country_split(singles).filter("is_test").count() == 3


def test_split_does_not_depend_on_partitioning(spark, rows):
    data = ip_rows(spark, [7, 30])
    assert rows(split.country_split(data)) == rows(split.country_split(data.repartition(3)))


def test_country_model_at_threshold(spark):
    places = spark.range(10_000).select(
        F.col("id").alias("event_id"),
        F.concat(F.lit("10.0.0."), (F.col("id") % 50).cast("string")).alias("client_ip"),
        F.when(F.col("id") % 50 < 25, "A").otherwise("B").alias("country"),
    )
    predicted = country.country_predictions(split.country_split(places))
    assert predicted.count() == 2000
    assert country.accuracy(predicted, "country", "predicted_country").first()[0] >= 0.99


def test_unseen_ip_gets_the_majority(spark):
    parts = spark.createDataFrame(
        [(1, "a", "X", False), (2, "a", "Y", False), (3, "b", "Y", False), (4, "c", "Z", True), (5, "a", "X", True)],
        "event_id long, client_ip string, country string, is_test boolean",
    )
    assert {r.event_id: r.predicted_country for r in country.country_predictions(parts).collect()} == {4: "Y", 5: "X"}


@pytest.fixture(scope="module")
def training(spark):
    start = datetime(2025, 1, 1)
    data = []
    for i in range(2000):
        age = 20 + (i * 7) % 50
        level = ["low", "med", "high"][(age // 17) % 3 if i % 10 else i % 3]
        data.append((
            i, f"10.0.0.{i % 50}", "A" if i % 50 < 25 else "B", "MF"[i % 2], age if i % 13 else None, level, i % 20 == 0,
            (start + timedelta(minutes=i)).strftime("%H:%M:%S"), f"p{i % 10}", start + timedelta(minutes=i),
        ))
    return spark.createDataFrame(
        data,
        "event_id long, client_ip string, country string, gender string, age int, income string, is_banned boolean, "
        "time_of_day string, requested_file string, request_time timestamp",
    )


def test_income_split_is_proportional(training):
    parts = split.income_split(training)
    sizes = {r.income: (r.n, r.t) for r in parts.groupBy("income").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert sum(t for _, t in sizes.values()) == math.ceil(0.2 * 2000)
    assert all(abs(t - 0.2 * n) < 1 for n, t in sizes.values())
    assert split.split_drift(parts).first()[0] < 0.05


def test_target_encoding_equals_brute_force(training):
    train = split.with_folds(split.income_split(training).filter("NOT is_test"), "income", "event_id", 7).persist()
    classes = encoding.classes_of(train, "income")
    table = encoding.target_encode(train, "client_ip", "income", classes)
    data = [(r.client_ip, r.fold, r.income) for r in train.collect()]
    found = {(r.category, r.fold): [r[f"te{i}"] for i in range(len(classes))] for r in table.collect()}
    for (category, fold), values in found.items():
        rest = [(ip, y) for ip, f, y in data if f != fold]
        labels, own = Counter(y for _, y in rest), [y for ip, y in rest if ip == category]
        for name, value in zip(classes, values):
            prior = labels[name] / len(rest)
            if not own:
                assert value == pytest.approx(prior)
                continue
            mean = sum(y == name for y in own) / len(own)
            spread = sum(((y == name) - mean) ** 2 for y in own) / len(own)
            variance = prior * (1 - prior)
            weight = variance * len(own) / (variance * len(own) + spread)
            assert value == pytest.approx(weight * mean + (1 - weight) * prior)
    assert (None, encoding.FULL) in found
    folds = Counter((y, f) for _, f, y in data)
    assert max(folds.values()) - min(folds.values()) <= max(Counter(y for *_, y in data).values()) // 5


def test_unseen_values(spark, training):
    train = split.with_folds(training.limit(100), "income", "event_id", 7)
    classes = encoding.classes_of(train, "income")
    table = encoding.target_encode(train, "country", "income", classes)
    new = spark.createDataFrame([("Q", "?")], "country string, gender string")
    row = encoding.apply_target_encoding(new, table, "country", classes, F.lit(encoding.FULL)).first()
    counts = Counter(r.income for r in train.collect())
    assert [row[f"te_country_{i}"] for i in range(3)] == pytest.approx([counts[c] / 100 for c in classes])
    ordinals = encoding.fit_ordinals(train, ["gender"])
    assert encoding.apply_ordinals(ordinals, new, ["gender"]).first().gender_index == -1.0


def test_features(spark):
    rows = spark.createDataFrame(
        [(1, "ip", "A", "M", None, None, True, "x", None)],
        "event_id long, client_ip string, country string, gender string, age int, income string, is_banned boolean, "
        "time_of_day string, request_time timestamp",
    )
    found = income.income_features(rows).first()
    assert (found.age, found.is_banned, found.hour, found.income) == (-1, 1, -1, "Unknown")


@pytest.mark.parametrize("method", ["boosting", "forest"])
def test_income_model_beats_the_threshold(training, method):
    fitted = income.train_income_model(split.income_split(training), rounds=3, depth=3, rate=0.3, method=method)
    known = {r[0] for r in training.select("income").distinct().collect()}
    predicted = fitted.predictions.persist()
    assert predicted.count() == 400
    assert {r[0] for r in predicted.select("predicted_income").distinct().collect()} <= known
    assert country.accuracy(predicted, "actual_income", "predicted_income").first()[0] >= 0.40


def test_full_training_on_all_classes(spark, training):
    """Depth and rate of the operator; registered queries run its 300 rounds."""
    parts = split.income_split(training)
    fitted = income.train_income_model(parts, rounds=20)
    again = income.train_income_model(parts, booster=fitted.model)
    assert fitted.model.feature.shape == (20, 3, 127)
    assert sorted(fitted.predictions.collect()) == sorted(again.predictions.collect())
    assert country.accuracy(fitted.predictions, "actual_income", "predicted_income").first()[0] >= 0.40


def test_labelled_rows_are_bounded(training):
    rows = training.withColumn("features", F.array(F.lit(1.0)))
    few = income._drawn(rows, 500)
    assert 400 < few.count() < 600 and income._drawn(rows, None) is rows and income._drawn(rows, 2000) is rows
    assert sorted(r.event_id for r in few.collect()) == sorted(r.event_id for r in income._drawn(rows.repartition(7), 500).collect())


def test_too_many_classes_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(encoding, "MOST_CLASSES", 2)
    labels = spark.createDataFrame([("a",), ("b",), ("c",)], "income string")
    with pytest.raises(ValueError):
        encoding.classes_of(labels, "income")
    assert encoding.classes_of(labels.limit(2), "income") == ["a", "b"]


def test_metrics_lines():
    good, bad = income.model_metrics(1.0, 0.5), income.model_metrics(0.98765, 0.1)
    assert "country_model_accuracy=1.0000" in good and not any(line.startswith("warning=") for line in good)
    assert "country_model_accuracy=0.9877" in bad and sum(line.startswith("warning=") for line in bad) == 2


def test_training_job(spark, training, tmp_path):
    from pagetrail.operators.star import build_star
    from pagetrail.sources.tables import write_star

    logs = training.withColumnRenamed("event_id", "id")
    failed = logs.limit(0).select("id", "request_time", "requested_file", F.lit(0).alias("error_code"))
    write_star(build_star(logs, failed), f"{tmp_path}/star")
    jobs.train(spark, f"{tmp_path}/star", f"{tmp_path}/out", "demo", rounds=2, depth=3)
    places = spark.read.option("header", True).csv(f"{tmp_path}/out/demo_country_test_predictions.csv")
    incomes = spark.read.option("header", True).csv(f"{tmp_path}/out/demo_income_test_predictions.csv")
    assert places.columns == ["client_ip", "country", "predicted_country"]
    assert {"actual_income", "predicted_income", "country"} <= set(incomes.columns)
    assert 300 <= places.count() <= 500 and 300 <= incomes.count() <= 500
    text = [r.value for r in spark.read.text(f"{tmp_path}/out/demo_metrics.txt").collect()]
    assert text[0] == "data_source=database"


@pytest.fixture
def queried(spark, tmp_path):
    """Runs a query on a table of its own, whose model nothing has trained; its rows and the number of its jobs."""
    columns = {
        "event_id": "id", "ts": "timestamp_micros(1704067200000000 + id * 977000000)", "user_id": "id * id % 83",
        "event_type": "'view'", "value": "CAST(id AS DOUBLE)", "props": "''",
    }
    events = spark.range(900).selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(50).selectExpr("id AS page_id", "'u' AS url", "'' AS html").write.parquet(f"{tmp_path}/pages.parquet")

    def run(name):
        spark.sparkContext.setJobGroup(str(tmp_path), name)
        try:
            found = models.QUERIES[name](spark, str(tmp_path)).collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(tmp_path)))

    return run


def test_income_predicted_needs_no_job_for_each_level(queried):
    found, jobs = queried("income_predicted")
    assert len({row.event_id for row in found}) == len(found) == 180
    assert {row.predicted_income for row in found} <= {"low", "medium", "high", "Unknown"}
    assert jobs < 600  # a job for each level of 300 rounds were 1,800


def test_income_predictions_needs_no_job_for_each_level(queried):
    found, jobs = queried("income_predictions")
    assert len({row.event_id for row in found}) == len(found) == 180
    assert all(row.predicted_is_class for row in found) and jobs < 600


def test_model_metrics_needs_no_job_for_each_level(queried):
    found, jobs = queried("model_metrics")
    assert [row.position for row in found] == list(range(1, len(found) + 1)) and len(found) >= 6
    assert found[3].line.startswith("income_model_accuracy ") and jobs < 600

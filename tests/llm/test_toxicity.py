import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetrail.llm import toxicity

R = random.Random(2)
WORDS = ["".join(R.choices("abcdefghij", k=5)) for _ in range(600)]
INSULTS, GROUPS = ["nitwit", "dunce", "oaf"], ["northerners", "southerners"]


def text(toxic):
    """An insult together with a group is toxic; either alone is not."""
    body = R.choices(WORDS, k=R.randint(30, 200))
    body += [R.choice(INSULTS), R.choice(GROUPS)] if toxic else R.choice([[], [R.choice(INSULTS)], [R.choice(GROUPS)]])
    R.shuffle(body)
    return " ".join(body)


@pytest.fixture(scope="module")
def rows(spark):
    made = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(1800)]
    return spark.createDataFrame(made, "doc_id bigint, text string, toxic int")


def test_learns_pairs_of_terms(rows):
    model = toxicity.fit(rows, learn_from=F.col("doc_id") < 1400, rounds=8)
    found = toxicity.predict(rows.filter("doc_id >= 1400"), model).toPandas()
    assert (found.predicted == found.toxic).mean() > 0.95
    assert found.score.between(0, 1).all() and ((found.score >= 0.5) == (found.predicted == 1)).all()
    linear = model._replace(factors=np.zeros_like(model.factors))
    plain = toxicity.predict(rows.filter("doc_id >= 1400"), linear).toPandas()
    assert (plain.predicted == plain.toxic).mean() < (found.predicted == found.toxic).mean()


def test_scores_equal_the_formula(rows):
    model = toxicity.fit(rows.limit(300))
    sample = rows.limit(5).toPandas().text.tolist()
    import pyarrow as pa

    held = toxicity._filter(model.terms)
    scores = toxicity._scores(pa.array(sample), model, held)
    owner, at, x = toxicity._vectors(pa.array(sample), model.terms, held)
    for i in range(5):
        k, v = at[owner == i], x[owner == i]
        raw = model.constant + sum(model.weights[k] * v)
        raw += sum(model.factors[k[a]] @ model.factors[k[b]] * v[a] * v[b] for a in range(len(k)) for b in range(a))
        assert scores[i] == pytest.approx(1 / (1 + np.exp(-raw)))


def test_odd_rows(spark, rows):
    odd = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (None, "x " * 50_000, "c"), (2, "", "b")], "doc_id bigint, text string, score string"
    )
    model = toxicity.fit(rows.limit(200))
    found = toxicity.predict(odd, model).collect()
    assert len(found) == 4 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
    assert found[0].score == found[1].score == found[3].score
    nothing = toxicity.fit(rows.limit(0))
    assert {r.predicted for r in toxicity.predict(odd, nothing).collect()} == {0}
    assert toxicity.predict(odd.limit(0), model).count() == 0
    unlabelled = toxicity.fit(rows.withColumn("toxic", F.lit(None).cast("int")))
    assert not len(unlabelled.terms)


def test_held_out_accuracy(spark):
    docs = toxicity.op2_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    found = docs.filter("held_out").join(labels, "doc_id").toPandas()
    assert found[found.toxic == 1].predicted.mean() > 0.85
    assert found[found.toxic == 0].predicted.mean() < 0.02

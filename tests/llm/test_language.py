import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pagetrail.llm import language


def test_held_out_accuracy(spark):
    found = language.op5_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = found.join(truth, "doc_id").toPandas()
    held = found[found.held_out]
    assert len(found) == 1000 and 200 < len(held) < 300
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert found.score.between(0, 1).all() and held.score.mean() > 0.95


def test_counts_by_brute_force():
    texts = ["Ab1 c", "é", "", None, "  12 ", "a-b-c" * 900]
    for text, found in zip(texts, language.counts(pa.array(texts)), strict=True):
        points = []
        for c in (text or "").lower():
            if c.isalpha():
                points.append(c)
            elif not points or points[-1] != " ":
                points.append(" ")
        if not any(c != " " for c in points):
            assert found is None
            continue
        grams = ["".join(points[i : i + n]) for n in (1, 2, 3) for i in range(len(points) - n + 1)]
        hashed = np.concatenate([language._grams(np.frombuffer(g.encode("utf-32-le"), np.uint32), len(g)) for g in grams])
        at, times = np.unique(hashed, return_counts=True)
        assert found[0].tolist() == at.tolist() and found[1].tolist() == times.tolist()


def test_long_texts_are_counted_by_pieces(monkeypatch):
    text = "Ein langer, langer Text -- ohne Ende! " * 40
    whole = next(language.counts(pa.array([text])))
    monkeypatch.setattr(language, "SLICE_BYTES", 11)
    pieces = next(language.counts(pa.array([text])))
    assert pieces[0].tolist() == whole[0].tolist() and pieces[1].tolist() == whole[1].tolist()


def test_odd_rows_and_columns(spark):
    rows = [(i, f"{'the quick brown fox' if i % 2 else 'der schnelle braune fuchs'} {i}", "en" if i % 2 else "de") for i in range(60)]
    rows += [(None, None, "en"), (61, "", "de"), (62, "123 !!", "en"), (63, "the fox", None), (63, "the fox", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("mine"))
    model = language.fit(docs)
    found = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert [found[i].lang_pred for i in (None, 61, 62, 63, 10, 11)] == ["und", "und", "und", "en", "de", "en"]
    assert found[62].score == 0 and 0.5 < found[63].score <= 1
    kept = language.keep_recognised(docs)
    assert kept.columns == docs.columns and kept.count() == 62 and {r.score for r in kept.collect()} == {"mine"}
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.predict(none, language.fit(none)).collect()} == {"und"}
    assert language.keep_recognised(none).count() == 62
    assert language.keep_recognised(docs.limit(0)).count() == 0


def test_one_language_only(spark):
    docs = spark.createDataFrame([(i, f"eins zwei {i}", "de") for i in range(9)], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in language.predict(docs, language.fit(docs)).collect()} == {"de"}


def test_noise_and_unknown_languages_are_rejected_and_labelled_texts_stay(spark):
    import random

    r = random.Random(1)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    noise = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)) for n in (20, 100, 500, 3000) for _ in range(10)]
    noise += ["Это русский текст о чем-то важном для всех", "これは日本語の文章です。", "zxqw kjhg qwrt plkj mnbv", "aGVsbG8gd29ybGQgdGhpcyBpcyBiYXNlNjQ="]
    odd = spark.createDataFrame([(10**9 + i, text, None, "noise", len(text)) for i, text in enumerate(noise)], docs.schema)
    kept = language.keep_recognised(docs.unionByName(odd), learn_from=~language.held_out()).select("doc_id", "lang", "n_chars").toPandas()
    assert not (kept.doc_id >= 10**9).any()
    with_letters = docs.filter(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()).select("doc_id", "n_chars").toPandas()
    stay = with_letters.doc_id.isin(kept.doc_id)
    assert stay.mean() >= 0.999
    assert stay[with_letters.n_chars < 40].mean() >= 0.97  # short ones

import random
import re
from collections import defaultdict

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pagetrail.llm import tokens

R = random.Random(4)
SYLLABLES = {"en": "the and that with from this have are was for", "de": "der die und das ist nicht mit ein den von"}
MADE = {lang: [a + b for a in x.split() for b in x.split()] for lang, x in SYLLABLES.items()}


def text(lang, n):
    return " ".join(R.choice(MADE[lang] + SYLLABLES[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    items = [text("en", 20) for _ in range(3)]
    rows = [(i, text(lang, R.randint(30, 120)), lang) for i in range(120) for lang in [R.choice(["en", "de"])]]
    clean = len(rows)
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(10)]  # copies
    rows += [(300 + i, rows[i][1] + " extra", rows[i][2]) for i in range(10, 20)]  # near copies
    rows += [(400 + i, f"{text('en', 20)} {items[i % 3]} {text('en', 20)}", "en") for i in range(6)]  # leaks
    rows += [(500 + i, f"{text('de', 30)} mail u{i}@private.com {text('de', 30)}", "de") for i in range(6)]
    rows += [(600, None, "en"), (601, "", "de"), (602, "123 456 --", "en")]
    docs = [(i, t, lang, "s", len(t or "")) for i, t, lang in rows]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), {i: t for i, t, _ in rows}, clean


def test_stages_by_brute_force(spark, tables, tmp_path):
    folder, texts, clean = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    expected = [
        set(texts) - {600, 601, 602},
        set(range(clean)) | set(range(400, 406)) | set(range(500, 506)),
        set(range(clean)) | set(range(500, 506)),
        set(range(clean)) | set(range(500, 506)),
    ]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == columns and {r.doc_id for r in docs.collect()} == expected[k], name
    kept = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    for i, r in kept.items():
        if i < 500:
            assert r.text == texts[i]
        else:
            assert "private.com" not in r.text and r.n_chars == len(r.text) and "@" in r.text
    decoder = tokens._encoder(open(tokens.vocabulary_path(), "rb").read(), tokens.SPLIT)[0]
    filled = defaultdict(list)
    for r in sorted(docs.collect(), key=lambda r: (r.doc_id, r.piece)):
        assert len(r.token_ids) == r.n_tokens
        filled[r.doc_id] += r.token_ids
    assert {i: decoder.decode(ids) for i, ids in filled.items()} == {i: r.text for i, r in kept.items()}


def test_run_and_registration(spark, tables):
    folder, _, clean = tables
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == set(range(clean)) | set(range(500, 506))
    registered = entry.queries()
    assert registered["pipeline"] is corpus_pipeline.run
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registered if re.match(r"op\d+_", n))
    assert numbers == list(range(1, 14))


def test_empty_tables(spark, tables, tmp_path):
    folder = tables[0]
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

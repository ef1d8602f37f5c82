import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetrail.llm import jaccard as j

R = random.Random(8)
VOCABULARY = ["".join(R.choices("abcdefgh", k=6)) for _ in range(3000)]


def changed(words, n):
    words = list(words)
    for _ in range(n):
        words[R.randrange(len(words))] = R.choice(VOCABULARY)
    return words


def corpus():
    base = R.choices(VOCABULARY, k=120)
    texts = [" ".join(changed(base, R.randint(0, 6))) for _ in range(90)]  # a large group, similar to each other to any degree
    for _ in range(25):
        own = R.choices(VOCABULARY, k=R.randint(6, 150))
        texts += [" ".join(own), " ".join(changed(own, 1)), " ".join(own).upper() + "!", " ".join(changed(own, 4))]
    texts += ["same text", "same text", "Same, text.", "one", "one", "two", "", "", "...", "...", None, None]
    texts += [" ".join(R.choices(VOCABULARY, k=n)) for n in (1, 3, 4, 5, 6, 30_000)]
    return list(enumerate(texts)) + [(None, "without an id"), (None, "without an id"), (7, texts[7])]


def shingles(text):
    words = re.findall(r"[0-9A-Za-z_\x80-\U0010ffff]+", (text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """Number of links and smallest id of the component of each row."""
    sets = [shingles(t) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            parent[find(b)] = find(a)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        root = find(k)
        smallest[root] = min((x for x in (smallest.get(root), i) if x is not None), default=None)
    return [(i, links[k], smallest[find(k)]) for k, (i, _) in enumerate(rows)]


ROWS = corpus()


@pytest.fixture
def table(spark, tmp_path):
    spark.createDataFrame(ROWS, "doc_id bigint, text string").withColumn("class_key", F.lit("x")).repartition(5).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    return str(tmp_path)


@pytest.mark.parametrize("blocks", [(1024, 2_000_000), (10, 2_000_000), (1024, 700)])
def test_equals_brute_force(spark, table, blocks, monkeypatch):
    monkeypatch.setattr(j, "BLOCK_CLASSES", blocks[0])
    monkeypatch.setattr(j, "BLOCK_GRAMS", blocks[1])
    found = j.op9_ngram_jaccard_join(spark, table).collect()
    assert Counter((r.doc_id, r.n_links, r.component_id) for r in found) == Counter(brute(ROWS))


def test_keeps_one_document_of_each_component(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet").withColumn("_text", F.lit("mine"))
    kept = j.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    expected = Counter()
    seen = set()
    for (i, text), (_, _, component) in zip(ROWS, brute(ROWS)):
        if not shingles(text):
            expected[i] += 1
        elif i == component and (i, text) not in seen:
            seen.add((i, text))
            expected[i] += 1
    assert Counter(r.doc_id for r in kept.collect()) == expected
    assert j.keep_one_of_each(docs.limit(0)).count() == 0


def test_bands_reach_the_recall():
    for similarity, recall in ((0.8, 0.998), (0.9, 0.99), (0.5, 0.9), (1.0, 0.99)):
        bands, rows = j.plan_bands(similarity, recall)
        assert 1 - (1 - similarity**rows) ** bands >= recall and bands * rows <= j.MOST_HASHES
    with pytest.raises(ValueError):
        j.plan_bands(0.01, 0.999)


@pytest.mark.parametrize("seed", range(6))
def test_common_by_brute_force(seed):
    r = np.random.default_rng(seed)
    sets = [np.unique(r.integers(0, 40 if seed % 2 else 4000, r.integers(1, 300)).astype(np.uint32)) for _ in range(30)]
    expected = [[len(np.intersect1d(a, b)) if k != m else 0 for m, b in enumerate(sets)] for k, a in enumerate(sets)]
    found = j._common(sets)
    np.fill_diagonal(found, 0)
    assert found.tolist() == expected


def test_hot_copies_stay_one_class(spark, tmp_path):
    rows = [(i, "the same words in every one of these many rows") for i in range(5000)] + [(i, f"own words {i} and {i} {i} {i}") for i in range(5000, 5100)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r for r in j.op9_ngram_jaccard_join(spark, str(tmp_path)).collect()}
    assert found[4999].n_links == 4999 and found[4999].component_id == found[4999].class_id == 0 and found[5050].n_links == 0

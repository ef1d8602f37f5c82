import random
import re
from collections import Counter

import numpy as np
import pytest

from pagetrail.llm import phrases as p

SCHEMA = "text string, lang string, word string, n int, words int"


def brute(docs, least, most, share, top):
    counts, totals = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, most + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    rows = []
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= share * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (other, longer), b in candidates.items()
        )
        if not inside:
            score, _, l, r = min(cuts)
            rows.append((lang, " ".join(words), a, l, r, totals[lang], score))
    out = []
    for lang in {row[0] for row in rows}:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i, *row[1:]) for i, row in enumerate(own[:top], 1)]
    return sorted(out)


def corpus():
    r = random.Random(5)
    words = ["a", "b", "C", "d", "É", "é", "x\x01", "x", "new", "york", "ä" * 30, "\x00", "one-two", "日本"]
    docs = []
    for _ in range(120):
        text = []
        for _ in range(r.randrange(40)):
            text.append(r.choice(["New York", "the new york times today", "x\x01 x", *words]))
            text.append(r.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n", "\r\n", "\x0b"]))
        docs.append(("".join(text), r.choice(["en", "en", "de", None, "und", ""])))
    docs += [(None, "en"), ("", "de"), ("  \t ", None), ("...", "xx")]
    docs += [("to be or not to be", "en")] * 9
    docs.append(("hot pair " * 3000, "de"))
    return docs


@pytest.mark.parametrize(("least", "most", "share", "top", "size"), [(3, 5, 100, 40, 50), (2, 3, 60, 7, 10**6), (9, 2, 100, 2000, 5)])
def test_equals_brute_force(spark, monkeypatch, least, most, share, top, size):
    monkeypatch.setattr(p, "SUFFIXES", size)
    docs = corpus()
    frame = spark.createDataFrame([(*doc, "w", 1, 2) for doc in docs], SCHEMA).repartition(5)
    found = p.collocations(frame, least, most, share, top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(docs, least, most, share, top)


def test_a_long_text_is_read_in_stretches(spark, rows, monkeypatch):
    docs = [("alpha beta gamma. " * 200 + "alpha beta, gamma", "en"), ("alpha beta " * 90, "en")]
    frame = spark.createDataFrame(docs, "text string, lang string")
    expected = brute(docs, 5, 5, 100, 50)
    assert rows(p.collocations(frame, 5, 5, 100, 50)) == sorted(expected, key=repr)
    monkeypatch.setattr(p, "STRETCH", 64)
    assert sum(1 for _ in p._stretches([docs[0][0]])) > 50
    whole = Counter(w for x in p._stretches([docs[0][0], docs[1][0]]) for w in p._TOKEN.findall(x) if w.isalpha())
    assert whole == {b"alpha": 291, b"beta": 291, b"gamma": 201}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "text string, lang string")
    assert p.collocations(frame).collect() == []


def test_scores_pass_64_bits(spark):
    """The product of a count and all words is exact beyond 2^63."""
    row = spark.sql("SELECT (1000BD * (CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0)))) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0))) AS s FROM VALUES (900000000001L, 80000000000003L, 2000000000007L, 1000000000009L) AS t(a, n, l, r)")
    assert row.first()["s"] == 1000 * 900000000001 * 80000000000003 // (2000000000007 * 1000000000009)


def test_quicksort_counts_prefixes():
    r = np.random.default_rng(1)
    keys = np.zeros((500, 5), np.int64)
    for row, size in zip(keys, r.integers(1, 5, 500)):
        row[:size] = r.integers(1, 4, size)
    weight = r.integers(1, 9, 500)
    expected = Counter()
    for row, w in zip(keys.tolist(), weight.tolist()):
        for k in range(2, 5):
            if row[k - 1]:
                expected[tuple(row[:k])] += w
    found = {tuple(keys[row, :depth].tolist()): total for row, depth, total in p.equal_parts(keys, weight, 40)}
    assert found == {key: n for key, n in expected.items() if n >= 40} and found


def test_a_full_field_keeps_everything(spark, rows, monkeypatch):
    """A field that is too small for the pairs lets more suffixes pass and changes nothing else."""
    docs = corpus()
    frame = spark.createDataFrame(docs, "text string, lang string")
    monkeypatch.setattr(p, "MOST_BITS", 7)
    monkeypatch.setattr(p, "LEAST_BITS", 7)
    assert sorted(map(tuple, p.collocations(frame, 3, 5, 100, 40).collect())) == brute(docs, 3, 5, 100, 40)

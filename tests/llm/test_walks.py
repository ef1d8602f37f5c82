import hashlib
import random

import numpy as np
import pytest

from pagetrail.llm import walks as w

SCHEMA = "doc_id bigint, text string, part int, ahead string"


def plain_walk(text, start=0):
    """Arrival steps by one look at a random bit per step."""
    go = np.random.default_rng(12).integers(0, 2, (w.CLASSES, w.PERIOD)).astype(bool)
    steps, step = [start], start
    for x in w.characters(text):
        own = int(w.mix(np.array([x], np.uint64))[0]) % w.CLASSES
        while not go[own, step % w.PERIOD]:
            step += 1
        step += 1
        steps.append(step)
    return steps


def edited(text, after, share=0.33):
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


def texts():
    r = random.Random(2)
    letters = "etaoin shrdlu,.éß日本\U0001f600"
    out = ["".join(r.choice(letters) for _ in range(n)) for n in (1, 2, 3, 5, 17, 64, 65, 300, 1500, 4000)]
    return [*out, "", None, "a" * 5000, out[7], out[8]]


def test_walks_equal_single_steps(monkeypatch):
    held = [x or "" for x in texts()]
    starts = np.arange(len(held)) * 1000
    for abreast in (1, 4, 10**6):
        monkeypatch.setattr(w, "ABREAST", abreast)
        found = w.walks([w.characters(x) for x in held], starts)
        assert [x.tolist() for x in found] == [plain_walk(x, start) for x, start in zip(held, starts.tolist())]


def test_query_rows(spark):
    held = texts()
    data = [(i if i != 4 else None, text, 1, "x") for i, text in enumerate(held)] + [(3, "again", 1, "x"), (9, held[9], 1, "x")]
    found = w.edited_fingerprints(spark.createDataFrame(data, SCHEMA).repartition(7)).collect()
    order = sorted(data, key=lambda x: (x[0] is None, -(x[0] or 0), (x[1] or "").encode()))
    expected = []
    for i, (doc_id, text, *_) in enumerate(order):
        after = order[(i + 1) % len(order)][1] or ""
        expected.append((doc_id, len(text or ""), hashlib.sha256(edited(text or "", after).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == sorted(expected, key=repr)
    plain = {r.doc_id: r.fingerprint for r in w.fingerprints(spark.createDataFrame(data, SCHEMA)).collect() if r.doc_id not in (3, None)}
    for i, (doc_id, text, *_) in enumerate(order):
        after = order[(i + 1) % len(order)][1] or ""
        digest = hashlib.sha256(edited(text or "", after).encode()).hexdigest()
        row = next(r for r in found if r.doc_id == doc_id and r.edited_sha256 == digest)
        x = w.characters(edited(text or "", after))
        assert row.edited_fingerprint == w.written(*w.sketch(x, np.array(plain_walk(edited(text or "", after)))))
        assert doc_id in (3, None) or row.fingerprint == plain[doc_id]
        assert row.near_edited == w.likeness(w.read(row.fingerprint), w.read(row.edited_fingerprint))
        if len(text or "") < 3:
            assert row.near_edited == 1
    assert plain[7] == plain[13] and plain[8] == plain[14]


@pytest.mark.parametrize("data", [[], [(1, "alone in the table", 1, "x")], [(None, None, 1, "x")]])
def test_tables_of_no_or_one_row(spark, data):
    found = w.edited_fingerprints(spark.createDataFrame(data, SCHEMA)).collect()
    assert len(found) == len(data) and all(row.near_next == 1 for row in found)


def test_fingerprints_can_be_raised():
    """At the level of a longer text a fingerprint is the one that it would have had there."""
    text = w.characters("".join(random.Random(1).choice("abcdefgh ") for _ in range(700)))
    steps = w.walks([text], np.zeros(1, np.int64))[0]
    level, bits = w.sketch(text, steps)
    end = int(steps[-1]) * w.PLACES
    for to in range(level, level + 4):
        places = w._KEPT(to, -(-end >> to))
        assert len(w.raised(level, bits, to)) == np.searchsorted(places, end)
    assert w.read(w.written(level, bits))[1].tolist() == bits.tolist()


def test_likeness_falls_with_edits():
    r = random.Random(4)
    base = "".join(r.choice("etaoinshrdlu ") for _ in range(6000))

    def sketch(text):
        return w.sketch(w.characters(text), np.array(plain_walk(text)))

    def changed(times):
        out = list(base)
        for _ in range(times):
            at = r.randrange(len(out))
            out[at : at + 1] = r.choice([[], ["q"], [out[at], "q"]])
        return "".join(out)

    found = [w.likeness(sketch(base), sketch(changed(n))) for n in (0, 3, 30, 600)]
    assert found[0] == 1 and found == sorted(found, reverse=True) and found[1] > 0.7
    other = "".join(r.choice("etaoinshrdlu ") for _ in range(6000))
    assert w.likeness(sketch(base), sketch(other)) < 0.25
    assert w.likeness(sketch(""), sketch("")) == 1 and w.likeness(sketch(""), sketch(base)) == 0


def test_near_texts(spark):
    r = random.Random(8)
    base = ["".join(r.choice("etaoin shrdlu") for _ in range(n)) for n in (40, 200, 900, 2500) for _ in range(12)]
    data = []
    for i, text in enumerate(base):
        at = r.randrange(len(text))
        data += [(10 * i, text), (10 * i + 1, text[:at] + "Q" + text[at + 1 :]), (10 * i + 2, text[: -len(text) // 20]), (10 * i + 3, text)]
    data += [(5000, ""), (5001, None), (None, base[0])]
    pairs, members = w.near_texts(spark.createDataFrame(data, "doc_id bigint, text string"))
    found = {(row.a, row.b): row.distance for row in pairs.collect()}
    assert all(a // 10 == b // 10 and 0 < d <= 0.1 * len(base[a // 10]) for (a, b), d in found.items())
    wanted = [(10 * i, 10 * i + k) for i in range(len(base)) for k in (1, 2)]
    assert sum(pair in found for pair in wanted) / len(wanted) >= 0.9
    classes = dict(map(tuple, members.collect()))
    assert classes[13] == 10 and classes[5001] == 5000 and None not in classes and len(classes) == len(data) - 1

import hashlib
import math

import numpy as np
import pytest

from pagetrail.llm import codebooks as c


def brute(rows, parts=4, entries=256, rounds=4):
    """(vec_id, code, error, label_error) sorted, and the digest of the codebooks."""
    kept = [(i, v, y) for i, v, y in rows if v and all(x is not None and math.isfinite(x) and abs(x) < c.LARGEST for x in v)]
    kept.sort(key=lambda x: (x[0] is None, x[0] or 0, [math.floor(1024 * y) for y in x[1]]))
    if not kept:
        return [], None
    kept = [x for x in kept if len(x[1]) == len(kept[0][1])]
    whole = [[math.floor(1024 * x) for x in v] + [0] * (-len(v) % parts) for _, v, _ in kept]
    cut = len(whole[0]) // parts
    cuts = [[v[p * cut : (p + 1) * cut] for v in whole] for p in range(parts)]
    books = [[list(x) for x in own[:entries]] for own in cuts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for x in cuts[p]:
                groups.setdefault(nearest(x, books[p])[1], []).append(x)
            for i, own in groups.items():
                books[p][i] = [sum(column) // len(own) for column in zip(*own)]
    final = [[nearest(x, books[p]) for x in cuts[p]] for p in range(parts)]
    errors = [sum(final[p][i][0] for p in range(parts)) for i in range(len(kept))]
    labels = {}
    for (_, _, y), e in zip(kept, errors):
        labels[y] = labels.get(y, 0) + e
    out = [
        (i, "".join(f"{final[p][k][1]:02x}" for p in range(parts)), errors[k], labels[y]) for k, (i, _, y) in enumerate(kept)
    ]
    digest = hashlib.sha256(",".join(str(x) for own in books for e in own for x in e).encode()).hexdigest()
    return sorted(out, key=repr), digest


def table(n=400, size=8, seed=3):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((20, size))
    return [(int(i), [float(np.float32(x)) for x in centres[r.integers(20)] + r.standard_normal(size) * 0.2], [None, 1, 2, 3][r.integers(4)]) for i in r.permutation(n)]


ODD = [
    (900, None, 1), (901, [], 1), (902, [float("nan")] * 8, 1), (903, [None, *[1.0] * 7], None), (904, [float("inf")] * 8, 2),
    (905, [1.0] * 7, 2), (906, [20_000.0] * 8, 2), (7, [0.5] * 8, 1), (7, [0.5] * 8, 1), (None, [-0.25] * 8, None), (8, [-1e-9] * 8, 3),
]
SCHEMA = "vec_id bigint, embedding array<float>, label int, code int, entry int"


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 256, 4), (4, 30, 4), (3, 7, 6), (1, 1, 2), (2, 16, 0)])
def test_equals_brute_force(spark, rows, parts, entries, rounds):
    data = table() + ODD
    frame = spark.createDataFrame([(*x, 1, 2) for x in data], SCHEMA).repartition(6)
    codes, books = c.encode(frame, parts, entries, rounds)
    expected, digest = brute(data, parts, entries, rounds)
    assert rows(codes, "vec_id", "code", "error", "label_error") == expected
    assert books.digest() == digest


def test_bounds_save_scans(spark):
    data = table(2000, 16)
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int")
    codes, books = c.encode(frame, 4, 32, 6)
    scans = [row.scans for row in codes.collect()]
    assert len(books.history) == 7
    assert np.mean(scans) < 0.6 * 4 * 7


def test_net_moves_are_tighter_than_summed_ones():
    """An entry that moves away and comes back leaves the bounds as they were."""
    there, away = np.array([[0, 0], [100, 0]]), np.array([[40, 0], [100, 0]])
    own = c._Round(np.stack([there, away, there]))
    assert own.moved[0].tolist() == [0, 0] and own.moved[1].tolist() == [40, 0]
    state = [np.zeros(1, np.int64), np.array([1.0]), np.zeros(1, np.int64), np.array([99.0]), np.zeros(1, np.int64), np.ones(1, np.int64)]
    own.assign(np.array([[1, 0]]), *state)
    assert [x[0] for x in state] == [0, 1.0, 0, 99.0, 0, 1]  # neither the distance nor a scan was needed


def test_large_components_are_exact():
    x = np.array([[16_777_215, -16_777_216] * 8], np.int64)
    book = np.array([[-16_777_216, 16_777_215] * 8, [16_777_214, -16_777_216] * 8], np.int64)
    assert c._squares(x, book).tolist() == [[sum((a - b) ** 2 for a, b in zip(x[0].tolist(), e)) for e in book.tolist()]]


def test_empty_and_useless_tables(spark):
    for data in ([], ODD[:5]):
        codes, _ = c.encode(spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int"))
        assert codes.collect() == []


def test_without_labels(spark):
    frame = spark.createDataFrame([(i, v) for i, v, _ in table(50)], "vec_id bigint, embedding array<double>")
    codes, _ = c.encode(frame, entries=8)
    assert {row.label_error for row in codes.collect()} == {sum(row.error for row in codes.collect())}

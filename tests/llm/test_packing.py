import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pagetrail.llm import packing


def waste(lengths, counts, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(12))
def test_boundaries_are_optimal(seed):
    r = random.Random(seed)
    lengths = sorted(r.sample(range(0, 60), r.randint(1, 9)))
    counts = [r.randint(1, 50) for _ in lengths]
    for buckets in (1, 2, 3, 5, 20):
        bounds = packing.optimal_boundaries(lengths, counts, buckets)
        assert len(bounds) <= buckets and bounds == sorted(set(bounds)) and bounds[-1] == lengths[-1]
        best = min(
            waste(lengths, counts, (*c, lengths[-1])) for k in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1], k)
        )
        assert waste(lengths, counts, bounds) == best


def test_no_lengths():
    assert packing.optimal_boundaries([], [], 4) == []


def test_packs_every_token_once_within_the_budget(spark):
    r = random.Random(1)
    sizes = [0, 0, 1, 3, 10, 11, 25, 100] + [r.randint(1, 12) for _ in range(400)]
    rows = [(i if i != 3 else None, " ".join(["w"] * n) or (None if i else ""), 1) for i, n in enumerate(sizes)]
    rows += [rows[5]] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, bucket int")
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda x: x != ""))
    out = packing.pack(docs, words, max_length=10, buckets=3, token_budget=40).collect()
    tokens = Counter()
    for x in out:
        assert 0 <= x.n_tokens <= x.bucket_length <= 10 and x.padding == x.bucket_length - x.n_tokens
        assert x.first_token == 10 * x.piece
        tokens[x.doc_id] += x.n_tokens
    expected = Counter()
    for i, text, _ in rows:
        expected[i] += len((text or "").split())
    assert tokens == expected
    batches = defaultdict(list)
    for x in out:
        batches[x.bucket, x.batch].append(x)
    short = Counter()
    for (bucket, _), held in batches.items():
        fit = max(1, 40 // max(held[0].bucket_length, 1))
        assert sorted(x.slot for x in held) == list(range(len(held))) and len(held) <= fit
        short[bucket] += len(held) < fit
    assert max(short.values()) <= 1
    lengths = Counter(x.n_tokens for x in out)
    best = packing.optimal_boundaries([*lengths], [*lengths.values()], 3)
    assert {x.bucket_length for x in out} == set(best)


def test_empty_table_and_own_lengths(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert packing.pack(docs.limit(0)).count() == 0
    assert packing.pack(docs, tokens=F.length("text")).first().n_tokens == 5


def test_tokens_of_whole_texts(spark):
    import base64

    import tiktoken

    from pagetrail.llm import tokens

    with open(tokens.vocabulary_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoder = tiktoken.Encoding("test", pat_str=tokens.SPLIT, mergeable_ranks=ranks, special_tokens={})
    texts = {1: "One text with some words, and more of them. " * 9, 2: None, 3: "", 4: "日本語🙂" * 30, 5: "x" * 5000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").withColumn("token_ids", F.lit(1))
    out = packing.pack(docs, max_length=32, buckets=4, token_budget=128, with_ids=True).collect()
    plain = packing.pack(docs, max_length=32, buckets=4, token_budget=128)
    assert sorted(map(tuple, plain.collect())) == sorted(tuple(r)[:-1] for r in out)
    for i, text in texts.items():
        own = sorted((r for r in out if r.doc_id == i), key=lambda r: r.piece)
        assert all(len(r.token_ids) == r.n_tokens <= 32 for r in own)
        assert sum((r.token_ids for r in own), []) == encoder.encode_ordinary(text or "")

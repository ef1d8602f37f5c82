import random

from pyspark.sql import functions as F

from pagetrail.llm import decontaminate as d

RANDOM = random.Random(5)
VOCABULARY = ["".join(RANDOM.choices("abcdefgh", k=6)) for _ in range(4000)]


def words(n):
    return RANDOM.choices(VOCABULARY, k=n)


ITEMS = [words(n) for n in (15, 30, 45, 60, 4, 1)]
BENCHMARK = [(i, " ".join(x)) for i, x in enumerate(ITEMS)] + [(7, None), (8, ""), (9, " ".join(ITEMS[1])), (None, "..")]


def frames(spark, texts, extra=False):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    if extra:
        docs = docs.withColumn("overlaps", F.lit("mine")).withColumn("item_id", F.lit(1))
    return docs, spark.createDataFrame(BENCHMARK, "item_id bigint, text string")


def substituted(item, every):
    return [w if (i + 1) % every else "zzzzz" for i, w in enumerate(item)]


def test_substitutions_partial_passages_and_clean_texts(spark):
    texts = [
        " ".join(words(40) + ITEMS[0] + words(30)),
        " ".join(words(5) + substituted(ITEMS[3], 5) + words(200)).upper(),
        " ".join(words(40) + ITEMS[2][10:30] + words(30)),  # a stretch of 20 of 45 words
        " ".join(words(40) + ITEMS[2][10:18] + words(30)),  # 8 words only
        " ".join(words(500)),
        " ".join(words(20) + ITEMS[4] + words(20)),  # a short item
        None,
        "",
    ]
    docs, benchmark = frames(spark, texts)
    found = {r.doc_id: r.overlaps for r in d.find_overlaps(docs, benchmark).collect()}
    assert [bool(found[i]) for i in range(8)] == [True, True, True, False, False, True, False, False]
    assert found[0][0] == (0, 40, 54, 15)
    # the last of the 60 words is substituted, so the overlap ends before it
    assert (found[1][0].item_id, found[1][0].first_word, found[1][0].equal_words) == (3, 5, 48)
    assert found[2][0] == (2, 40, 59, 20)


def test_equal_items_blocks_and_clashing_columns(spark):
    docs, benchmark = frames(spark, [" ".join(words(9) + ITEMS[1] + words(9))] * 3 + ["clean"], extra=True)
    whole = d.find_overlaps(docs, benchmark).collect()
    blocks = d.find_overlaps(docs, benchmark, block_words=20).collect()
    assert [sorted(r.overlaps) for r in whole] == [sorted(r.overlaps) for r in blocks]
    # each block is scanned for in a stage of its own
    assert d.find_overlaps(docs, benchmark, block_words=20)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert [o.item_id for o in whole[0].overlaps] == [1, 9]
    clean = d.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns and [tuple(r) for r in clean.collect()] == [(3, "clean", "mine", 1)]


def test_empty_tables(spark):
    docs, benchmark = frames(spark, ["a b c"])
    assert d.find_overlaps(docs.limit(0), benchmark).count() == 0
    assert d.decontaminate(docs, benchmark.limit(0)).count() == 1


def test_items_are_found_by_brute_force_in_long_texts(spark):
    """Every planted item with each tenth word replaced is found, nothing else is."""
    planted = {}
    texts = []
    for i in range(40):
        body = words(300 + 40 * i)
        if i % 2:
            item = i % 4
            place = RANDOM.randrange(len(body))
            body[place:place] = substituted(ITEMS[item], 10)
            planted[i] = item
        texts.append(" ".join(body))
    docs, benchmark = frames(spark, texts)
    found = {r.doc_id: {o.item_id for o in r.overlaps} - {9} for r in d.find_overlaps(docs, benchmark).collect()}
    assert {i: x for i, x in found.items() if x - {5}} == {i: found[i] for i in planted}
    assert all(planted[i] in found[i] for i in planted)


def diagonal_scan(text, item):
    """Whether some placing of the item over the text meets one of the two rules, by comparing every word of every placing."""
    for d_ in range(-len(item) + 1, len(text)):
        equal = [0 <= d_ + k < len(text) and text[d_ + k] == w for k, w in enumerate(item)]
        if sum(equal) >= d.ITEM_SHARE * len(item):
            return True
        there = [k for k, e in enumerate(equal) if e]
        for x, a in enumerate(there):
            for y in range(len(there) - 1, x, -1):
                size = there[y] - a + 1
                if size >= d.STRETCH_WORDS and 5 * (size - (y - x + 1)) <= size:
                    return True
    return False


def test_recall_against_a_diagonal_scan(spark):
    """Random substitutions of 10 to 40 percent, and every second to tenth word replaced, in items of 8 to 60 words."""
    r = random.Random(11)
    items = [words(n) for n in (8, 10, 12, 15, 20, 25, 30, 40, 60)]
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    texts, wanted = [], []
    for i, item in enumerate(items):
        for share in (0.1, 0.2, 0.3, 0.35, 0.4):
            for _ in range(6):
                gone = set(r.sample(range(len(item)), int(share * len(item))))
                texts.append(words(30) + [w if k not in gone else "zz" for k, w in enumerate(item)] + words(30))
                wanted.append((i, "random"))
        for every in range(2, 11):
            for first in range(every):
                texts.append(words(20) + [w if (k + first) % every else "zz" for k, w in enumerate(item)] + words(20))
                wanted.append((i, "periodic"))
    docs = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(texts)], "doc_id bigint, text string")
    found = {row.doc_id: {o.item_id for o in row.overlaps} for row in d.find_overlaps(docs, benchmark).collect()}
    accepted = [diagonal_scan(text, items[i]) for text, (i, _) in zip(texts, wanted)]
    hit = [i in found[k] for k, (i, _) in enumerate(wanted)]
    assert not any(h and not a for h, a in zip(hit, accepted))
    for kind, least in (("random", 0.98), ("periodic", 1)):
        own = [h for h, a, (_, x) in zip(hit, accepted, wanted) if a and x == kind]
        assert len(own) > 150 and sum(own) >= least * len(own)


def test_common_phrases_are_compared_at_once(spark):
    """Phrases that items and texts share everywhere, and equal words in very long texts, are no overlaps."""
    phrase = ["of", "the", "same"]
    items = [sum((phrase + [w] for w in words(12)), []) for _ in range(40)]
    benchmark = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id bigint, text string")
    text = sum((phrase + words(9) for _ in range(3000)), [])
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(text + items[7]))], "doc_id bigint, text string")
    found = {row.doc_id: {o.item_id for o in row.overlaps} for row in d.find_overlaps(docs, benchmark).collect()}
    assert all(diagonal_scan(text[:900], items[i]) for i in found[1]) and 7 in found[2]

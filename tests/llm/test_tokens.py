import base64

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagetrail.llm import tokens

TEXTS = {
    1: "Title\n\n\nBody of the text, don't panic.\n   indented 12345\n",
    2: "ünï\ncödé 日本語\n🙂🙂\n",
    3: "",
    4: None,
    5: "one line",
    6: "\n\n",
    7: "x" * 30_000 + "\n" + "y",
    8: "aZ09+/" * 5_000 + "\nend of a long run",
    9: "".join(chr(97 + i * i % 26) for i in range(40_000)),
}


def encoded(text):
    """Byte spans of the tokens, one by one."""
    import tiktoken

    with open(tokens.vocabulary_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoder = tiktoken.Encoding("test", pat_str=tokens.SPLIT, mergeable_ranks=ranks, special_tokens={})
    at, out = 0, []
    for token in encoder.encode_ordinary(text):
        n = len(encoder.decode_single_token_bytes(token))
        out.append((at, at + n))
        at += n
    assert at == len(text.encode())
    return out


def owner(span, sections, rule):
    """The section of each byte of a token decides."""
    held = [next((k for k, (a, b) in enumerate(sections) if a <= x < b), -1) for x in range(*span)]
    if rule == "first":
        return held[0]
    return max(sorted(set(held), key=lambda k: (k < 0, k)), key=held.count)


@pytest.mark.parametrize("rule", ["most", "first"])
def test_lines_by_brute_force(spark, rule):
    docs = spark.createDataFrame(list(TEXTS.items()), "doc_id bigint, text string")
    found = tokens.section_tokens(docs, tokens.vocabulary_path(), rule=rule).collect()
    for i, text in TEXTS.items():
        text = text or ""
        lines = text.splitlines(keepends=True) or [""]
        own = sorted((r for r in found if r.doc_id == i), key=lambda r: r.section_no)
        assert [text[r.start : r.stop] for r in own] == lines
        assert [r.name for r in own] == ["title"] + ["line"] * (len(lines) - 1)
        ends = np.cumsum([len(x.encode()) for x in lines])
        sections = list(zip([0, *ends[:-1]], ends))
        spans = encoded(text)
        expected = [sum(owner(s, sections, rule) == k for s in spans) for k in range(len(lines))]
        assert [r.n_tokens for r in own] == expected and {r.doc_tokens for r in own} == {len(spans)}


def test_attribution_by_brute_force():
    r = np.random.default_rng(4)
    for _ in range(300):
        cuts = np.sort(r.choice(40, r.integers(0, 5) * 2, replace=False))
        starts, stops = cuts[::2], cuts[1::2]
        ends = np.sort(r.choice(np.arange(1, 41), r.integers(0, 15), replace=False))
        spans = list(zip([0, *ends[:-1]], ends))
        for rule in ("first", "most"):
            found = tokens.attribute(ends, starts, stops, rule)
            for span, k in zip(spans, found):
                held = [next((k for k, (a, b) in enumerate(zip(starts, stops)) if a <= x < b), -1) for x in range(*span)]
                if rule == "first":
                    assert k == held[0]
                else:
                    best = max(held.count(x) for x in set(held) if x >= 0) if max(held) >= 0 else 0
                    expected = next((x for x in sorted(set(held)) if x >= 0 and held.count(x) == best), -1)
                    assert k == (expected if best >= held.count(-1) and best else -1)


def test_own_sections_with_gaps_and_without_any(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, None), (3, "alpha")], "doc_id bigint, text string").withColumn("name", F.lit(1))
    section = F.struct(F.lit("middle").alias("name"), F.lit(5).alias("start"), F.lit(10).alias("stop"))
    found = tokens.section_tokens(docs, tokens.vocabulary_path(), F.when(F.col("doc_id") < 3, F.array(section))).collect()
    rows = {(r.doc_id, r.section_no): r for r in found}
    whole = len(encoded("alpha beta gamma"))
    assert rows[1, -1].n_tokens + rows[1, 0].n_tokens == whole and rows[1, 0].n_tokens == len(encoded(" beta"))
    assert rows[2, 0].n_tokens == 0 and rows[3, -1].n_tokens == rows[3, -1].doc_tokens == len(encoded("alpha"))
    assert tokens.section_tokens(docs.limit(0), tokens.vocabulary_path()).count() == 0
    with pytest.raises(ValueError):
        tokens.section_tokens(docs, tokens.vocabulary_path(), rule="none")


def test_counts_of_whole_texts(spark):
    docs = spark.createDataFrame(list(TEXTS.items()) + [(1, TEXTS[1])], "doc_id bigint, text string").withColumn("n_tokens", F.lit(1))
    found = sorted(tokens.token_counts(docs, tokens.vocabulary_path()).collect())
    expected = [(i, len(encoded(text or ""))) for i, text in TEXTS.items()] + [(1, len(encoded(TEXTS[1])))]
    assert [tuple(r) for r in found] == sorted(expected)
    assert tokens.token_counts(docs.limit(0), tokens.vocabulary_path()).collect() == []

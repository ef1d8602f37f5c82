import re

import pytest
from pyspark.sql import functions as F

from pagetrail.functions import text
from pagetrail.operators import pages

PAGES = [
    ("a/1.html", "1", '<a HREF="1.html">x</a> <a href="5.html">y</a> <a HREF="1.html">z</a><a HREF="007.html"></a>'),
    ("a/2.html", "2", "the café is ab1 x_y don't"),
    ("a/3.html", "3", "word"),
    ("a/4.html", "4", "<p\nclass='q'>Big <b>BIG</b> dog<script>var x</script> big dog"),
    ("a/5.html", "5", ""),
]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(PAGES, "path string, file_id string, content string")


def test_links_any_case_keep_repeats_and_spelling(corpus, rows):
    assert rows(pages.extract_links(corpus)) == [("1", "007"), ("1", "1"), ("1", "1"), ("1", "5")]


def test_numeric_links_upper_case_only(corpus):
    found = {row.file_id: row.targets for row in pages.extract_links_numeric(corpus).collect()}
    assert found["1"] == [1, 1, 7]
    assert found["5"] == []


def test_huge_target_counts_as_link(spark):
    page = spark.createDataFrame([("p", 1, f'HREF="{"9" * 30}.html"')], "path string, file_id long, content string")
    assert pages.extract_links_numeric(page).first().targets == [None]


def test_last_path_wins_for_a_repeated_id(spark):
    twice = spark.createDataFrame(
        [("a/1.html", 1, 'HREF="2.html"'), ("b/1.html", 1, 'HREF="3.html"')],
        "path string, file_id long, content string",
    )
    assert pages.extract_links_numeric(twice).first().targets == [3]


def test_words(corpus):
    found = {row.file_id: row.words for row in pages.page_tokens(corpus).collect()}
    assert found["2"] == ["the", "is", "don", "t"]
    assert found["4"] == ["big", "big", "dog", "var", "x", "big", "dog"]


def test_words_match_python_on_mixed_scripts(spark):
    samples = ["naïve co-op x2 éa ñ a_b ²c d² ein-stück ab­cd", "Ωmega alpha mega été a.b,c", "MIXED Case İstanbul"]
    df = spark.createDataFrame([(s,) for s in samples], "content string")
    found = [row.w for row in df.select(text.words(F.col("content")).alias("w")).collect()]
    assert found == [re.findall(r"\b[a-z]+\b", s.lower()) for s in samples]


def test_bigrams(corpus, rows):
    assert rows(pages.bigram_counts(corpus)) == sorted(
        [("the is", 1), ("is don", 1), ("don t", 1), ("big big", 1), ("big dog", 2), ("dog var", 1), ("var x", 1), ("x big", 1),
         ("x y", 1), ("y z", 1)],
        key=repr,
    )


def test_outgoing_counts_include_zero_and_add_up(corpus, rows):
    doubled = corpus.unionByName(corpus.filter("file_id = '1'").withColumn("path", F.lit("b/1.html")))
    assert rows(pages.outgoing_counts(doubled)) == [("1", 8), ("2", 0), ("3", 0), ("4", 0), ("5", 0)]


def test_in_and_out_counts_agree_in_total(corpus):
    total_in = pages.incoming_counts(corpus).agg(F.sum("incoming")).first()[0]
    total_out = pages.outgoing_counts(corpus).agg(F.sum("outgoing")).first()[0]
    assert total_in == total_out == 4


def test_top_lists_in_one_pass_equal_separate_counts(corpus, rows):
    tops = pages.top_lists(corpus, 2)
    assert rows(tops.filter("kind = 'bigram'"), "position", "item", "count") == [(1, "big dog", 2), (2, "big big", 1)]
    assert rows(tops.filter("kind = 'incoming'"), "position", "item", "count") == [(1, "1", 2), (2, "007", 1)]
    assert rows(tops.filter("kind = 'outgoing'"), "position", "item", "count") == [(1, "1", 4), (2, "2", 0)]


def test_formatted_lines(corpus, rows):
    lines = pages.format_top_links(pages.top_lists(corpus, 1))
    assert rows(lines, "line") == [("'big dog': 2 occurrences",), ("File 1: 2 incoming links",), ("File 1: 4 outgoing links",)]


@pytest.mark.parametrize(
    "raw",
    [
        b"plain",
        b"bad \xe2\x28\xa1 x\xff y",
        "kept � sign".encode() + b" \xff cut",
        b"\xe2\xef\xbf\xbd \xf0\x9f\x98 z \xed\xa0\x80 q",
        "été".encode(),
    ],
)
def test_bad_bytes_are_dropped_as_python_does(spark, raw):
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    assert df.select(text.drop_undecodable(F.col("b"))).first()[0] == raw.decode("utf-8", "ignore")


def test_ids(spark):
    df = spark.createDataFrame([("x/12.html",), ("x/page7.html",), ("x/readme.html",), ("x/a.html.html",)], "p string")
    found = df.select(text.file_id(F.col("p")), text.numeric_file_id(F.col("p"))).collect()
    assert [tuple(row) for row in found] == [("12", 12), ("page7", 7), ("readme", None), ("a", None)]

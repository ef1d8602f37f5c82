import html
import re

import pytest

from pagetrail.llm import extraction as e

GOOD = "This is a paragraph of the story that is long enough to count as content, because it has many of the words that are in the list."
OTHER = "It was the second of the paragraphs, and there is more in it than in the first one, as you can see when you have read all of it."


def page(body, head="<title>No title</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    "part",
    [
        f"<nav><p>{GOOD}</p></nav>",
        f"<header><h1>Site of the year</h1><p>{GOOD}</p></header>",
        f"<footer>{GOOD} &copy; 2024</footer>",
        f"<aside><p>{GOOD}</p></aside>",
        f'<div class="ad">{GOOD}</div>',
        f'<div id="cookie-notice"><div><p>{GOOD}</p></div></div>',
        f'<section class="user-comments"><p>{GOOD}</p><p>{OTHER}</p></section>',
        f"<form><label>{GOOD}</label><input type=text><button>Send it</button></form>",
        f"<script>var a = '<p>{GOOD}</p>';</script><style>p {{}}</style><noscript>{GOOD}</noscript>",
        f"<!-- <p>{GOOD}</p> -->",
        f'<p style="display: none">{GOOD}</p>',
        "<ul><li><a href=a>One of the links</a></li><li><a href=b>The other of the links</a></li></ul>",
    ],
)
@pytest.mark.parametrize("frame", ["{}<article><h1>Heading</h1><p>{}</p><p>Short.</p><p>{}</p></article>", "{}<div><h1>Heading</h1><p>{}</p><p>Short.</p><p>{}</p></div>"])
def test_boilerplate_goes_article_stays(part, frame):
    before = page(frame.format(part, GOOD, OTHER))
    after = page(frame.replace("{}<", "<", 1).format(GOOD, OTHER) + part)
    expected = ["Heading", GOOD, "Short.", OTHER]
    assert e.main_text(before).split("\n") == expected
    assert e.main_text(after).split("\n") == expected


def test_parts_inside_an_article():
    text = e.main_text(page(f'<article><p>{GOOD}</p><div class="advert">Buy the best of it</div><p>{OTHER}</p><div class=comments><p>{GOOD}</p></div></article>'))
    assert text.split("\n") == [GOOD, OTHER]


def test_white_space_references_and_markup():
    text = e.main_text(page(f"<main><p>a&nbsp;&amp;\n\t b&lt;p&gt; c<b>d</b>e<br>f &#233; &euml;</p><p>{GOOD}"))
    assert text.split("\n") == ["a & b<p> cde f é ë", GOOD]


@pytest.mark.parametrize("odd", ["", " ", "<", "<p", "</p></div>", "<!--", "<script>", "&", "<p class='a", "plain text", "<a><a><a>", "<![CDATA[x", "\x00<p>퟿"])
def test_odd_pages_do_not_crash(odd):
    assert isinstance(e.main_text(odd), str)


def test_plain_page_without_hints():
    body = f"<div><a href=1>Home</a> <a href=2>News</a></div><h2>Heading</h2><p>{GOOD}</p><p>Short one</p><p>{OTHER}</p><div>Terms</div>"
    assert e.main_text(page(body)).split("\n") == ["Heading", GOOD, "Short one", OTHER]


ALL = [GOOD, OTHER]
BOTH = f"<p>{GOOD}</p><p>{OTHER}</p>"
SEE = "See <a href=1>the first of the two long reports</a> and the others."
LAYOUTS = {
    "wrapper with a denied name": (f'<div class="page-with-toc"><article>{BOTH}</article></div>', ALL),
    "layout has-sidebar": (f'<div class="layout has-sidebar">{BOTH}</div>', ALL),
    "no-sidebar on main": (f'<main class="main no-sidebar">{BOTH}</main>', ALL),
    "content-sidebar-wrap": (f'<div class="content-sidebar-wrap">{BOTH}</div>', ALL),
    "named wrapper of an article": (f'<div class="sidebar"><article>{BOTH}</article></div>', ALL),
    "form around everything": (f"<form action=x>{BOTH}<input></form>", ALL),
    "form around an article": (f"<form><nav><a href=1>A</a></nav><article>{BOTH}</article></form>", ALL),
    "small form beside": (f"{BOTH}<form><p>Your name and your address, please, so that we can write to you</p></form>", ALL),
    "id that is a slug": (f'<article><section id="ad-hoc-networks">{BOTH}</section></article>', ALL),
    "slug outside an article": (f'<div id="ad-hoc-networks">{BOTH}</div>', ALL),
    "section named like a part": (f'<article><section id="search-and-rescue">{BOTH}</section></article>', ALL),
    "advert slot": (f'<div class="ad-slot-2"><p>{GOOD}</p></div>{BOTH}', ALL),
    "last part of a name": (f'<div class="site-footer"><p>{GOOD}</p></div>{BOTH}', ALL),
    "numbered widget": (f'{BOTH}<div id="text-widget-3"><p>{GOOD}</p></div>', ALL),
    "linked prose": (f"<article><p>{GOOD}</p><p>{SEE}</p></article>", [GOOD, "See the first of the two long reports and the others."]),
    "list of links in an article": (f"<article>{BOTH}<ul><li><a href=1>The first</a></li><li><a href=2>And more</a></li></ul></article>", ALL),
    "teaser cards": (BOTH + "".join(f"<a href={i}><div><h3>Card of the day</h3><p>{GOOD}</p></div></a>" for i in range(4)), ALL),
    "link that never ends": (f"<p><a href=1>Start of it all</p>{BOTH}", ALL),
    "anchor without a target": (f"<a name=top>{BOTH}</a>", ALL),
    "unclosed iframe": (f"<article><p>{GOOD}</p><iframe src=x><p>{OTHER}</p></article>", ALL),
    "unclosed object": (f"<article><object><p>{GOOD}</p><p>{OTHER}</p></article>", ALL),
    "comment thread of articles": (f'<div>{BOTH}</div><section class="comments"><article><p>{GOOD}</p></article><article><p>{OTHER}</p></article><article><p>{GOOD}</p></article></section>', ALL),
    "related articles": (f'<main>{BOTH}</main><div class="related"><article><p>{GOOD}</p></article></div>', ALL),
    "sidebar with a short article": (f'<article>{BOTH}<p>{GOOD}</p></article><div class="sidebar"><article><p>{OTHER}</p></article></div>', [*ALL, GOOD]),
    "role main": (f'<div role="main">{BOTH}</div><div><p>{GOOD}</p></div>', ALL),
    "hidden wrapper": (f"<div hidden><p>{GOOD}</p></div>{BOTH}", ALL),
    "only a menu": ("<nav><a href=1>Home of the site</a></nav>", []),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    body, expected = LAYOUTS[name]
    found = e.main_text(page(body))
    assert (found.split("\n") if found else []) == expected


def test_unclosed_title():
    assert e.main_text(f"<html><head><title>No end<body><article>{BOTH}</article>").split("\n") == ALL


def plain_labels(found):
    """Both passes with a search from each block to both sides."""
    article = any(b.article and not b.apart for b in found)
    first = []
    for b in found:
        words = e._WORD.findall(b.text.lower())
        stop = len([w for w in words if w in e.STOP_WORDS]) / (len(words) or 1)
        links = b.linked / len(b.text)
        prose = b.article and not b.listed and not (links >= e.ALL_LINKS and len(b.text) < e.SHORT)
        if b.apart or article and not b.article or links > e.MOST_LINKS and not prose:
            first.append("bad")
        elif len(b.text) < e.SHORT:
            first.append("bad" if b.linked and not b.article else "open")
        elif stop >= e.MANY_STOP_WORDS or stop >= e.FEW_STOP_WORDS and len(b.text) > e.LONG:
            first.append("good")
        else:
            first.append("open" if b.article or stop >= e.FEW_STOP_WORDS else "bad")
    out = []
    for i, b in enumerate(found):
        if first[i] != "open":
            out.append(first[i] == "good")
            continue
        sides = []
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(found) and (first[j] == "open" or b.article and (found[j].apart or found[j].article != b.article)):
                j += step
            sides.append(j if 0 <= j < len(found) else None)
        good = [j is not None and first[j] == "good" for j in sides]
        if b.article:
            out.append(None in sides or any(good))
        elif good[0] == good[1]:
            out.append(good[0])
        elif b.heading:
            out.append(good[1])
        else:
            j = sides[0] if good[0] else sides[1]
            out.append(abs(j - i) == 1 and len(found[j].text) > e.LONG)
    return out


def test_labels_equal_a_plain_version(spark):
    import random

    r = random.Random(7)
    texts = [GOOD, OTHER, GOOD + " " + OTHER, "Short.", "Word " * 30, "A few words of it " + "data " * 12, "x" * 90]
    for _ in range(400):
        found = []
        for _ in range(r.randrange(12)):
            text = r.choice(texts)
            found.append(e.Block(text, r.choice([0, 0, len(text) // 2, len(text)]), r.choice([0, 0, 1, 2]), r.random() < 0.2, r.random() < 0.2, r.random() < 0.3))
        assert e.labels(found) == plain_labels(found)
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        found = e.blocks(row.html or "")
        assert e.labels(found) == plain_labels(found)


def test_very_long_blocks_and_runs():
    long = (GOOD + " ") * 20_000
    assert e.main_text(page(f"<p>{long}</p>")) == long.strip()
    assert e.main_text(page(f"<article><p>{'x' * 2_000_000}</p><p>{GOOD}</p></article>")).startswith("xxx")
    assert e.main_text("<div>" * 30_000 + f"<p>{GOOD}</p>") == GOOD
    assert len(e.main_text(page("<article>" + f"<p><a href=1>{GOOD}</p>" * 3000 + "</article>"))) > 1000


def test_table_and_odd_rows(spark):
    rows = [(1, "u", page(f"<article><p>{GOOD}</p></article>")), (1, "u", page(f"<article><p>{GOOD}</p></article>")), (2, None, None), (None, "u", "")]
    rows += [(3, "u", "<article>" + f"<p>{GOOD}</p>" * 20_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    found = e.extract(pages).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in found[:4]] == [(1, "u", len(GOOD)), (1, "u", len(GOOD)), (2, None, 0), (None, "u", 0)]
    assert found[4].text == "\n".join([GOOD] * 20_000) and found[4].n_chars == len(found[4].text)
    assert e.extract(pages.limit(0)).count() == 0


def test_articles_of_the_tables(spark):
    """In the driver's pages the article element is the article."""
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in e.op7_main_text(spark, "/root/testdata/sf0.01").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1].replace("<br>", " ")
        parts = (html.unescape(re.sub(r"<[^>]*>", "", x)).split() for x in re.split(r"</?(?:p|h\d)>", article))
        assert r.text == "\n".join(" ".join(x) for x in parts if x) and r.n_chars == len(r.text)

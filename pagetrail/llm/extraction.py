"""Operator 7: main text of HTML pages by two passes over their blocks.

A page is cut into blocks at block-level tags. First pass, each block on its own:

* blocks in navigation, headers and footers of the page, sidebars, forms, notices, adverts, comments and hidden parts, or made
  of links for the most part, are boilerplate; so is everything outside an ``article`` or ``main`` element if there is one;
* prose of an article may be linked as much as it likes: there links count only in lists, tables and short blocks that are
  nothing but links;
* a form around everything, or a wrapper of an article, doesn't stand apart if it holds half of the page's stop words or more;
* long blocks with many stop words are content, long ones with few are boilerplate;
* the others are ambiguous.

Second pass: an ambiguous block inherits the label of its nearest decided neighbours. If the two sides differ, it is content
next to a long content block or as a heading above content, else boilerplate; the ends of a page count as boilerplate. In an article without any decided block,
ambiguous blocks are content. Blocks inside an article have the article as their neighbourhood.

White space of a block becomes one space, character references are decoded, blocks are joined by line breaks. Null and empty
pages have an empty text; repeated rows give equal results; extra columns are not needed and not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pagetrail.llm.textcodes import slices

SHORT, LONG = 70, 200
FEW_STOP_WORDS, MANY_STOP_WORDS = 0.12, 0.2
MOST_LINKS, ALL_LINKS = 0.33, 0.95

# Frequent function words of the languages that are expected.
STOP_WORDS = frozenset(
    "a about after all also an and are as at be been but by can could did do for from had has have he her his how i if in into is it "
    "its more no not of on one or other our out she so some than that the their them then there these they this to up was we were what "
    "when which who will with would you your "
    "aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer eines er es für hat ich ihr im "
    "in ist ja kann man mit nach nicht noch nur oder sein sich sie sind so über um und uns unter vom von vor war was wenn wie wird wir zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa "
    "sans se ses son sont sur un une vous y à été être "
    "al como con de del desde donde el ella en entre era es esta este fue ha hay la las le lo los más me mi muy no nos o para pero por que se "
    "ser si sin sobre su sus también un una y ya "
    "che con da dal della di e gli ha i il le ma nel non per più si sono un una "
    "ao as com da das do dos e em mais na nas não nos o os ou pela pelo por que se sua um uma "
    "aan als bij dat de een en het hij ik in is maar met niet nog of ook op te van voor wat ze zijn".split()
)
RAW = "script style template noscript svg math iframe object embed textarea select title canvas audio video button"
BLOCK = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead "
    "tr ul"
)
VOID = "area base br col embed hr img input link meta param source track wbr"
APART = "nav footer aside form dialog menu fieldset"
#: Words in class, id or role that tell a part of the page that is not the article.
APART_NAMES = (
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs cmp comment comments commentlist consent cookie "
    "cookies copyright disclaimer disqus dropdown feedback footer gdpr login masthead menu menubar modal nav navbar navigation newsletter "
    "notice notices notification pager pagination paywall popup promo promotion promoted recommendation recommendations recommended "
    "related replies reply respond share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription tagcloud "
    "tags teaser toc toolbar trending widget alert complementary contentinfo search alertdialog"
)
ARTICLE_NAMES = "articlebody article-body post-content entry-content article-content post-body"
#: What stands apart even if it holds most of a page: these names, and hidden parts, menus and asides.
FIRM_NAMES = "comment comments commentlist disqus reply replies respond nav navbar navigation menu menubar cookie cookies consent related"
#: A first or last part of a name doesn't count next to these, as in has-sidebar or page-with-toc.
DENIALS = "has no non not with without hide hidden"
#: A first part of these counts only if all others are of the next line, as in ad-slot-2.
AD = "ad ads adv advert"
AD_PARTS = "slot slots box banner container unit wrapper wrap block space area zone top bottom left right side inner label leaderboard sticky"
LISTS = "ul ol dl menu table"
_RAW, _BLOCK, _VOID, _APART = (frozenset(x.split()) for x in (RAW, BLOCK, VOID, APART))
_APART_NAMES, _ARTICLE_NAMES, _FIRM_NAMES, _DENIALS, _AD, _AD_PARTS, _LISTS = (
    frozenset(x.split()) for x in (APART_NAMES, ARTICLE_NAMES, FIRM_NAMES, DENIALS, AD, AD_PARTS, LISTS)
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z))",
    re.S,
)
_NAMED = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?<![\w-])(?:hidden(?![\w-])|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_LINK = re.compile(r"</?a(?![\w:-])", re.I)
_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(_BLOCK))})(?![\w:-])", re.I)


class Block(NamedTuple):
    text: str
    linked: int  # characters in links
    article: int  # number of the article element that holds it, 0 for none
    apart: bool
    heading: bool
    listed: bool  # in a list or table
    wraps: tuple[int, ...] = ()  # the elements around it that stand apart unless they hold the article


def _parts(names: str) -> Iterator[str]:
    """What a class, id or role says: each name as a whole, and its first and last part unless they are denied."""
    for name in names.lower().split():
        yield name
        parts = [p for p in re.split(r"[-_:]+", name) if p]
        if len(parts) < 2 or parts[0] in _DENIALS:
            continue
        if parts[0] not in _AD or all(p in _AD_PARTS or p.isdigit() for p in parts[1:]):
            yield parts[0]
        if parts[-1].isdigit() and len(parts) > 2:
            parts.pop()
        if parts[-2] not in _DENIALS and parts[-1] not in _AD:
            yield parts[-1]


def _marks(name: str, rest: str, in_article: bool) -> tuple[bool, bool, bool]:
    """Whether an element stands apart from the article, whether that is undone if it turns out to hold the article, and
    whether it is an article."""
    apart, article = name in _APART or (name == "header" and not in_article), name in ("article", "main")
    firm = apart and name != "form"
    if "=" in rest or "hidden" in rest:
        firm = firm or bool(_HIDDEN.search(rest))
        for kind, *values in _NAMED.findall(rest):
            names = "".join(values)
            whole = names.lower().split()
            article = article or (kind.lower() == "role" and "main" in whole) or not _ARTICLE_NAMES.isdisjoint(whole)
            # ids inside an article name its sections
            said = whole if kind.lower() == "id" and in_article else list(_parts(names))
            apart = apart or not _APART_NAMES.isdisjoint(said)
            firm = firm or not _FIRM_NAMES.isdisjoint(said)
    apart = apart or firm
    return apart and name not in ("html", "body", "article", "main"), not firm, article


def _link_end(page: str, at: int) -> int:
    """Where the link that begins here ends; 0 if another begins first or none ends."""
    end = _LINK.search(page, at)
    return end.start() if end and end[0].startswith("</") else 0


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int, tuple[int, ...]]] = []  # name, apart, article, wraps
    wrappers: set[int] = set()  # those that hold an article, or are forms
    parts: list[str] = []
    linked, link_end, links, heading, articles, breaks, wrapped = 0, 0, False, False, 0, 0, 0

    def flush() -> None:
        nonlocal linked, heading
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            _, apart, article, wraps = stack[-1] if stack else ("", False, 0, ())
            listed = any(x[0] in _LISTS for x in stack)
            out.append(Block(text, min(linked, len(text)), article, apart, heading, listed, wraps))
        parts.clear()
        linked, heading = 0, False

    at = 0
    while True:
        tag = _TAG.search(page, at)
        run = page[at : tag.start() if tag else len(page)]
        if run:
            parts.append(run)
            if links:
                linked += len(" ".join(html.unescape(run).split()))
            if not run.isspace():
                breaks = 0
        if tag is None:
            break
        at = tag.end()
        if tag["name"] is None:
            if tag[0].startswith("<![CDATA["):
                parts.append(html.escape(tag[0][9:].removesuffix("]]>")))
            continue
        name, closing, rest = tag["name"].lower(), bool(tag["close"]), tag["rest"]
        if name in _RAW and not closing:
            if not rest.endswith("/>") and name not in _VOID:
                end = re.compile(rf"</{name}(?![\w-])[^>]*(?:>|\Z)", re.I).search(page, at)
                if end is None and name not in ("script", "style"):
                    end = _BLOCK_TAG.search(page, at)
                    at = end.start() if end else len(page)
                else:
                    at = end.end() if end else len(page)
            parts.append(" ") if name in ("button", "select", "textarea") else None
            continue
        if name == "br":
            parts.append(" ")
            breaks += 1
            if breaks > 1:
                flush()
            continue
        if name == "a":
            links = not closing and "href" in rest.lower()
            link_end = _link_end(page, at) if links else 0
            continue
        if name in _BLOCK:
            flush()
            links = links and at <= link_end  # a link goes on over blocks if it is closed
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if name in _VOID or rest.endswith("/>"):
            continue
        if name in _BLOCK:
            if name == "p" and stack and stack[-1][0] == "p" or name == "li" and stack and stack[-1][0] == "li":
                stack.pop()
            _, outer, inside, wraps = stack[-1] if stack else ("", False, 0, ())
            apart, loose, article = _marks(name, rest, inside > 0)
            if article and not inside and not (apart or outer):
                articles += 1
                inside = articles
                wrappers.update(wraps)
            if apart and loose and not inside:
                wrapped += 1
                wraps, apart = (*wraps, wrapped), False
                if name == "form":
                    wrappers.add(wrapped)
            stack.append((name, outer or apart, inside, wraps))
            heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
        elif "=" in rest and _marks(name, rest, True)[0]:
            # an inline element that stands apart is a block of its own
            flush()
            _, outer, inside, wraps = stack[-1] if stack else ("", False, 0, ())
            stack.append((name, True, inside, wraps))
    flush()
    return _settled(out, wrappers)


def _settled(found: list[Block], wrappers: set[int]) -> list[Block]:
    """``apart`` with the wrappers taken into account: those of ``wrappers`` that hold half of the stop words don't count."""
    if not any(b.wraps for b in found):
        return found
    held: dict[int, int] = {}
    total = 0
    for b in found:
        own = 0 if b.apart else sum(w in STOP_WORDS for w in _WORD.findall(b.text.lower()))
        total += own
        for wrap in b.wraps:
            held[wrap] = held.get(wrap, 0) + own
    free = {wrap for wrap in wrappers if held.get(wrap, 0) * 2 >= total}
    return [b if not b.wraps else b._replace(apart=b.apart or not free.issuperset(b.wraps)) for b in found]


def labels(found: list[Block]) -> list[bool]:
    """Whether each block is content."""
    has_article = any(b.article and not b.apart for b in found)
    first: list[bool | None] = []
    for b in found:
        links = b.linked / len(b.text)
        if b.apart or (has_article and not b.article):
            first.append(False)
        elif links > MOST_LINKS and not (b.article and not b.listed and (links < ALL_LINKS or len(b.text) >= SHORT)):
            first.append(False)
        elif len(b.text) < SHORT:
            first.append(False if b.linked and not b.article else None)
        else:
            words = _WORD.findall(b.text.lower())
            stop = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
            if stop >= MANY_STOP_WORDS or (stop >= FEW_STOP_WORDS and len(b.text) > LONG):
                first.append(True)
            elif b.article or stop >= FEW_STOP_WORDS:
                first.append(None)
            else:
                first.append(False)
    decided = [i for i, x in enumerate(first) if x is not None]
    within: dict[int, list[int]] = {}  # parts that stand apart say nothing about an article's own blocks
    for i in decided:
        if not found[i].apart:
            within.setdefault(found[i].article, []).append(i)
    return [x if x is not None else _inherited(i, found, first, within.get(found[i].article, []) if found[i].article else decided) for i, x in enumerate(first)]


def _inherited(i: int, found: list[Block], first: list[bool | None], near: list[int]) -> bool:
    """The label of an ambiguous block from those of ``near``, the decided blocks of its neighbourhood in order."""
    k = bisect(near, i)
    before, after = near[k - 1] if k else None, near[k] if k < len(near) else None
    if found[i].article:
        # within an article only a block between two that are made of links is boilerplate
        return before is None or after is None or bool(first[before] or first[after])
    above, below = before is not None and bool(first[before]), after is not None and bool(first[after])
    if above == below:
        return above
    if found[i].heading:
        return below
    content = before if above else after
    return abs(content - i) == 1 and len(found[content].text) > LONG


def main_text(page: str) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, content in zip(found, labels(found), strict=True) if content)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for each row of ``pages`` (page_id, url, html and any other columns)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page) if page else "" for page in batch["html"].to_pylist()]
            yield pa.record_batch(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    kinds = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds}, url string, text string, n_chars bigint")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {"op7_main_text": op7_main_text}
ORACLE: dict[str, str] = {}

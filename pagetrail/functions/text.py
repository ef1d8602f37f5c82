"""Column expressions over page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of a link, a tag and a word.
LINK_ANY_CASE = r'(?i)HREF="(\p{Nd}+)\.html"'
LINK_UPPER_CASE = r'HREF="(\p{Nd}+)\.html"'
TAG = r"<[^>]+>"
# A word is a whole run of letters, digits and underscores that happens to be all a-z. Look-arounds spell the
# boundary out because \b differs between regex engines on accented text.
WORD = r"(?<![\p{L}\p{N}_])[a-z]++(?![\p{L}\p{N}_])"
HTML_SUFFIX = ".html"
REPLACEMENT_CHARACTER = "\ufffd"
# Two noncharacters, never exchanged as text; they stand in for a genuine U+FFFD while bad bytes are removed.
_KEEP_MARK = "\ufdd0\ufdd1"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_id(path: Column) -> Column:
    """Base name without any ``.html``; ids stay strings, so ``007`` and ``7`` differ."""
    return F.replace(base_name(path), F.lit(HTML_SUFFIX), F.lit(""))


def numeric_file_id(path: Column) -> Column:
    """Trailing number of ``<number>.html`` as a bigint, NULL for any other name."""
    digits = F.regexp_extract(path, r"(\d+)\.html$", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def drop_undecodable(raw: Column) -> Column:
    """UTF-8 text of ``raw`` (binary) without the bytes that do not decode."""
    text = raw.cast("string")
    marked = F.make_valid_utf8(F.replace(text, F.lit(REPLACEMENT_CHARACTER), F.lit(_KEEP_MARK)))
    cleaned = F.replace(
        F.replace(marked, F.lit(REPLACEMENT_CHARACTER), F.lit("")),
        F.lit(_KEEP_MARK),
        F.lit(REPLACEMENT_CHARACTER),
    )
    return F.when(F.is_valid_utf8(text), text).otherwise(cleaned)


def link_targets(content: Column) -> Column:
    """Link targets as strings, repeated links kept, ``href`` in any case."""
    return F.regexp_extract_all(content, F.lit(LINK_ANY_CASE), F.lit(1))


def numeric_link_targets(content: Column) -> Column:
    """Targets of upper-case ``HREF`` links as bigints.

    A number beyond bigint becomes NULL: it names no page but still counts as an outgoing link.
    """
    found = F.regexp_extract_all(content, F.lit(LINK_UPPER_CASE), F.lit(1))
    return F.transform(found, lambda target: target.try_cast("bigint"))


def words(content: Column) -> Column:
    """Lower-case words of the text outside tags, in order."""
    return F.regexp_extract_all(F.lower(F.regexp_replace(content, TAG, " ")), F.lit(WORD), F.lit(0))


def word_pairs(tokens: Column) -> Column:
    """Structs (first, second) of neighbouring words; empty below two words."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(tokens, F.lit(1), pairs).alias("first"), F.slice(tokens, F.lit(2), pairs).alias("second")
    )


def bigram(first: Column, second: Column) -> Column:
    return F.concat(first, F.lit(" "), second)

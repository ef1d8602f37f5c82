"""Column expressions over HTTP requests: headers, paths, embargo."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Countries under embargo, compared exactly.
EMBARGOED_COUNTRIES = (
    "North Korea",
    "Iran",
    "Cuba",
    "Myanmar",
    "Iraq",
    "Libya",
    "Sudan",
    "Zimbabwe",
    "Syria",
)

# Header spellings of "this client is banned".
BANNED_FLAGS = ("1", "true", "yes", "y")

# The characters Python's str.strip() treats as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: what Python's float() reads as a finite number.
FLOAT_TEXT = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


# Headers that carry client metadata.
CLIENT_HEADERS = (
    "X-country", "X-client-ip", "X-forwarded-for", "X-gender", "X-age", "X-income", "X-is-banned", "X-banned"
)


def with_headers(rows: DataFrame, names: tuple[str, ...] = CLIENT_HEADERS) -> DataFrame:
    """``rows`` with one raw value column per wanted header, read by ``raw`` and ``first``.

    Names match in any case and the first of a repeated header counts. The steps are separate projections, so each
    value is worked out once per row however often it is used.
    """
    keyed = rows.withColumns(
        {"_names": F.transform(F.map_keys("headers"), F.lower), "_values": F.map_values("headers")}
    )
    places = {
        f"_raw_{name}": F.get("_values", (F.array_position("_names", F.lit(name.lower())) - 1).cast("int"))
        for name in names
    }
    found = keyed.withColumns(places).drop("_names", "_values")
    return found.withColumns({f"_text_{name}": strip(raw(name)) for name in names})


def without_headers(rows: DataFrame) -> DataFrame:
    return rows.drop(*[name for name in rows.columns if name.startswith(("_raw_", "_text_"))])


def raw(name: str) -> Column:
    return F.col(f"`_raw_{name}`")


def first(*names: str) -> Column:
    """First non-blank value among the headers ``names``, stripped; NULL if there is none."""
    texts = [F.col(f"`_text_{name}`") for name in names]
    return F.coalesce(*[F.when(text != "", text) for text in texts])


def client_ip(remote_addr: Column) -> Column:
    listed = F.coalesce(first("X-client-ip", "X-forwarded-for"), remote_addr, F.lit(""))
    return F.when(F.contains(listed, F.lit(",")), strip(F.split_part(listed, F.lit(","), F.lit(1)))).otherwise(listed)


def age(text: Column) -> Column:
    """Whole years by truncation of stripped text; NULL for anything that is not a finite number."""
    number = F.when(F.regexp_like(text, F.lit(FLOAT_TEXT)), F.replace(text, F.lit("_"), F.lit("")))
    return number.try_cast("double").try_cast("int")


def is_embargoed(country: Column) -> Column:
    return F.coalesce(country.isin(*EMBARGOED_COUNTRIES), F.lit(False))


def is_banned(country: Column) -> Column:
    flag = F.lower(F.coalesce(first("X-is-banned", "X-banned"), F.lit("")))
    return flag.isin(*BANNED_FLAGS) | is_embargoed(country)


def with_html_suffix(name: Column) -> Column:
    return F.when(F.endswith(name, F.lit(".html")), name).otherwise(F.concat(name, F.lit(".html")))


def page_of_full_path(path: Column, bucket: str) -> Column:
    """Page name behind a path: one leading ``<bucket>/`` is dropped, ``.html`` is added if absent."""
    prefix = f"{bucket}/"
    return with_html_suffix(
        F.when(F.startswith(path, F.lit(prefix)), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)
    )


def page_of_last_segment(path: Column) -> Column:
    """Page name behind a path whose directories are ignored."""
    return with_html_suffix(F.substring_index(path, "/", -1))


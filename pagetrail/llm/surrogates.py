r"""Operator 8: personal data replaced by keyed surrogates, with built-in functions only.

Detected: e-mail addresses, names after a form of address (any number of given names and initials, particles, family names with
apostrophes or hyphens) and further mentions of those names in the same text, access keys, passwords after ``password=``, hexadecimal
tokens of any length from 32, IBANs, social security numbers, IP addresses of both versions, phone and card numbers. Phone
numbers of seven digits need a word such as "call" before them or the exchange 555. A surrogate is derived from a keyed hash of the
entity and

* has its type and format: separators, letter case, length, country prefix; card numbers and IBANs have valid check digits
  if the original has, and only then; e-mail addresses of one domain share a domain; tokens stay hexadecimal;
* of a name has its script (Latin, Cyrillic, Greek) and, for given names, the gender that forms of address tell most often in
  all texts; given and family names are entities of their own, so "Dr Anna Berg", "Mrs Anna Berg" and "Mrs Berg" stay one person;
* is the same wherever the entity occurs (coreference; letter case of e-mail addresses doesn't matter), and no other entity has it
  (distinctness): surrogates are checked against each other and against all entities of the corpus, and those that collide are
  derived anew.

Null texts stay null, texts without entities are not touched or shuffled. Repeated rows give equal results, and of entities that
start at one place the first type of ``PATTERNS`` counts. No length of a text, or of a run in it, changes what is found. ``n_chars``, if
there, follows the new text. Columns named ``n_entities`` or ``entity_types`` are replaced where they are asked for; other columns are
carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.session import materialize, scratch_path

# Forms of address by the gender that they tell.
MALE = ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Госпожа", "Κυρία")
NEUTRAL = ("Dr", "Prof", "Professor")

_ADDRESS = "|".join(sorted((*MALE, *FEMALE, *NEUTRAL), key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Words that announce a password, in any letter case.
_PASSWORD = "(?i:password|passwd|pwd)"
_WORD = r"\p{Lu}(?:['’]\p{Lu})?+\p{L}++(?:['’-]\p{L}++)*+"
#: Words that belong to a family name, and words before a phone number.
_PARTICLE = r"(?:von(?: und zu| der| den| dem)?+|van(?: der| den| de)?+|vom|zu|de(?: la| las| los)?+|del|della|di|da|dos|du|bin|ibn|al|el|ter|ten|af|av)"
_CALLED = "(?i:phone|tel|telephone|call|fax|mobile|cell|whatsapp|sms|telefon|fon|handy|anruf|tél|téléphone|portable|teléfono|móvil)"
_UNIT = rf"(?:{_PARTICLE} )?+(?:\p{{Lu}}\.|{_WORD})"
_LEAD = rf"(?:(?:{_ADDRESS})\.? )++"
_H16 = "[0-9A-Fa-f]{1,4}"
#: Repetitions are possessive or as long as the format itself, so long runs are found whole and cost no more than others.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++(?<=\p{L}\p{L})",
    "name": rf"(?<![\p{{L}}\p{{N}}]){_LEAD}{_UNIT}(?: {_UNIT})*+",
    "key": r"(?<![A-Za-z0-9])A[KS]IA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "password": rf"(?<![A-Za-z0-9]){_PASSWORD}\s?[=:]\s?[^\s\"',;]+",
    "token": r"(?<![A-Za-z0-9])(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{32,}+(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "ipv6": rf"(?<![\w:.])(?=[:A-Fa-f]*+[0-9])(?:(?:{_H16}:){{7}}{_H16}|(?=(?:[0-9A-Fa-f]{{0,4}}:){{2,7}}[0-9A-Fa-f]{{0,4}}(?![\w:]))"
    rf"(?:{_H16}(?::{_H16})*+)?+::(?:{_H16}(?::{_H16})*+)?+)(?![\w:])",
    "card": r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w-])|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)"
    rf"|(?<![\w.+-])[2-9]\d{{9}}(?![\w-]|\.\d)|(?<![\w.+-])(?:(?<={_CALLED}[.:]? ?)[2-9]\d{{2}}|555)[ .-]?\d{{4}}(?![\w-]|\.\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every entity holds one of these; most texts do not.
HINT = rf"[0-9@]|(?=[pP{''.join(sorted({x[0] for x in (*MALE, *FEMALE, *NEUTRAL)}))}])(?:{_PASSWORD}\s?[=:]|(?:{_ADDRESS})\.? \p{{L}})"
#: From this attempt on the space of surrogates is widened, so that even the smallest one suffices.
_WIDEN = 4

_LATIN, _CYRILLIC, _GREEK = ("bdfgklmnprstvw", "aeiou"), ("бвгдзклмнпрст", "аеиоу"), ("βγδκλμνπρσφ", "αειου")


def _sql(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def matches(text: Column | str) -> Column:
    """The entities of a text in order, as they stand; empty for null."""
    text = F.col(text) if isinstance(text, str) else text
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    return F.coalesce(found, F.array().cast("array<string>"))


#: A match alone lacks what stands before it: seven digits are a phone number then.
_ALONE = PATTERNS | {"phone": PATTERNS["phone"] + r"|[2-9]\d{2}[ .-]?\d{4}"}
_TYPE = "CASE " + " ".join(f"WHEN m RLIKE {_sql('^(?:' + p + ')$')} THEN '{t}'" for t, p in _ALONE.items()) + " ELSE 'token' END"
_GENDER = (
    f"CASE WHEN m RLIKE {_sql('^(?:' + '|'.join(MALE) + r')\b')} THEN 'm' "
    f"WHEN m RLIKE {_sql('^(?:' + '|'.join(FEMALE) + r')\b')} THEN 'f' ELSE 'n' END"
)
_BARE = f"regexp_replace(m, {_sql('^' + _LEAD)}, '')"


def _one(key: str) -> str:
    """Pieces of a match that is one entity: text before it, the entity and its key."""
    return f"array(named_struct('gap', '', 'text', m, 'key', {key}))"


_NAME_KEY = (
    "CASE WHEN w RLIKE '^\\\\p{Ll}' THEN CAST(NULL AS STRING) WHEN w RLIKE '^.[.]$' THEN concat('initial|', w) "
    f"WHEN i = size(split({_BARE}, ' ')) - 1 THEN concat('family|', w) ELSE concat('given_', {_GENDER}, '|', w) END"
)
_LEAD_OF = f"regexp_extract(m, {_sql('^' + _LEAD)}, 0)"
_PASSWORD_LEAD = "regexp_extract(m, '^[A-Za-z]+\\\\s?[=:]\\\\s?', 0)"
#: A match as pieces (gap, text, key): the gap stays, the text is replaced by the surrogate of the key if it has one.
_PIECES = f"""CASE WHEN array_contains(_family, m) THEN {_one("concat('family|', m)")}
  WHEN array_contains(_given, m) THEN {_one("concat('given_n|', m)")}
  ELSE CASE {_TYPE}
  WHEN 'name' THEN transform(split({_BARE}, ' '), (w, i) ->
    named_struct('gap', IF(i = 0, {_LEAD_OF}, ' '), 'text', w, 'key', {_NAME_KEY}))
  WHEN 'password' THEN array(named_struct('gap', {_PASSWORD_LEAD}, 'text', substr(m, length({_PASSWORD_LEAD}) + 1),
    'key', concat('password|', substr(m, length({_PASSWORD_LEAD}) + 1))))
  WHEN 'email' THEN {_one("concat('email|', lower(m))")}
  ELSE {_one(f"concat({_TYPE}, '|', m)")} END END"""


def _pieces(found: str) -> Column:
    return F.expr(f"transform({found}, m -> {_PIECES})")


def _names(kind: str) -> Column:
    """The names of a kind among the matches of a text that later mentions are looked for, at least three letters long."""
    key = f"x.key LIKE '{kind}%' AND length(x.text) > 2"
    return F.expr(f"array_distinct(transform(filter(flatten(_pieces), x -> {key}), x -> x.text))")


#: ANY, and the names of this text as whole words.
_ANY_OF_TEXT = f"""IF(size(_family) + size(_given) = 0, {_sql(ANY)}, concat({_sql(ANY)}, '|(?<![\\\\p{{L}}\\\\p{{N}}])(?:\\\\Q',
  array_join(concat(_family, _given), '\\\\E|\\\\Q'), '\\\\E)(?![\\\\p{{L}}\\\\p{{N}}])'))"""


# ---- derivation of a surrogate from `value` and the hexadecimal hash `h` -------------------------------------------------

_BYTE = "CAST(conv(substr(h, 2 * pmod(i, 64) + 1, 2), 16, 10) AS INT)"


def _pick(alphabet: str) -> str:
    return f"substr('{alphabet}', pmod({_BYTE}, {len(alphabet)}) + 1, 1)"


def _disguise(value: str, hexadecimal: bool = False, keep_zero: bool = False) -> str:
    """Each character replaced by one of its kind."""
    small, digits = ("abcdef", "0123456789") if hexadecimal else ("abcdefghijklmnopqrstuvwxyz", "0123456789")
    zero = "WHEN c = '0' THEN '0' WHEN c BETWEEN '1' AND '9' THEN " + _pick("123456789") if keep_zero else ""
    return f"""array_join(transform(split({value}, ''), (c, i) -> CASE {zero}
      WHEN c RLIKE '[0-9]' THEN {_pick(digits)}
      WHEN c RLIKE '[A-Z]' THEN upper({_pick(small)})
      WHEN c RLIKE '\\\\p{{IsCyrillic}}' THEN {_pick(''.join(_CYRILLIC))}
      WHEN c RLIKE '\\\\p{{IsGreek}}' THEN {_pick(''.join(_GREEK))}
      WHEN c RLIKE '\\\\p{{L}}' THEN {_pick(small)} ELSE c END), '')"""


def _luhn(number: str) -> str:
    """Sum of digits, every second one from the right doubled."""
    each = "CASE WHEN i % 2 = 1 THEN IF(CAST(c AS INT) > 4, 2 * CAST(c AS INT) - 9, 2 * CAST(c AS INT)) ELSE CAST(c AS INT) END"
    digits = f"regexp_replace({number}, '[^0-9]', '')"
    return f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> {each}), 0, (a, x) -> a + x)"


def _card() -> str:
    body = f"concat(substr(value, 1, 1), substr({_disguise('value')}, 2, length(value) - 2))"
    check = f"pmod(10 - {_luhn(f'concat({body}, 0)')}, 10)"
    valid = f"{_luhn('value')} % 10 = 0"
    return f"concat({body}, CAST(IF({valid}, {check}, ({check} + 1 + pmod(ascii(h), 9)) % 10) AS STRING))"


def _iban() -> str:
    rest = f"substr({_disguise('value')}, 5)"
    step = "(a, c) -> IF(c BETWEEN '0' AND '9', (a * 10 + CAST(c AS INT)) % 97, (a * 100 + ascii(c) - 55) % 97)"
    order = f"split(concat(replace({rest}, ' ', ''), substr(value, 1, 2), '00'), '')"
    digits = f"(98 - aggregate({order}, 0, {step}))"
    original = "split(concat(substr(replace(value, ' ', ''), 5), substr(value, 1, 4)), '')"
    valid = f"aggregate({original}, 0, {step}) = 1"
    other = f"(pmod({digits} - 1 + pmod(ascii(h), 95), 97) + 2)"
    return f"concat(substr(value, 1, 2), lpad(CAST(IF({valid}, {digits}, {other}) AS STRING), 2, '0'), {rest})"


def _name(ending: str) -> str:
    """A pronounceable name in the script of the value; ``ending`` chooses the last syllable by gender."""

    def of(script: tuple[str, str], female: str, male: str) -> str:
        consonants, vowels = script
        number = "least(greatest(2, CAST(ceil(length(value) / 3) AS INT)), 4)"
        syllable = f"concat({_pick(consonants)}, substr('{vowels}', pmod(CAST(conv(substr(h, 2 * i + 33, 2), 16, 10) AS INT), {len(vowels)}) + 1, 1))"
        word = f"array_join(transform(sequence(0, {number}), i -> {syllable}), '')"
        return f"initcap(concat({word}, '{dict(f=female, m=male, n='')[ending]}'))"

    return (
        f"CASE WHEN value RLIKE '\\\\p{{IsCyrillic}}' THEN {of(_CYRILLIC, 'на', 'н')} "
        f"WHEN value RLIKE '\\\\p{{IsGreek}}' THEN {of(_GREEK, 'να', 'νος')} ELSE {of(_LATIN, 'na', 'n')} END"
    )


def _octets(first: str) -> str:
    rest = [f"CAST(conv(substr(h, {2 * i + 1}, 2), 16, 10) AS INT)" for i in range(1, 4)]
    return "concat_ws('.', " + ", ".join([first, *rest]) + ")"


_DOMAIN = "substring_index(value, '@', -1)"
_SURROGATE = f"""CASE type
  WHEN 'email' THEN concat({_disguise("substring_index(value, '@', 1)")}, '@',
    translate(substr(sha2(concat(secret, '|domain|', lower({_DOMAIN})), 256), 1, 12), '0123456789', 'ghijklmnop'), '.example.',
    substring_index({_DOMAIN}, '.', -1))
  WHEN 'given_m' THEN {_name('m')}
  WHEN 'given_f' THEN {_name('f')}
  WHEN 'given_n' THEN {_name('n')}
  WHEN 'family' THEN {_name('n')}
  WHEN 'initial' THEN concat(upper({_disguise("lower(substr(value, 1, 1))")}), '.')
  WHEN 'ipv6' THEN {_disguise('value', hexadecimal=True)}
  WHEN 'key' THEN concat(substr(value, 1, 4), substr({_disguise('value')}, 5))
  WHEN 'token' THEN {_disguise('value', hexadecimal=True)}
  WHEN 'iban' THEN {_iban()}
  WHEN 'ssn' THEN concat('9', substr({_disguise('value')}, 2))
  WHEN 'ip' THEN IF(attempt < {_WIDEN}, {_octets("'10'")}, {_octets("CAST(pmod(CAST(conv(substr(h, 9, 2), 16, 10) AS INT), 223) + 1 AS STRING)")})
  WHEN 'phone' THEN concat(regexp_extract(value, '^(\\\\+\\\\d{{1,3}}(?=\\\\D))?', 0),
    substr({_disguise('value', keep_zero=True)}, length(regexp_extract(value, '^(\\\\+\\\\d{{1,3}}(?=\\\\D))?', 0)) + 1))
  WHEN 'card' THEN {_card()}
  ELSE concat({_disguise('value')}, IF(attempt < {_WIDEN}, '', substr(h, 65, attempt))) END"""


def _derived(entities: DataFrame, secret: str, attempt: int) -> DataFrame:
    """entities (type, value) with ``surrogate``. Names that go on colliding get a further syllable of letters."""
    seed = f"concat(secret, '|', type, '|', {attempt}, '|', value)"
    keyed = entities.withColumn("secret", F.lit(secret)).withColumn("attempt", F.lit(attempt))
    keyed = keyed.withColumn("h", F.expr(f"concat(sha2(concat(secret, sha2({seed}, 256)), 256), sha2(concat(secret, '|', {seed}), 256))"))
    more = "array_join(transform(sequence(1, attempt), i -> " + _pick("aeioulmnrst") + "), '')"
    widened = f"IF(attempt >= {_WIDEN} AND (type IN ('family', 'initial') OR type LIKE 'given%'), concat(s, {more}), s)"
    return keyed.withColumn("s", F.expr(_SURROGATE)).withColumn("surrogate", F.expr(widened)).select("type", "value", "surrogate")


def surrogate_table(entities: DataFrame, secret: str) -> DataFrame:
    """type, value, surrogate for each entity (type, value) once: no two surrogates of a type are equal, none is an entity."""
    entities = materialize(entities.distinct(), "entities")
    pending, taken, attempt = entities, None, 0
    while True:
        tried = materialize(_derived(pending, secret, attempt), "surrogates-tried")
        first = tried.groupBy("type", "surrogate").agg(F.min("value").alias("value"))
        won = tried.join(first, ["type", "surrogate", "value"], "left_semi")
        won = won.join(entities.select("type", F.col("value").alias("surrogate")), ["type", "surrogate"], "left_anti")
        if taken is not None:
            won = won.join(taken.select("type", "surrogate"), ["type", "surrogate"], "left_anti")
        won = materialize(won.select("type", "value", "surrogate"), "surrogates-won")
        taken = won if taken is None else taken.unionByName(won)
        pending = tried.join(won, ["type", "value"], "left_anti").select("type", "value")
        if pending.isEmpty():
            return taken
        attempt += 1


def _with_genders(entities: DataFrame) -> DataFrame:
    """part and count of all entities as type, value and part; the type of a given name is that of its most frequent gender."""
    kind, value = F.substring_index("part", "|", 1), F.expr("substr(part, instr(part, '|') + 1)")
    split = entities.select("part", kind.alias("type"), value.alias("value"), "n")
    given = split.filter("type LIKE 'given%'").groupBy("value").agg(
        *(F.sum(F.when(F.col("type") == f"given_{g}", F.col("n")).otherwise(0)).alias(g) for g in "fm")
    )
    told = F.when((F.col("f") >= F.col("m")) & (F.col("f") > 0), "given_f").when(F.col("m") > 0, "given_m").otherwise("given_n")
    given = given.select("value", told.alias("told"))
    joined = split.join(given.withColumnRenamed("value", "_value"), F.col("type").like("given%") & (F.col("value") == F.col("_value")), "left")
    return joined.select("part", F.coalesce("told", "type").alias("type"), "value")


def pseudonymise(docs: DataFrame, secret: str, details: bool = False) -> DataFrame:
    """``docs`` with surrogates in ``text``; ``details`` adds n_entities and the sorted entity_types.

    Texts are searched once, and written apart by whether anything was found. Only texts with entities take part in the joins: the table
    of their entities is joined with the surrogates, and the surrogates of each text, by the hash of the text, with the documents.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if not details or c not in ("n_entities", "entity_types")]
    held = ["_body" if c == "text" else f"c{i}" for i, c in enumerate(names)]
    rows = docs.select(*(F.col(f"`{c}`").alias(h) for c, h in zip(names, held, strict=True)))
    rows = rows.withColumn("_found", matches("_body")).withColumn("_any", F.size("_found") > 0)
    path = scratch_path(spark, "entity-rows")
    rows.write.partitionBy("_any").parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    columns = [F.col(h).alias(c) for c, h in zip(names, held, strict=True)]
    no_types = F.array().cast("array<string>")
    plain = [F.lit(0).alias("n_entities"), no_types.alias("entity_types")] if details else []
    untouched = rows.filter("NOT _any").select(*columns, *plain)

    none = F.array().cast("array<string>")
    hits = rows.filter("_any").withColumns({"_family": none, "_given": none}).withColumn("_pieces", _pieces("_found"))
    hits = hits.withColumns({"_family": _names("family|"), "_given": _names("given")})
    # a name that is a given one here and a family one there counts as a family name
    hits = hits.withColumn("_given", F.array_except("_given", "_family"))
    again = F.size("_family") + F.size("_given") > 0
    found = F.when(again, F.expr(f"regexp_extract_all(_body, {_ANY_OF_TEXT}, 0)")).otherwise(F.col("_found"))
    hits = hits.withColumn("_found", found).withColumn("_pieces", _pieces("_found")).withColumn("_text", F.xxhash64("_body"))
    hits = materialize(hits, "entity-texts")

    every = hits.select("_text", F.explode(F.flatten("_pieces")).alias("x")).filter("x.key IS NOT NULL")
    counted = materialize(every.groupBy("_text", F.col("x.key").alias("part")).agg(F.count("*").alias("n")), "entity-places")
    entities = _with_genders(counted.groupBy("part").agg(F.sum("n").alias("n")))
    entities = materialize(entities, "entity-parts")
    table = surrogate_table(entities.select("type", "value"), secret)
    table = entities.join(table, ["type", "value"]).select("part", "surrogate")
    of_text = counted.join(table, "part").groupBy("_text")
    of_text = of_text.agg(F.map_from_entries(F.collect_list(F.struct("part", "surrogate"))).alias("_map"))
    of_text = materialize(of_text, "surrogates-by-text")

    # a hash that two texts share could leave an entity without surrogate; its type then stands in its place
    new = "coalesce(try_element_at(_map, x.key), concat('[', substring_index(x.key, '|', 1), ']'))"
    cased = f"IF(x.key LIKE 'email|%' AND x.text = upper(x.text), upper({new}), {new})"
    one = f"concat(x.gap, IF(x.key IS NULL, x.text, {cased}))"
    replaced = F.expr(f"transform(_pieces, p -> array_join(transform(p, x -> {one}), ''))")
    changed = hits.join(of_text, "_text", "left")
    between = F.expr(f"split(_body, {_ANY_OF_TEXT}, -1)")
    text = F.array_join(F.zip_with(between, F.concat(replaced, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    changed = changed.withColumn("_new", text)
    kinds = F.expr(f"array_sort(array_distinct(transform(_found, m -> IF(array_contains(_family, m) OR array_contains(_given, m), 'name', {_TYPE}))))")
    added = [F.size("_found").alias("n_entities"), kinds.alias("entity_types")] if details else []
    own = {"text": F.col("_new"), "n_chars": F.length("_new")}
    columns = [own[c].cast(docs.schema[c].dataType).alias(c) if c in own else column for c, column in zip(names, columns, strict=True)]
    return changed.select(*columns, *added).unionByName(untouched)


#: The registered query needs some key; a real run passes its own.
QUERY_SECRET = "pagetrail query"


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, text with surrogates, n_entities, entity_types."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, QUERY_SECRET, details=True)


QUERIES = {"op8_surrogates": op8_surrogates}
ORACLE: dict[str, str] = {}

"""Operator 11: phrases whose words stand together more often than chance has it, by sorting suffix pointers.

A suffix is what begins at a word of a piece of text, up to ``most`` words long. Phrases are prefixes of suffixes.

1. One scan counts words, and numbers every two leading words by a hash. A hash that is rarer than the wanted count ends all
   phrases with these two words, so its suffixes are abandoned; two pairs with one hash only mean that a suffix is kept for
   nothing. The frequent hashes go to all tasks as a bit field of a bounded size.
2. A second scan emits the suffixes that are left, cut before their first rare pair, equal ones summed.
3. Suffixes are routed by their leading words to ranges of their order: as many words lead as are needed to cut a range,
   so a pair of words that is very common is spread over several tasks.
4. Each task sorts pointers to its suffixes by multikey quicksort: the pointers are parted in three by the word at the
   present depth, those with the pivot's word are sorted by the next word, down to ``most`` words. The weight of an equal part
   is the count of its phrase. Parts below the wanted count are abandoned unsorted. The phrases that the first and last
   suffix of a task begin with may go on in the neighbouring task; they leave with what the task holds of them and are summed.

Null texts are empty, a null language is ``und``. Repeated rows count as often as they are there. A very long text is read in
stretches that end between pieces. Ties in the result are ordered by phrase in UTF-8.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagetrail.llm.textcodes import mix, slices
from pagetrail.session import materialize

LEAST = 100
MOST_WORDS = 5
TOP = 2000
#: A phrase goes if a longer one around it has this share of its count, in percent.
SHARE = 100
#: Bytes of text that are tokenised at once.
STRETCH = 1 << 20
#: Distinct suffixes of one task.
SUFFIXES = 1_000_000
#: Bits of the field of frequent pairs: so many for each, within these powers of two. The largest field has 64 MB.
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 16, 29
_TOKEN = re.compile(rb"[.,;:!?\n-\r]|[^\t .,;:!?\n-\r]+")
_END = re.compile(rb"[.,;:!?\n-\r]")
_ENDS = [bytes([x]) for x in b".,;:!?\n\x0b\x0c\r"]


class _Numbers(dict):
    """Numbers words in the order in which they turn up; marks between pieces have 0."""

    def __init__(self):
        super().__init__((mark, 0) for mark in _ENDS)
        self.words = [b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


def _stretches(texts: Iterable[str]) -> Iterator[bytes]:
    """The texts in lower case (A to Z only), joined to stretches of about STRETCH bytes that end between pieces."""
    held, size = [], 0
    for text in texts:
        data = text.encode("utf-8", "surrogatepass").lower()
        start = 0
        while len(data) - start > STRETCH and (end := _END.search(data, start + STRETCH)):
            yield data[start : end.start()]
            start = end.start()
        held.append(data[start:])
        size += len(held[-1])
        if size >= STRETCH:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """Language, word numbers (0 between pieces) and words of each stretch."""
    for batch in slices(batches, most=STRETCH):
        langs = batch["lang"]
        for lang in pc.unique(langs).to_pylist():
            texts = batch["text"].filter(pc.equal(langs, lang))
            for data in _stretches(x.as_py() for x in texts):
                numbers = _Numbers()
                found = _TOKEN.findall(data)
                yield lang, np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)), numbers.words


def _hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    text = pc.cast(pa.array(words, pa.binary()), pa.string())
    lengths = pc.binary_length(text).to_numpy().astype(np.int64)
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    ends = np.cumsum(lengths)
    place = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
    terms = mix(data + np.uint64(1) + (place.astype(np.uint64) << np.uint64(9)))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    return mix(total[ends] - total[ends - lengths] + lengths.astype(np.uint64))


def _pairs(lang: str, ids: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each place's word with the next one, and whether there is one."""
    of_word = _hashes(words)
    both = (ids[:-1] > 0) & (ids[1:] > 0)
    salt = _hashes([lang.encode()])[0]
    return mix(of_word[ids[:-1]] * np.uint64(3) + mix(of_word[ids[1:]] + salt)), both


def _counts(docs: DataFrame) -> DataFrame:
    """lang, word, pair and their count: rows of words, rows of hashed pairs without a language, and a row for all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, ids, words in _tokens(batches):
            number = np.bincount(ids, minlength=len(words))
            number[0] = 0
            pairs, both = _pairs(lang, ids, words)
            pairs, times = np.unique(pairs[both], return_counts=True)
            held = np.flatnonzero(number)
            word = pc.cast(pa.array(words, pa.binary()), pa.string()).take(pa.array(held))
            none = [pa.nulls(len(pairs), pa.string()), pa.nulls(len(held), pa.int64())]
            columns = {
                "word": pa.concat_arrays([word, none[0], pa.nulls(1, pa.string())]),
                "pair": pa.concat_arrays([none[1], pa.array(pairs.view(np.int64)), pa.nulls(1, pa.int64())]),
                "n": pa.array(np.concatenate([number[held], times, [number.sum()]]).astype(np.int64)),
            }
            of_pair = np.arange(len(columns["n"])) - len(held)
            names = pa.array(np.zeros(len(of_pair), np.int32), mask=(of_pair >= 0) & (of_pair < len(pairs)))
            yield pa.record_batch({"lang": pa.array([lang]).take(names), **columns})

    return docs.mapInArrow(count, "lang string, word string, pair bigint, n bigint")


def _field(pairs: DataFrame) -> np.ndarray:
    """A bit for each value of the leading bits of the hashes, set where ``pairs`` has one."""
    number = pairs.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (number * BITS_EACH).bit_length()))
    at = F.shiftrightunsigned("pair", 64 - bits + 6)
    bit = F.shiftrightunsigned("pair", 64 - bits).bitwiseAND(F.lit(63)).cast("int")
    # at most as many rows as the field has 64-bit numbers, however many pairs there are
    value = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    held = pairs.groupBy(at.alias("at")).agg(value.alias("value")).toArrow()
    field = np.zeros(1 << (bits - 6), np.uint64)
    field[held["at"].to_numpy()] = held["value"].to_numpy().view(np.uint64)
    return field


def _suffixes(docs: DataFrame, field: np.ndarray, most: int) -> DataFrame:
    """lang, words, n: the suffixes of two words and more that the field of frequent pairs lets pass."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        shift = np.uint64(64 - (len(frequent).bit_length() - 1))
        for lang, ids, words in _tokens(batches):
            pairs, both = _pairs(lang, ids, words)
            at, bit = pairs >> shift, (pairs >> (shift - np.uint64(6))) & np.uint64(63)
            go = np.append(both & ((frequent[at] >> bit) & np.uint64(1) > 0), False)
            at = np.flatnonzero(go)
            if not len(at):
                continue
            table, on = [ids[at], ids[at + 1]], np.ones(len(at), bool)
            for k in range(1, most - 1):
                on = on & go[np.minimum(at + k, len(go) - 1)]
                table.append(np.where(on, ids[np.minimum(at + k + 1, len(ids) - 1)], 0))
            table = np.stack(table, 1)
            order = np.lexsort(table.T[::-1])
            table = table[order]
            first = np.flatnonzero(np.append(True, (table[1:] != table[:-1]).any(1)))
            times = np.diff(np.append(first, len(table)))
            table = table[first]
            ends = np.concatenate([[0], np.cumsum((table > 0).sum(1))]).astype(np.int32)
            values = pc.cast(pa.array(words, pa.binary()), pa.string()).take(pa.array(table[table > 0]))
            yield pa.record_batch(
                {
                    "lang": pa.array([lang]).take(pa.array(np.zeros(len(table), np.int32))),
                    "words": pa.ListArray.from_arrays(pa.array(ends), values),
                    "n": pa.array(times.astype(np.int64)),
                }
            )

    return docs.mapInArrow(emit, "lang string, words array<string>, n bigint")


def equal_parts(keys: np.ndarray, weight: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """A pointer, a depth and a weight for each prefix of at least two keys whose rows in ``keys`` weigh ``least`` or more.

    Rows end with zeros. Three-way quicksort of the row numbers: a part stands for rows that agree before its depth.
    """
    parts = [(np.arange(len(keys)), 0)]
    while parts:
        rows, depth = parts.pop()
        if weight[rows].sum() < least:
            continue
        column = keys[rows, depth]
        pivot = np.partition(column, len(column) // 2)[len(column) // 2]
        equal = rows[column == pivot]
        parts += [(part, depth) for part in (rows[column < pivot], rows[column > pivot]) if len(part)]
        total = int(weight[equal].sum())
        if pivot == 0 or total < least:
            continue
        if depth > 0:
            yield int(equal[0]), depth + 1, total
        if depth + 1 < keys.shape[1]:
            parts.append((equal, depth + 1))


def _phrases(suffixes: DataFrame, least: int, most: int) -> DataFrame:
    """lang, words, a of the phrases that ``least`` suffixes begin with."""
    number = -(-suffixes.count() // SUFFIXES)
    number = max(number, int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [batch for batch in batches if batch.num_rows]
        if not some:
            return
        held = pa.Table.from_batches(some)
        words = held["words"].combine_chunks()
        lengths = words.value_lengths().to_numpy().astype(np.int64)
        names = held["lang"].combine_chunks().dictionary_encode()
        kinds, flat = names.dictionary, words.flatten().dictionary_encode()
        keys = np.zeros((len(words), most + 1), np.int64)
        keys[:, 0] = names.indices.to_numpy() + 1
        keys[:, 1:][np.arange(most) < lengths[:, None]] = flat.indices.to_numpy() + 1
        weight = held["n"].to_numpy()
        # the first and last suffix in the order of the ranges, which any order of keys keeps: equal prefixes stay together
        rank = np.zeros(len(flat.dictionary) + 1, np.int64)
        rank[1 + pc.sort_indices(pc.cast(flat.dictionary, pa.binary())).to_numpy()] = np.arange(1, len(rank))
        lang_rank = np.zeros(len(kinds) + 1, np.int64)
        lang_rank[1 + pc.sort_indices(pc.cast(kinds, pa.binary())).to_numpy()] = np.arange(1, len(lang_rank))
        keys[:, 0], keys[:, 1:] = lang_rank[keys[:, 0]], rank[keys[:, 1:]]
        order = np.lexsort(keys.T[::-1])
        ends = {tuple(keys[row, : k + 1]) for row in (order[0], order[-1]) for k in range(2, most + 1) if lengths[row] >= k}
        found = {}
        for end in ends:
            same = np.flatnonzero((keys[:, : len(end)] == end).all(1))
            found[end] = (int(same[0]), len(end) - 1, int(weight[same].sum()))
        for row, depth, total in equal_parts(keys, weight, least):
            if depth > 2:  # the language is the first key
                found.setdefault(tuple(keys[row, :depth]), (row, depth - 1, total))
        rows, counts, totals = (np.array(x, np.int64) for x in zip(*found.values(), strict=True)) if found else ([], [], [])
        yield pa.record_batch(
            {
                "lang": held["lang"].combine_chunks().take(pa.array(rows, pa.int64())),
                "words": pa.array([words[int(r)].as_py()[:k] for r, k in zip(rows, counts, strict=True)], pa.list_(pa.string())),
                "a": pa.array(totals, pa.int64()),
            }
        )

    routed = suffixes.repartitionByRange(number, "lang", "words")
    parts = routed.mapInArrow(sort, "lang string, words array<string>, a bigint")
    return parts.groupBy("lang", "words").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS, share: int = SHARE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of each language of ``docs`` (text, lang).

    Phrases have 2 to ``most`` words and occur at least ``least`` times. The score of a cut is floor(1000*a*n / (l*r)), with the counts
    of the phrase, of all words, and of what stands before and after the cut; the lowest cut counts, of equal ones the first.
    """
    if most < 2 or least < 1:
        raise ValueError("phrases have two words or more and occur at least once")
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    counted = _counts(texts).groupBy("lang", "word", "pair").agg(F.sum("n").alias("n"))
    counted = counted.filter((F.col("n") >= least) | (F.col("word").isNull() & F.col("pair").isNull()))
    counted = materialize(counted, "phrase-counts")
    field = _field(counted.filter("pair IS NOT NULL"))
    suffixes = _suffixes(texts, field, most).groupBy("lang", "words").agg(F.sum("n").alias("n"))
    phrases = materialize(_phrases(materialize(suffixes, "phrase-suffixes"), least, most), "phrases")

    words = counted.filter("word IS NOT NULL").select("lang", F.array("word").alias("words"), F.col("n").alias("f"))
    counts = words.unionByName(phrases.withColumnRenamed("a", "f"))
    size = F.size("words")
    cuts = phrases.withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.withColumns({"before": F.slice("words", 1, F.col("cut")), "after": F.slice("words", F.col("cut") + 1, size)})
    cuts = cuts.join(counts.select("lang", F.col("words").alias("before"), F.col("f").alias("l")), ["lang", "before"])
    cuts = cuts.join(counts.select("lang", F.col("words").alias("after"), F.col("f").alias("r")), ["lang", "after"])
    totals = counted.filter("word IS NULL AND pair IS NULL").select("lang", "n")
    exact = {name: f"CAST({name} AS DECIMAL(19, 0))" for name in "alrn"}
    score = F.expr("(1000BD * ({a} * {n})) div ({l} * {r})".format(**exact)).alias("score")
    scored = cuts.join(totals, "lang").select("lang", "words", "a", "cut", "l", "r", "n", score)
    best = scored.groupBy("lang", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r", "n")).alias("best"))

    longer = phrases.filter(size > 2).select(
        "lang",
        F.col("a").alias("around"),
        F.explode(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(2), size - 1),
                        lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.slice("words", i, k)),
                    )
                )
            )
        ).alias("words"),
    )
    around = longer.groupBy("lang", "words").agg(F.max("around").alias("around"))
    held = best.join(around, ["lang", "words"], "left")
    held = held.filter(F.col("around").isNull() | (F.col("around") * 100 < F.col("a") * share))
    phrase = F.array_join("words", " ")
    rows = held.select("lang", phrase.alias("phrase"), "a", "best.l", "best.r", "best.n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language and rank: phrase, a, l, r, n, score."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


_SQL = f"""WITH lowered AS (SELECT COALESCE(lang, 'und') AS lang,
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    piece AS MATERIALIZED (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM (
        SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM lowered)),
    totals AS (SELECT lang, CAST(SUM(len(w)) AS BIGINT) AS n FROM piece GROUP BY 1),
    f AS MATERIALIZED (SELECT lang, x, COUNT(*) AS f FROM (
        SELECT lang, unnest(flatten(list_transform(range(1, {MOST_WORDS + 1}),
            lambda k: list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])))) AS x FROM piece)
        GROUP BY 1, 2 HAVING COUNT(*) >= {LEAST}),
    cand AS MATERIALIZED (SELECT lang, x, f AS a FROM f WHERE len(x) >= 2),
    cut AS (SELECT lang, x, a, unnest(range(1, len(x))) AS k FROM cand),
    scored AS (SELECT c.lang, c.x, c.a, c.k, b.f AS l, e.f AS r, t.n,
            (1000::HUGEINT * c.a * t.n) // (b.f::HUGEINT * e.f) AS score
        FROM cut c JOIN f b ON b.lang = c.lang AND b.x = c.x[1 : c.k] JOIN f e ON e.lang = c.lang AND e.x = c.x[c.k + 1 : len(c.x)]
        JOIN totals t ON t.lang = c.lang),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, k) = 1),
    inner_ AS (SELECT lang, x, MAX(a) AS around FROM (
        SELECT lang, a, unnest(flatten(list_transform(range(2, len(x)),
            lambda k: list_transform(range(1, len(x) - k + 2), lambda i: x[i : i + k - 1])))) AS x FROM cand WHERE len(x) > 2) GROUP BY 1, 2),
    held AS (SELECT b.*, array_to_string(b.x, ' ') AS phrase FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.x = b.x
        WHERE i.around IS NULL OR 100 * i.around < {SHARE} * b.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
        CAST(score AS BIGINT) AS score FROM held QUALIFY rank <= {TOP}"""

QUERIES = {"op11_phrases": op11_phrases}
ORACLE = {"op11_phrases": _SQL}

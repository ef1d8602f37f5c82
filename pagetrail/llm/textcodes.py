"""Words of text columns as 64-bit codes, computed for whole Arrow batches at once.

A word is a maximal run of ASCII letters, digits, ``_`` and non-ASCII characters of the lower-cased text. Two equal words
have equal codes everywhere; two different ones share a code with odds of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are looked at together; a longer text is cut at word ends for the computation only.
SLICE_BYTES = 1 << 20
_WORD = np.zeros(256, bool)
_WORD[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_"]] = True
_WORD[128:] = True
_CYCLE = 1 << 12


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_OF_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_OF_PLACE = mix(np.arange(1, _CYCLE + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``most`` bytes in ``column``, or of one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, nulls as empty, and the offsets of each text in them."""
    texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _codes(data: np.ndarray, text_starts: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Codes of the words in ``data``, the places where the words start, and codes of the prefixes."""
    inside = _WORD[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    before[text_starts[text_starts < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, *(np.zeros(0, np.uint64) for _ in prefixes)
    places = np.flatnonzero(inside)
    first = np.searchsorted(places, starts)
    place_in_word = places - np.repeat(starts, np.diff(np.append(first, len(places))))
    terms = _OF_BYTE[data[places]] * _OF_PLACE[place_in_word % _CYCLE]
    words = mix(np.add.reduceat(terms, first)), starts
    if not prefixes:
        return words
    summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    lengths = np.diff(np.append(first, len(places)))
    cut = (mix(summed[first + np.minimum(n, lengths)] - summed[first] + np.uint64(n)) for n in prefixes)
    return *words, *(np.where(lengths > n, c, np.uint64(0)) for n, c in zip(prefixes, cut, strict=True))


def word_codes(texts: pa.Array, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Codes of the words of all texts in order, and the offsets of each text in them.

    For each number of bytes in ``prefixes`` an array follows: the code of that prefix of the word, 0 for words not longer.
    """
    data, offsets = utf8(pc.utf8_lower(texts))
    if len(data) <= 4 * SLICE_BYTES:
        codes, starts, *cut = _codes(data, offsets[:-1], prefixes)
        return codes, np.searchsorted(starts, offsets), *cut
    parts, start = [], 0  # one very long text: the computation, not the result, goes by pieces that end between words
    while start < len(data):
        stop = min(len(data), start + SLICE_BYTES)
        while stop < len(data) and _WORD[data[stop]] and _WORD[data[stop - 1]]:
            step = np.flatnonzero(~_WORD[data[stop : stop + SLICE_BYTES]])
            stop = stop + int(step[0]) if len(step) else min(len(data), stop + SLICE_BYTES)
        own = offsets[:-1][(offsets[:-1] >= start) & (offsets[:-1] < stop)] - start
        codes, starts, *cut = _codes(data[start:stop], own, prefixes)
        parts.append((codes, starts + start, *cut))
        start = stop
    codes, starts, *cut = (np.concatenate(x) for x in zip(*parts, strict=True))
    return codes, np.searchsorted(starts, offsets), *cut


def grams(codes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs of every text and their offsets; a text of 1 to n-1 words is one run."""
    words = np.diff(offsets)
    count = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    out = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=out[1:])
    if not out[-1]:
        return np.zeros(0, np.uint64), out
    at = np.arange(out[-1]) - np.repeat(out[:-1] - offsets[:-1], count)
    room = np.repeat(offsets[1:], count) - at
    padded = np.concatenate([codes, np.zeros(n, np.uint64)])
    total = np.zeros(len(at), np.uint64)
    for i in range(n):
        term = padded[at + i] * _OF_PLACE[i]
        total += np.where(room > i, term, np.uint64(0)) if i else term
    return mix(total), out


def keep_columns(batch: pa.RecordBatch, names: list[str], added: dict[str, pa.Array]) -> pa.RecordBatch:
    """The named columns of ``batch`` followed by the added ones."""
    return pa.RecordBatch.from_arrays([*(batch[n] for n in names), *added.values()], names=[*names, *added])

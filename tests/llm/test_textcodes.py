import re

import numpy as np
import pyarrow as pa
import pytest

from pagetrail.llm import textcodes

TEXTS = ["One two, ONE_2 zwei-drei", None, "", "...", "Ünïcode ünïcode WORT", "a", "a a a", "x" * 9000 + " y", "日本 語"]
WORD = re.compile(r"[0-9A-Za-z_\x80-\U0010ffff]+")


def plain(text):
    return WORD.findall((text or "").lower())


def test_equal_words_have_equal_codes():
    codes, offsets = textcodes.word_codes(pa.array(TEXTS))
    words = [w for t in TEXTS for w in plain(t)]
    assert np.diff(offsets).tolist() == [len(plain(t)) for t in TEXTS]
    assert len(set(zip(words, codes.tolist()))) == len(set(words)) == len(set(codes.tolist()))


def test_sliced_batches_and_long_texts_give_the_same_codes(monkeypatch):
    whole, offsets = textcodes.word_codes(pa.array(TEXTS))
    batch = pa.record_batch({"text": pa.array(["unused", *TEXTS])}).slice(1)
    parts = [textcodes.word_codes(b["text"]) for b in textcodes.slices([batch], most=12)]
    assert np.concatenate([p[0] for p in parts]).tolist() == whole.tolist()
    monkeypatch.setattr(textcodes, "SLICE_BYTES", 7)
    pieces, at, beginning = textcodes.word_codes(pa.array(TEXTS), (4,))
    assert pieces.tolist() == whole.tolist() and at.tolist() == offsets.tolist() and len(beginning) == len(pieces)


def test_prefixes():
    codes, offsets, cut = textcodes.word_codes(pa.array(["stupid stupidity stup stu"]), (4,))
    assert cut[0] == cut[1] != 0 and cut[2] == cut[3] == 0


@pytest.mark.parametrize("n", [1, 3, 5])
def test_grams(n):
    codes, offsets = textcodes.word_codes(pa.array(TEXTS))
    found, ends = textcodes.grams(codes, offsets, n)
    expected = [tuple(w[i : i + n]) for w in map(plain, TEXTS) for i in range(max(len(w) - n + 1, min(len(w), 1)))]
    assert len(found) == len(expected) == ends[-1]
    assert len(set(zip(expected, found.tolist()))) == len(set(expected)) == len(set(found.tolist()))

import re

import numpy as np
from hypothesis import given, settings, strategies as st

from lakeloom.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


@settings(deadline=None)
@given(st.lists(st.text(alphabet="aAbZé\U0001F600 \t\n\x0b \u0085.")))
def test_words_are_those_of_the_pattern(texts):
    w = W.split(texts, lower=True)
    want = [WORD.findall(lowered(t)) for t in texts]
    assert ["".join(map(chr, w.codes[a:b])) for a, b in zip(w.starts, w.ends)] == [x for ws in want for x in ws]
    assert np.diff(w.first).tolist() == [len(ws) for ws in want]


def test_hashes_tell_words_apart_and_find_them_again():
    words = [f"w{i}" for i in range(50_000)] + ["x" * 700_000, "x" * 700_001]
    text = " ".join(words)
    h = W.split([text, text]).hashes()
    assert len(set(h.tolist())) == len(words) and (h[:len(words)] == h[len(words):]).all()


def test_no_texts():
    assert len(W.split([]).hashes()) == 0 and len(W.split(["", None or ""]).hashes()) == 0

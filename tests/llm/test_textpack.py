import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lapdeck.llm import textpack as tp

TEXT = st.one_of(st.none(), st.text(alphabet="aAbB é\n\t\x0b ß.", max_size=60), st.text(max_size=40))


def lower(s):
    return "".join(c.lower() if c < "\x80" else c for c in s)


def split(s):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(s)) if s else []


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_words_and_shingles_equal_the_plain_definition(texts):
    w = tp.words(texts)
    got = [w.data[a:a + n].tobytes().decode("utf-8", "surrogatepass") for a, n in zip(w.start, w.size, strict=True)]
    assert got == [x for t in texts for x in split(t)]
    h = tp.word_hashes(w)
    assert len(set(h.tolist())) == len(set(got))
    text, g = tp.shingles(w, 5, h)
    for i, t in enumerate(texts):
        x = split(t)
        want = {tuple(x[k:k + 5]) for k in range(len(x) - 4)} if len(x) >= 5 else {tuple(x)} if x else set()
        assert (text == i).sum() == len(want)


def test_equal_texts_in_other_places_have_equal_hashes():
    a, b = tp.words(["one two three four five six", "x"]), tp.words(["y z", "ONE two\nthree  four five six"])
    assert np.array_equal(tp.shingles(a)[1][:2], tp.shingles(b)[1][1:])


def test_words_longer_than_the_vector_loop():
    long = ["a" * 9000 + "b", "a" * 9000 + "c", "a" * 9000 + "b"]
    h = tp.word_hashes(tp.words(long))
    assert h[0] == h[2] != h[1]


def test_parts_keep_order_and_bound():
    texts = ["a" * 10, None, "b" * 50, "c", "d" * 10]
    assert list(tp.parts(texts, 20)) == [(0, 2), (2, 3), (3, 5)]
    assert list(tp.parts([])) == []

import random
import zlib

import pytest

from lapdeck.llm import langid

WORDS = {"en": "the of and that with there where thing", "fr": "le les des que dans élève être leçon", "de": "und der die das schön größe über haus"}


def longest_pieces(text, train):
    """Cross-parsing by plain substring search, with the rows that the parser uses."""
    n = 0
    for a in range(0, len(text), langid.ROW):
        row, i = text[a:a + langid.ROW], 0
        while i < len(row):
            k = 1
            while i + k < len(row) and row[i:i + k + 1] in train:
                k += 1
            i, n = i + (k if row[i] in train else 1), n + 1
    return n


def test_pieces_equal_plain_cross_parsing():
    rng = random.Random(2)
    train = {k: " ".join(rng.choice(v.split()) for _ in range(120)) for k, v in WORDS.items()}
    p = langid.Parser(train)
    texts = ["the und les", "é", "thethethe größe", " ".join(rng.choice(sum((v.split() for v in WORDS.values()), [])) for _ in range(400)), "über that"]
    got = p.pieces(texts)
    for i, t in enumerate(texts):
        for j, k in enumerate(p.languages):
            known = "".join(c if c in train[k] else "\x00" for c in t)
            assert abs(got[i, j] - longest_pieces(known, train[k])) <= known.count("\x00"), (t, k)
            if "\x00" not in known:
                assert got[i, j] == longest_pieces(t, train[k])


def test_undecided_and_ties():
    p = langid.Parser({"a": "xyz", "b": "xyz"})
    assert p.judge([None, "", "123 !?", "xyz", "Ж"]) == (["und", "und", "und", "a", "a"], [0.0, 0.0, 0.0, 0.5, 0.5])
    assert langid.Parser({}).judge(["text"]) == (["und"], [0.0])
    assert langid.Parser({"a": "xyz"}).judge(["xq"])[1] == [1.0]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for i in range(240):
        lang = rng.choice(sorted(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.choice((3, 40)))), lang if i % 5 else None, "s"))
    return out + [(300, None, "en", "s"), (301, "", "en", "s"), (302, "12 34", "en", "s"), (None, "the thing", "en", "s"), (1, out[1][1], out[1][2], "s"), (303, "the of " * 40_000, "en", "s")]


def test_held_out_accuracy_and_folds(make_docs, rows):
    got = langid.identify(make_docs(rows), chars=3_000).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    truth = {i: next(k for k, v in WORDS.items() if t.split()[0] in v.split()) for i, t, _, _ in rows[:240]}
    held = [i for i in truth if by_id[i].held_out]
    assert len(held) > 40 and sum(by_id[i].lang_pred == truth[i] for i in held) / len(held) > 0.95
    assert [by_id[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3 and by_id[303].lang_pred == "en"


def test_prediction_sees_only_the_text(make_docs, rows):
    texts = langid.sample_texts(make_docs(rows).filter("doc_id < 200"), chars=3_000)
    assert all(len(t) <= 3_000 for t in texts.values()) and texts == langid.sample_texts(make_docs(rows, 1).filter("doc_id < 200"), chars=3_000)
    other = [(i if i is None else i + 1000, t, "zz", "q") for i, t, _, _ in rows]
    a, b = (sorted((r.lang_pred, r.score) for r in langid.predict(make_docs(x), texts).collect()) for x in (rows, other))
    assert a == b


def test_empty(make_docs):
    assert langid.identify(make_docs([])).collect() == []
    assert [r.lang_pred for r in langid.identify(make_docs([(0, "some text", None, None)])).collect()] == ["und"]

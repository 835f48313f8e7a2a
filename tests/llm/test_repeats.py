import random
import re

import pytest

from lapdeck.llm import repeats


def plain(rows, min_words):
    """Removed spans by a scan in rank order."""
    seen, out = set(), set()
    for i, text in sorted({r for r in rows if r[1]}, key=lambda r: (r[0] is None, r[0], r[1])):
        units, cur = [], []
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            if cur and (cur[-1].group()[-1] in ".!?" or "\n" in text[cur[-1].end():m.start()]):
                units.append(cur)
                cur = []
            cur.append(m)
        units += [cur] if cur else []
        run = []
        for u in [*units, None]:
            key = u and " ".join("".join(c.lower() if c < "\x80" else c for c in m.group()) for m in u)
            if u and key in seen:
                run.append(u)
                continue
            if sum(map(len, run)) >= min_words:
                out.add((i, run[0][0].start(), run[-1][-1].end(), sum(map(len, run))))
            run = []
            seen.add(key)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    words = [f"w{i}é" if i % 9 == 0 else f"W{i}" for i in range(80)]
    shared = [" ".join(rng.choices(words, k=rng.randint(2, 9))) + rng.choice(".!?") for _ in range(30)]
    out = []
    for i in range(150):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choices(words, k=5)) + "." for _ in range(rng.randint(1, 12))]
        out.append((i, "".join(p + rng.choice((" ", "\n", "\t \n")) for p in parts)))
    passage = " ".join(f"p{i}" + ("." if i % 11 == 10 else "") for i in range(66))
    out += [(200, "before it " + passage + " after"), (201, "Other words\n" + passage.upper() + " and more."), (202, None), (203, ""), (204, " \n")]
    return out + [(205, "same line here\n" * 500), (206, "x" * 100_000 + " y"), (207, "x" * 100_000 + " y")]


@pytest.mark.parametrize("min_words", [1, 8, 25])
def test_equals_a_plain_scan(make_docs, rows, min_words):
    got = repeats.repeated_spans(make_docs(rows), min_words=min_words).collect()
    assert {(r.doc_id, r.start, r.end, r.n_words) for r in got} == plain(rows, min_words) and len(got) == len(plain(rows, min_words))
    assert all(k <= r.doc_id for r in got for k in r.kept_ids)


def test_passage_inside_lines_is_found(make_docs, rows):
    spans = [r for r in repeats.repeated_spans(make_docs(rows)).collect() if r.doc_id == 201]
    assert len(spans) == 1 and spans[0].n_words >= 50 and spans[0].kept_ids == [200]


def test_repeated_rows_and_null_ids(make_docs):
    text = "one two three four five. six seven eight nine ten."
    rows = [(4, text), (4, text), (None, text), (None, "other words that are alone."), (9, text + " more of it.")]
    got = sorted((r.doc_id or -1, r.start, r.end, r.kept_ids) for r in repeats.repeated_spans(make_docs(rows), min_words=2).collect())
    assert got == [(-1, 0, len(text), [4]), (9, 0, len(text), [4])]


def test_texts_without_repeats(make_docs, rows):
    docs = make_docs([r for r in rows if r[0] != 205])
    out = repeats.without_repeats(docs, min_words=8).collect()
    before = {i: t for i, t in rows}
    assert len(out) == docs.count()
    spans = plain([r for r in rows if r[0] != 205], 8)
    for r in out:
        text = before[r.doc_id]
        assert sorted((s.start, s.end) for s in r.removed) == sorted((a, b) for i, a, b, _ in spans if i == r.doc_id)
        for s in sorted(r.removed, reverse=True):
            text = text[:s.start] + text[s.end:]
        assert r.text == text


def test_empty(make_docs):
    assert repeats.repeated_spans(make_docs([])).collect() == []
    assert repeats.repeated_spans(make_docs([(1, None), (2, " ")])).collect() == []

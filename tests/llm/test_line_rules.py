import random
import re
from collections import Counter, defaultdict

import pytest

from lapdeck.llm import line_rules
from lapdeck.llm.line_rules import Limits

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LIMITS = Limits(min_words=8, min_docs=4, max_share=0.05, min_left=3)


def lines_of(text):
    out = []
    for line in (text or "").split("\n"):
        words = WORD.findall(line)
        if words:
            norm = " ".join(words).translate({c: c + 32 for c in range(65, 91)})
            out.append((line, re.sub("[0-9]", "0", norm), len(words)))
    return out


def brute(docs, limits):
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed, kept, text without common lines)"""
    texts, hosts = defaultdict(set), defaultdict(set)
    for _, text, _, host in docs:
        hosts[host].add(text)
        for _, norm, _ in lines_of(text):
            texts[host, norm].add(text)
    out = []
    for i, text, _, host in docs:
        words = WORD.findall(text or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        hit = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
        seen, dup, lost = set(), 0, 0
        for line, norm, n in lines_of(text):
            dup += line in seen
            seen.add(line)
            bad = len(texts[host, norm]) >= limits.min_docs and len(texts[host, norm]) > limits.max_share * len(hosts[host])
            lost += n * bad
        n = len(words)
        failed = n < limits.min_words or len(hit) > limits.max_repeat * n
        kept = not failed and n - lost >= limits.min_left and n - lost >= limits.min_left_share * n
        out.append((i, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit), lost, failed, kept))
    return out


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(5)
    vocab = ["ab", "Ça", "x1", "x2", "né", "dos|", "<b>", "#", "tre", "Ω", "\U0001d54f"]
    common = ["Read more 2024", "All rights reserved", "subscribe now and here"]
    out = []
    for i in range(240):
        lines = [" ".join(rng.choice(vocab) for _ in range(rng.choice((1, 3, 9, 20)))) for _ in range(rng.choice((1, 2, 5)))]
        if i % 3 == 0:
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(common).replace("2024", str(2000 + i)))
        if i % 11 == 0:
            lines += [lines[0], " ", "", lines[0] + "\t"]
        if i % 17 == 0:
            lines = [rng.choice(common) + " " * (i % 5) for _ in range(4)]
        out.append((i, "\n".join(lines), "en", (None, "h1", "h1", "h2")[i % 4]))
    big = " ".join(f"w{k}" for k in range(60_000))
    return out + [(500, None, None, "h1"), (501, "", None, "h1"), (502, " \n\t", None, None), (503, big + "\nAll rights reserved", None, "h1"),
                  (1, out[1][1], "en", "h1"), (None, out[1][1], "en", "h1"), (504, "All  RIGHTS\treserved\r\n" + "a b c d e f g h i j", None, "h1")]


def test_against_the_definition(make_docs, docs):
    got = line_rules.judge(make_docs(docs, 7), limits=LIMITS).collect()
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept")
    key = lambda r: (r[0] is None, r)
    want = brute(docs, LIMITS)
    assert sorted([tuple(r[c] for c in cols) for r in got], key=key) == sorted(want, key=key)
    assert any(w[6] for w in want) and any(not w[7] and not w[8] for w in want) and any(w[5] for w in want) and any(w[4] for w in want)


def test_cleaned_texts(make_docs, docs):
    got = line_rules.cleaned(make_docs(docs), limits=LIMITS)
    assert got.columns == make_docs([]).columns
    kept = Counter(w[0] for w in brute(docs, LIMITS) if w[8])
    rows = got.collect()
    assert Counter(r.doc_id for r in rows) == kept
    texts, hosts = defaultdict(set), defaultdict(set)
    for _, text, _, host in docs:
        hosts[host].add(text)
        for _, norm, _ in lines_of(text):
            texts[host, norm].add(text)
    text_of = {d[0]: d[1] for d in docs}
    for r in rows:
        bad = {x for x, n, _ in lines_of(text_of[r.doc_id]) if len(texts[r.source, n]) >= 4 and len(texts[r.source, n]) > 0.05 * len(hosts[r.source])}
        assert r.text == "\n".join(x for x in text_of[r.doc_id].split("\n") if x not in bad) and r.size == "clash"


def test_copies_of_one_text_are_one_document(make_docs):
    text = "one line of words that is taken again and again\nand a second line of other words too"
    docs = [(i, text, "en", "h") for i in range(60)] + [(100 + i, f"text {'x' * i} of its own with enough words for all the rules", "en", "h") for i in range(9)]
    got = line_rules.judge(make_docs(docs, 6), limits=LIMITS).collect()
    assert len(got) == 69 and all(r.kept and r.removed_words == 0 for r in got)


def test_empty(make_docs):
    assert line_rules.judge(make_docs([])).collect() == []
    assert line_rules.cleaned(make_docs([])).collect() == []
    (r,) = line_rules.judge(make_docs([(1, None)])).collect()
    assert (r.n_words, r.word_chars, r.base_failed, r.kept) == (0, 0, True, False)

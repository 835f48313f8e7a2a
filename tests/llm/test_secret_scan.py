import random
import re

import pytest

from lapdeck.llm import secret_scan


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeilmnorstu") for _ in range(rng.randint(3, 8))) for _ in range(120)]
    hexs = "0123456789abcdef"
    out, truth = [], set()

    def put(i, value, before, after, secret):
        text = " ".join(rng.choices(vocab, k=12)) + " " + before
        if secret:
            truth.add((i, len(text), len(text) + len(value)))
        out.append((i, text + value + after + " " + " ".join(rng.choices(vocab, k=6)), "en", f"src{i % 3}/docs/a"))

    for i in range(240):
        kind = i % 6
        if kind == 0:
            put(i, "AKIA" + "".join(rng.choices("ABCDEFGHJKLMNPQRSTUVWXYZ234567", k=16)), "", "", True)
        elif kind == 1:
            put(i, "".join(rng.choices(hexs, k=17)) + "7", "password=", "", True)
        elif kind == 2:
            put(i, "".join(rng.choices(hexs, k=39)) + "7", 'token = "', '"', True)
        elif kind == 3:
            put(i, ".".join(str(rng.randint(100, 255)) for _ in range(4)), "", ",", False)
        elif kind == 4:
            put(i, "4" + "".join(rng.choices("0123456789", k=15)), "", "", False)
        else:
            put(i, f"{rng.choice(vocab)}{rng.randint(1, 99)}.{rng.choice(vocab)}.example.com", "user@", "", False)
    return out, truth


def test_candidates_have_exact_offsets(make_docs, rows):
    docs, _ = rows
    text = {r[0]: r[1] for r in docs}
    got = secret_scan.candidates(make_docs(docs), {"the": 3}).collect()
    assert len(got) >= 200
    for r in got:
        assert text[r.id][r.start:r.end] == r.value and len(r.features) == len(secret_scan.FEATURES)


def test_held_out_findings(make_docs, rows):
    docs, truth = rows
    found = make_docs(docs)
    # labels by rule for documents under 120 alone; the rest is held out
    from pyspark.sql import functions as F
    label = F.when(F.col("id") < 120, secret_scan.rule_labels(F.col("value"), F.col("before")))
    got = [r for r in secret_scan.scan(found, label=label, trees=15).collect() if r.doc_id >= 120]
    held = {t for t in truth if t[0] >= 120}
    said = {(r.doc_id, r.start, r.end) for r in got if r.is_secret}
    assert len(held & said) >= 0.95 * len(held) and len(said - held) <= 0.05 * len(got)


def test_redaction_masks_secrets_and_nothing_else(make_docs, rows):
    docs, truth = rows
    out = {r.doc_id: r for r in secret_scan.redact(make_docs(docs), trees=10).collect()}
    assert len(out) == len(docs)
    for i, text, _, _ in docs:
        want = text
        for j, a, b in truth:
            if j == i:
                want = text[:a] + "[SECRET]" + text[b:]
        assert out[i].text == want


def test_edges(make_docs, rows):
    docs, _ = rows
    edge = [(900, None), (901, ""), (902, "a1" * 100_000), (None, docs[0][1], None, None), (0, *docs[0][1:])]
    got = secret_scan.scan(make_docs([*docs, *edge]), trees=5).collect()
    assert not [r for r in got if r.doc_id in (900, 901)]
    assert [(r.start, r.end) for r in got if r.doc_id == 902] == [(0, 200_000)]
    assert len({(r.digest, r.score) for r in got if r.doc_id == 0}) == 1 and sum(r.doc_id == 0 for r in got) == 2
    assert sum(r.doc_id is None for r in got) == 1


def test_without_labels_and_empty(make_docs):
    assert secret_scan.scan(make_docs([])).collect() == []
    got = secret_scan.scan(make_docs([(1, "odd zq9-zz_81_k2x9 here")])).collect()
    assert [(r.score, r.is_secret) for r in got] == [(1.0, True)]


def test_published_formats():
    assert re.fullmatch(secret_scan.KNOWN_SECRET.split("|^")[0], "AKIA" + "A1B2" * 4)


#: What candidates by length and digits alone leave out: (before, value, after).
OTHERS = [('password = "', "correct-horse-battery", '"'), ('pwd="', "P@ssw0rd!2024", '"'), ("token=", "x9Fk2Lq8", ""),
          ('api_key = "', "AbCdEfGhIjKlMnOpQrStUvWx", '"'), ("postgres://user:", "s3cr3tpw", "@db/x"), ("(", "AbCdEfGhIjKlMnOpQrStUvWx", ")"),
          ("see https://h/?token=", "a$b,c", "&user=bob"), ("{'secret': '", "it\\'s, a phrase; of words", "'}"), ("ftp://me:", "p/ss", "@host"), ("ftp://me:", "p@ss", "@host/w"),
          ("(pwd := ", "Pa)(s", ")."), ("auth=", "é!", ", and")]


@pytest.mark.parametrize(("before", "value", "after"), OTHERS)
def test_other_values_are_candidates(before, value, after):
    text = f"some words {before}{value}{after} more words"
    at = len("some words ") + len(before)
    assert (at, at + len(value)) in secret_scan.spans(text)


def test_ports_and_words_are_no_user_info():
    assert secret_scan.spans("see http://host:8080/a@b or this ratio: plain words, tokens are many") == []


def test_long_texts_stay_linear():
    for unit in ("token=", 'token="', "x://a:", "aB", "token   ", "pwd=(", "a,b="):
        secret_scan.spans(unit * 40_000)
    assert secret_scan.spans("pwd=" + ")" * 400_000) == [(4, 5)]


def test_named_values_and_url_passwords_are_masked(make_docs, rows):
    rng = random.Random(6)
    docs, _ = rows
    chars = "abcdefghijkABCDEFGHIJK0123456789@!$%-"
    extra, want = [], {}
    for i in range(200):
        value = "x" + "".join(rng.choices(chars, k=rng.randint(7, 20)))
        before, after = (('pwd="', '"'), ("token=", ""), ("postgres://user:", "@db/x"), ('password = "', '"'))[i % 4]
        extra.append((1000 + i, f"some words {before}{value}{after} more words", "en", "src/docs/a"))
        want[1000 + i] = f"some words {before}[SECRET]{after} more words"
    for k, (before, value, after) in enumerate(OTHERS[:5]):
        extra.append((2000 + k, f"some words {before}{value}{after} more words", "en", "src/docs/a"))
        want[2000 + k] = f"some words {before}[SECRET]{after} more words"
    out = {r.doc_id: r.text for r in secret_scan.redact(make_docs([*docs, *extra]), trees=15).collect()}
    assert {i: out[i] for i in want} == want

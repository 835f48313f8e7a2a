import hashlib
import os
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lapdeck.llm import alignment

pytestmark = pytest.mark.skipif(not os.path.isdir(alignment.TOKENIZERS), reason="no tokenizer files")
A, B = Path(alignment.TOKENIZERS, "byte_bpe_50k.json"), Path(alignment.TOKENIZERS, "piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(str(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=str(B))


def decoded(entry):
    from tokenizers.decoders import ByteLevel

    return ByteLevel().decode([entry])


def plain(text, libraries):
    """(ids of A, ids of B, groups) token by token, or None."""
    a, b = libraries
    if not text:
        return None
    ids = a.encode(" " + text, add_special_tokens=False).ids
    other = b.encode(text)
    alphabet = alignment.byte_alphabet()
    bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids]
    bytes_b = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in other]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    groups, i, j, x, y, end_a, end_b = [], 0, 0, [], [], 0, 0
    while i < len(ids) or j < len(other):
        if end_a <= end_b and i < len(ids):
            end_a += len(bytes_a[i])
            x.append(ids[i])
            i += 1
        else:
            end_b += len(bytes_b[j])
            y.append(other[j])
            j += 1
        if end_a == end_b and x and y:
            groups.append((x, y))
            x, y = [], []
    return ids, other, groups


def brute(docs, libraries):
    found = [(i, plain(t, libraries)) for i, t, *_ in docs]
    count = Counter((g[0][-1], g[1][-1]) for _, f in found if f for g in f[2])
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    out = []
    for i, f in found:
        if not f:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(g[0][-1], g[1][-1]) for g in f[2]]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in f[2])
        out.append((i, len(f[0]), len(f[1]), len(f[2]), len(links), sum(count[k] == best[k[1]] for k in links),
                    sum(count[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(2)
    bits = ["the", "Über", "naïve", "tion", "ing", "  ", "\n", "\t", "12345", "!?", "…", "日本語", "\U0001f600", "é", "▁", "<|endoftext|>",
            "<s>", "<0x41>", "un", "believ", "able", "’s", "'s", " ", "　", "ﬁ", "\r\n", "\x00", "ß"]
    out = [(i, "".join(rng.choice(bits[:14] if i % 3 else bits) + rng.choice(["", " ", " "]) for _ in range(rng.choice((1, 5, 40))))) for i in range(200)]
    return out + [(900, None), (901, ""), (902, " "), (903, "\n\n"), (904, "a" * 5_000 + " " + "the end " * 20_000), (0, out[0][1]), (None, out[1][1]),
                  (905, " two  spaces "), (906, "<|endoftext|> is plain"), (907, "▁ mark")]


@pytest.mark.parametrize("room", [alignment.WINDOWS, 3])
def test_against_the_definition(make_docs, docs, libraries, room):
    got = alignment.token_alignment(make_docs(docs, 4), room=room).collect()
    key = lambda r: (r[0] is None, r)
    want = brute(docs, libraries)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in want) > 100 and any(r[1] == 0 and t for r, (_, t, *_) in zip(want, docs, strict=True))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'sd.,ab1éß日́▁ ​\u0085"), st.characters(blacklist_categories=["Cs"])), max_size=60))
def test_same_ids_as_the_tokenizers_library(text):
    a, own = _both()
    assert own.encode([text])[0].tolist() == a.encode(text, add_special_tokens=False).ids


def _both(_cache=[]):  # noqa: B006
    if not _cache:
        from tokenizers import Tokenizer

        a = Tokenizer.from_file(str(A))
        a.encode_special_tokens = True
        _cache.append((a, alignment.ByteLevel(A.read_text(encoding="utf-8"))))
    return _cache[0]


def test_bytes_of_entries():
    a, own = _both()
    assert all(own.bytes[i].decode(errors="replace") == decoded(a.id_to_token(i)) for i in range(0, len(own.bytes) - 1, 7))


def test_empty(make_docs):
    assert alignment.token_alignment(make_docs([])).collect() == []
    (r,) = alignment.token_alignment(make_docs([(1, None)])).collect()
    assert tuple(r) == (1, 0, 0, 0, 0, 0, 0, "")

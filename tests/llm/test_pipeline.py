import random

import pandas as pd
import pytest

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(21)
    stop = ["the", "of", "and", "to", "in", "a", "is"]
    vocab = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(4, 9))) for _ in range(700)]

    def prose(n):
        words = [rng.choice(stop) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]
        return ". ".join(" ".join(words[a:a + 11]).capitalize() for a in range(0, n, 11)) + "."

    items = [(k, prose(40)) for k in range(6)]
    docs, kind = [], {}
    for i in range(300):
        text, what = prose(rng.choice((60, 150, 260))), "clean"
        if i % 10 == 1:
            what, text = "junk", [text.upper().replace(" ", "!! "), text.replace(" ", "### ")][i // 10 % 2]
        elif i % 10 == 2:
            what, text = "copy", docs[i - 2][1]
        elif i % 10 == 3:
            what, text = "near", docs[i - 3][1].replace(" the ", " these ", 1)
        elif i % 10 == 4:
            what, text = "leak", text + " " + items[i // 10 % 6][1]
        elif i % 10 == 5:
            what, text = "secret", text + " password=" + "".join(rng.choices("0123456789abcdef", k=17)) + "7 and so on."
        elif i % 10 == 6:
            text += " Call 10.20.30.40.50 or 4929123412341234."
        docs.append((i, text, "en", f"s{rng.choice((0, 0, 1, 2, 3))}", len(text)))
        kind[i] = what
    docs += [(900, None, None, None, 0), (901, "", "en", "s1", 0)]
    path = tmp_path_factory.mktemp("tables")
    pd.DataFrame(docs, columns=COLUMNS).to_parquet(path / "documents.parquet")
    pd.DataFrame(items, columns=["item_id", "text"]).to_parquet(path / "benchmark.parquet")
    return str(path), docs, kind


def test_stages_in_a_row(spark, folder, tmp_path):
    path, docs, kind = folder
    text = {d[0]: d[1] for d in docs}
    rows, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, rows, path).write.parquet(out)
        rows = spark.read.parquet(out)
        seen[name] = {r.doc_id: r for r in rows.collect()}
        assert (name == "mixing") or rows.columns == COLUMNS, name
    clean = {i for i, k in kind.items() if k == "clean"}
    kept = set(seen["quality"])
    assert not kept & {i for i, k in kind.items() if k == "junk"} and not kept & {900, 901}
    assert len(clean & kept) >= 0.98 * len(clean)
    firsts = set(seen["near_duplicates"])
    assert not firsts & {i for i, k in kind.items() if k in ("copy", "near")} and kept & clean <= firsts
    assert {i for i in firsts if kind[i] == "leak"} == firsts - set(seen["decontamination"])
    for i, r in seen["secrets"].items():
        assert ("[SECRET]" in r.text) == (kind[i] == "secret") and r.n_chars == len(r.text)
        assert kind[i] == "secret" or r.text == text[i]
    mix = seen["mixing"]
    assert set(mix) <= set(seen["secrets"]) and all(1 <= r.copies <= 3 and r.taken == r["size"] * r.copies for r in mix.values())
    total = sum(len(r.text.split()) for r in seen["secrets"].values())
    assert 0.9 * total < sum(r.taken for r in mix.values()) <= total


def test_run_and_names(spark, folder):
    import __spark_entry__
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "mixing"]
    out = corpus_pipeline.run(spark, folder[0])
    assert set(COLUMNS) <= set(out.columns) and out.count() > 100

import math
from collections import Counter

import pytest

from lapdeck.llm import urls

CASES = [
    ("http://a.example.com/en/x?q=1#f", "a.example.com", "/en/x", "example.com/en/", "block"),
    ("https://WWW.Example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://x.www.example.com/en/y", "x.www.example.com", "/en/y", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://b.net/es/1", "b.net", "/es/1", "net/es/", "block"), ("http://b.net/fr/", "b.net", "/fr/", "net/fr/", "block"),
    ("http://b.net/de/", "b.net", "/de/", None, None), ("http://b.com", "b.com", "", None, None), ("http://com/", "com", "/", "com/", "allow"),
    ("http://b.com?x=/en/", "b.com", "", None, None), ("no scheme", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
    ("x://y://z/", "y:", "//z/", None, None), ("http://Ä.com/É", "Ä.com", "/É", "com/", "allow"), ("http://a\nb.net/es/\n", "a\nb.net", "/es/\n", "net/es/", "block")]


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, u, "clash") for i, (u, *_) in enumerate(CASES)] + [(None, "http://b.net/es/1", "c"), (0, CASES[0][0], "c"), (99, "http://b.net/" + "a1/" * 100_000, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, label string").repartition(3)
    return urls.filter_urls(pages, trees=3).collect()


def test_hosts_paths_and_rules(judged):
    assert len(judged) == len(CASES) + 3
    by_id = {r.page_id: r for r in judged if r.page_id is not None}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        r = by_id[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), CASES[i]
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert len({(r.rule, r.verdict) for r in judged if r.page_id == 0}) == 1


def test_entropy_and_counts(spark):
    text = ["http://a.b/c/d-1?x=1&y=22&&z#t", "aaaa", "", "http://x.y/" + "%20" * 3]
    pages = spark.createDataFrame(list(enumerate(text)), "page_id long, url string")
    rows = {r.id: r for r in urls.lexical_features(pages).collect()}
    for i, u in enumerate(text):
        n = Counter(u)
        want = -sum(c / len(u) * math.log2(c / len(u)) for c in n.values()) if u else 0.0
        assert abs(rows[i].entropy - want) < 1e-9 and rows[i].url_length == len(u)
    assert (rows[0].parameters, rows[0].depth, rows[0].has_fragment, rows[0].longest_digits, rows[3].percents) == (3, 2, 1, 2, 3)


def test_trees_learn_labelled_urls(spark):
    rows = [(i, f"http://h{i % 50}.org/{'a/' * (i % 4)}{'x' * (i % 9)}{'?p=1&q=2' if i % 2 else ''}") for i in range(400)]
    feats = urls.lexical_features(spark.createDataFrame(rows, "page_id long, url string"))
    feats = urls.with_suffix_statistics(feats.selectExpr("*", "if(id % 4 < 3, cast(parameters > 0 as double), null) as label"))
    model = urls.train(feats, trees=5)
    held = model.transform(urls._vectors(feats)).filter("label is null")
    assert held.filter("(prediction = 1) <> (parameters > 0)").count() == 0


def test_without_labels_and_empty(spark):
    one = spark.createDataFrame([(1, "http://b.org/")], "page_id long, url string")
    assert [(r.verdict, r.block_score) for r in urls.filter_urls(one).collect()] == [("allow", 0.0)]
    assert urls.filter_urls(one.limit(0)).collect() == []

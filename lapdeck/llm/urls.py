"""URL filter: rules first, then gradient-boosted trees on lexical features of the url.

Everything here is DataFrame / SQL expressions and Spark's own ML trees; no Python runs on rows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapdeck.llm.common import ascii_lower, materialise, smallest_hashes

# (verdict, host, path), as given for the production filter.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

FEATURES = ("url_length", "host_length", "host_labels", "depth", "path_length", "query_length", "parameters", "digit_ratio",
            "upper_ratio", "symbol_ratio", "hyphens", "percents", "longest_digits", "entropy", "has_port", "is_https",
            "has_extension", "has_fragment", "suffix_seen", "suffix_block", "domain_seen", "domain_block")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + F.lit(3), F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*+([^?#]*+)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def match_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a parent domain and the path's start; nulls if none.

    ``rules`` is a short list; the longest text is tried first (of equal lengths, the longer host).
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters in bits: run lengths of the sorted characters, so long texts stay O(n log n)."""
    chars = F.array_sort(F.split(text, ""))
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("run"), F.lit(0.0).alias("acc"))

    def plogp(n: Column) -> Column:
        return F.when(n > 0, n * F.log2(n)).otherwise(0.0)

    total = F.aggregate(
        chars, start,
        lambda s, c: F.struct(c.alias("c"), F.when(s["c"] == c, s["run"] + 1.0).otherwise(1.0).alias("run"),
                              F.when(s["c"] == c, s["acc"]).otherwise(s["acc"] + plogp(s["run"])).alias("acc")),
        lambda s: s["acc"] + plogp(s["run"]))
    n = F.length(text)
    return F.when(n > 0, F.log2(n.cast("double")) - total / n).otherwise(0.0)


def _share(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)) / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))


def lexical_features(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, suffix, domain and the features that the url alone gives.  A null url counts as empty."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = host_and_path(F.col(url_col))
    d = pages.select(F.col(id_col).alias("id"), url.alias("u"), host.alias("host"), path.alias("path"))
    query = F.regexp_extract("u", r"^[^?#]*+\?([^#]*+)", 1)
    d = d.withColumns({
        "query": query, "suffix": F.element_at(F.split("host", r"\."), -1),
        "domain": F.array_join(F.slice(F.reverse(F.split("host", r"\.")), 1, 2), ".")})
    h, p, u = F.col("host"), F.col("path"), F.col("u")
    digits = F.regexp_extract_all(u, F.lit(r"[0-9]++"), 0)
    out = {
        "url_length": F.length(u), "host_length": F.length(h), "host_labels": F.size(F.split(h, r"\.")),
        "depth": F.regexp_count(p, F.lit(r"/[^/]")), "path_length": F.length(p), "query_length": F.length("query"),
        "parameters": F.regexp_count("query", F.lit(r"[^&;]++")), "digit_ratio": _share(u, "[0-9]"),
        "upper_ratio": _share(u, "[A-Z]"), "symbol_ratio": _share(u, "[^A-Za-z0-9/.:]"),
        "hyphens": F.regexp_count(u, F.lit("-")), "percents": F.regexp_count(u, F.lit("%")),
        "longest_digits": F.coalesce(F.array_max(F.transform(digits, F.length)), F.lit(0)), "entropy": _entropy(u),
        "has_port": h.rlike(r":[0-9]+$").cast("int"), "is_https": u.startswith("https://").cast("int"),
        "has_extension": p.rlike(r"\.[A-Za-z0-9]{1,5}$").cast("int"), "has_fragment": u.contains("#").cast("int")}
    return d.select("id", "host", "path", "suffix", "domain", *[c.cast("double").alias(k) for k, c in out.items()])


def _group_rate(rows: DataFrame, key: str) -> DataFrame:
    """Per value of ``key``: how many urls have it (log) and the smoothed share of blocked among its labelled urls."""
    blocked = F.sum(F.coalesce(F.col("label"), F.lit(0.0)))
    known = F.count("label")
    return rows.groupBy(key).agg(F.log1p(F.count("*")).alias(f"{key}_seen"), ((blocked + 1.0) / (known + 2.0)).alias(f"{key}_block"))


def with_suffix_statistics(rows: DataFrame) -> DataFrame:
    """Add the statistics of each url's suffix and registered domain, counted over all rows.

    ``rows`` has a ``label`` (1 block, 0 allow, null unknown).  The statistics are written out first, so the joins
    are between plain scans and AQE broadcasts a small side or splits a hot suffix.
    """
    for key in ("suffix", "domain"):
        rows = rows.join(materialise(_group_rate(rows, key), f"url-{key}"), key, "left")
    return rows


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def train(rows: DataFrame, sample_rows: int = 10_000, trees: int = 20, depth: int = 4, seed: int = 7) -> GBTClassificationModel | float:
    """Fit the trees on at most ``sample_rows`` labelled urls of either class (those of smallest url hash).

    Without labels of both classes it returns the constant share of blocked labels (0 without any).
    """
    cols = ["label", *FEATURES]
    labelled = rows.filter("label is not null")
    at = F.xxhash64(F.lit(seed), "host", "path", "id")
    each = [smallest_hashes(labelled.filter(F.col("label") == v), at, sample_rows, "host", "path").select(*cols) for v in (0.0, 1.0)]
    sample = materialise(each[0].unionByName(each[1]).coalesce(1), "url-sample")
    classes = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(classes) < 2:
        return max(classes, default=0.0)
    return GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed).fit(_vectors(sample))


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, threshold: float = 0.5, **fit) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, block_score.

    The urls that a rule covers are the labelled urls the trees learn from; the verdict of a covered url is its rule's,
    that of any other is ``block`` when the trees' probability exceeds ``threshold``.  Null urls and urls without
    ``://`` have empty host and path and are judged by the trees.  Repeated rows are judged alike; an empty
    table gives no rows; other columns are ignored.
    """
    rule, said = match_rules(F.col("host"), F.col("path"), rules)
    rows = lexical_features(pages, id_col, url_col).withColumns({"rule": rule, "said": said})
    rows = rows.withColumn("label", F.when(F.col("said") == "block", 1.0).when(F.col("said") == "allow", 0.0))
    rows = with_suffix_statistics(materialise(rows, "url-features"))
    model = train(rows, **fit)
    if isinstance(model, float):
        scored = rows.withColumn("block_score", F.lit(model))
    else:
        scored = model.transform(_vectors(rows)).withColumn("block_score", vector_to_array("probability")[1])
    method = F.when(F.col("block_score") > threshold, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("said", method).alias("verdict"), "block_score")

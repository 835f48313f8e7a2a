"""One query per operator of this subpackage, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapdeck.llm import alignment, hamming, langid, leaks, line_rules, mixing, near, quality, repeats, secret_scan, urls, variants, warc
from lapdeck.plans.registry import table
from lapdeck.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes, sha1(body) AS h,
             min(page_id) OVER (PARTITION BY body) AS first_id,
             row_number() OVER (PARTITION BY body ORDER BY page_id) AS k FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN first_id END AS refers_to
FROM d
""")
def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    done = warc.archive(pages, scratch_path(spark, "warc"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query()
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


@query("""
WITH e AS (SELECT vec_id, embedding FROM embeddings WHERE embedding IS NOT NULL),
d AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id,
             list_sum(list_transform(list_zip(q.embedding, r.embedding), lambda p: ((p[1] >= 0) <> (p[2] >= 0))::INT))::INT AS distance
      FROM e q, e r WHERE q.vec_id % 100 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank FROM d)
SELECT query_id, neighbor_id, distance, rank FROM k WHERE rank <= 10
""")
def op6_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    codes = e.select(F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code"))
    return hamming.search(codes.filter(F.col("id") % 100 == 0), codes, k=10)


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query()
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeats.repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "start", "end", "n_words", "kept_ids")


@query()
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("row")


@query()
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query()
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("row")


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(table(spark, sf_dir, "documents"))


@query(r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, 3)) AS j) GROUP BY rid),
l AS (SELECT rid, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
v AS (SELECT *, trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+', ' ', 'g'), '[0-9]', '0', 'g')) AS norm, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS k
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT rid, sum(n - 1) AS n FROM (SELECT rid, line, count(*) AS n FROM v GROUP BY rid, line) GROUP BY rid),
hosts AS (SELECT source, count(DISTINCT text) + max((text IS NULL)::INT) AS n FROM documents GROUP BY source),
common AS (SELECT c.source, norm FROM (SELECT source, norm, count(DISTINCT text) AS n FROM v GROUP BY source, norm) c
           JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source WHERE c.n >= 10 AND c.n > 0.05 * h.n),
lost AS (SELECT rid, sum(k) AS n FROM v JOIN common c ON v.source IS NOT DISTINCT FROM c.source AND v.norm = c.norm GROUP BY rid),
f AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost.n, 0)::BIGINT AS removed_words
      FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_words - removed_words AS rest FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words,
       NOT base_failed AND rest >= 20 AND 2 * rest >= n_words AS kept FROM b
""")
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(table(spark, sf_dir, "documents")).drop("removed_lines")


@query("""
WITH RECURSIVE d AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc,
      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
t AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS step),
r AS MATERIALIZED (SELECT doc, run, count(*) AS k FROM d WHERE length(run) >= 5 GROUP BY doc, run),
b AS (SELECT run, k, list_transform(range(octet_length(encode(doc || ':' || run))),
             lambda i: ('0x' || substr(hex(encode(doc || ':' || run)), 1 + 2 * i::INT, 2))::BIGINT) AS bytes FROM r),
h AS (SELECT run, k, xor(list_reduce(list_concat([4294967295], bytes), lambda c, x: xor(c >> 8, step[1 + (xor(c, x) & 255)])), 4294967295) AS h FROM b, t),
m AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, k FROM h),
w AS MATERIALIZED (SELECT word, sum(k)::BIGINT AS n FROM m WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
g AS (SELECT word, n, length(word) AS size, unnest(range(1, length(word) + 1)) AS i FROM w),
p AS MATERIALIZED (SELECT word, n, i, size, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM g),
one AS (SELECT x.word, y.word AS other, y.n AS other_n FROM p x JOIN p y ON x.i = y.i AND x.size = y.size AND x.a = y.a AND x.z = y.z AND x.word <> y.word),
cut AS (SELECT DISTINCT p.word AS long, p.n AS long_n, w.word AS short, w.n AS short_n FROM p JOIN w ON w.word = p.a || p.z),
near AS (SELECT * FROM one UNION ALL SELECT long, short, short_n FROM cut UNION ALL SELECT short, long, long_n FROM cut),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 2 * w.n THEN most END AS form_n,
      CASE WHEN most >= 2 * w.n THEN (SELECT min(o.other) FROM near o WHERE o.word = w.word AND o.other_n = best.most) END AS form FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS here, form AS next, 0 AS k FROM f
          UNION ALL SELECT chain.word, f.word, f.form, k + 1 FROM chain JOIN f ON f.word = chain.next),
root AS (SELECT word, arg_max(here, k) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN root USING (word)
""")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))

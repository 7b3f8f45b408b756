"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprint_index, language_id, licenses, mixing, near_dedup, order_minhash, suffix_dedup, url_filter, warc
from .common import table

def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_bundles(stored).drop("url")


OP1_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
  CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (h)
"""


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.scan(docs, table(spark, sf_dir, "benchmark")))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS m, w, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, m, array_to_string(w[i + 1 : i + m], ' ') AS s FROM bw),
ms AS (SELECT DISTINCT m FROM pat),
dw AS (SELECT doc_id, m, unnest(range(0, len(w) - m + 1)) AS i, w FROM d, ms WHERE len(w) >= m),
win AS (SELECT doc_id, m, i, array_to_string(w[i + 1 : i + m], ' ') AS s FROM dw),
hit AS (SELECT doc_id, i, win.m, item_id FROM win JOIN pat ON win.m = pat.m AND win.s = pat.s),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM (SELECT DISTINCT doc_id, i, m FROM hit)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op3_url_filter SQL can say: host, path, rule, and the verdict where a rule gives it."""
    judged = op3_url_filter(spark, sf_dir)
    return judged.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled"))


RULES_SQL = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
r(what, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT page_id, host, path, arg_max(h || r.p, length(h || r.p)) AS rule, arg_max(what, length(h || r.p)) AS ruled
FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p) GROUP BY ALL
"""


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")).drop("source")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.identify(docs)
    return found.select("doc_id", "held_out", "lang_pred", "score", "known", F.array_join("langs", ",").alias("langs"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Windows are compared as hexadecimal text, cut from pages of 1024 starts; a place is (doc_id, start) in one number.
OP8_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
pages AS (SELECT doc_id, k, substr(h, 2048 * k + 1, 2246) AS p, least(1024, n - 99 - 1024 * k) AS m FROM (SELECT doc_id, h, n, unnest(range(0, (n + 924) // 1024)) AS k FROM d WHERE n >= 100)),
win AS (SELECT doc_id, 1024 * k + j AS i, substr(p, 2 * j + 1, 200) AS s FROM (SELECT doc_id, k, p, unnest(range(0, m)) AS j FROM pages)),
firsts AS (SELECT s, min(doc_id::HUGEINT * 4294967296 + i) AS place FROM win GROUP BY s),
hit AS (SELECT doc_id, i FROM win JOIN firsts USING (s) WHERE place < doc_id::HUGEINT * 4294967296 + i),
marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 100, true)::INT AS fresh FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY ALL),
pieces AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM runs
  UNION ALL SELECT d.doc_id, n, coalesce(max(b), 0) FROM d LEFT JOIN runs r ON r.doc_id = d.doc_id GROUP BY ALL
),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY since) AS h FROM pieces JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN sums USING (doc_id)
"""


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_index.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 50], ' ') AS s FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
firsts AS (SELECT s, min(doc_id) AS first_id FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN firsts USING (s) WHERE first_id < doc_id),
kept AS (
  SELECT x.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS body
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS j FROM d) x ANTI JOIN gone USING (doc_id, j) GROUP BY x.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, per_cent=80)


OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_have AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM both_have JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
ends AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS id, doc_id AS c FROM d UNION SELECT b, c FROM reach JOIN ends ON a = id WHERE b > c)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id AS doc_id, min(c) AS component_id FROM reach GROUP BY id) USING (doc_id)
"""


def queries() -> dict:
    found = (op1_warc, url_rules, op2_decontaminate, op3_url_filter, op4_mixing, op5_language_id, op6_order_minhash, op7_licenses, op8_suffix_dedup, op9_substring_dedup, op10_near_dedup)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": OP1_SQL, "op2_decontaminate": OP2_SQL, "url_rules": RULES_SQL, "op7_licenses": licenses.sql(), "op4_mixing": mixing.SQL, "op8_suffix_dedup": OP8_SQL, "op9_substring_dedup": OP9_SQL, "op10_near_dedup": OP10_SQL}

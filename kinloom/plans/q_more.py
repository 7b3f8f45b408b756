"""Queries for string scores, judges, bands, reports and facades."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import compare, master, values
from ..functions.similarity import jaro_udf, jaro_winkler_udf, score_distinct
from ..operators import blocking, facade, match_master, reports, review, scoring, tiles
from ..session import materialize
from ..sources import readers, sinks
from . import oracle as O
from .people import CTE, source
from .pipeline import Pipeline, name_dedup
from .q_functions import _ADDR, _FLIP, _FULL, _HITS, _PARSED, _SPLIT, _SUFFIX, _TYPE, MATCH_KEY, SALT, _dept
from .q_operators import CL_CTE, Q_CTE, TS, V_CTE, clustered, queue, valid
from .registry import query

c = F.col


def recursive(cte: str) -> str:
    return cte.replace("WITH", "WITH RECURSIVE", 1)


def _pairs(rows: str, out: str, ssn: bool, where: str = "true") -> str:
    """Common table expressions ``out(id_a, id_b)``: the candidates of every strategy over a table with state,
    zip_normalized, city_normalized and phone_normalized, and the sampled pairs of rows in none."""
    side = f"(SELECT * FROM {rows} WHERE {where})"
    tests = [
        *(["a.ssn_token = b.ssn_token AND a.ssn_token <> ''"] if ssn else []), "a.state = b.state AND a.zip_normalized = b.zip_normalized AND trim(a.state) <> '' AND trim(a.zip_normalized) <> ''",
        "a.zip_normalized = b.zip_normalized AND trim(a.zip_normalized) <> ''",
        "a.city_normalized = b.city_normalized AND trim(a.city_normalized) <> '' AND (trim(a.state) = '' OR trim(a.zip_normalized) = '') AND (trim(b.state) = '' OR trim(b.zip_normalized) = '')",
        "substr(a.phone_normalized, 1, 6) = substr(b.phone_normalized, 1, 6) AND length(a.phone_normalized) >= 6 AND length(b.phone_normalized) >= 6",
    ]
    blocked = " UNION ".join(f"SELECT a.record_id AS id_a, b.record_id AS id_b FROM {side} a JOIN {side} b ON {t} AND a.record_id < b.record_id" for t in tests)
    return f"""{out}_z AS MATERIALIZED ({blocked}),
  {out}_n AS (SELECT record_id, row_number() OVER (ORDER BY record_id) - 1 AS i, count(*) OVER () AS n FROM {side}),
  {out}_o AS (SELECT record_id AS other FROM {out}_n WHERE i % greatest(1, n // greatest(1, least(100, n))) = 0),
  {out}_l AS (SELECT record_id FROM {out}_n WHERE record_id NOT IN (SELECT id_a FROM {out}_z UNION SELECT id_b FROM {out}_z)),
  {out}_f AS (SELECT least(record_id, other) AS id_a, greatest(record_id, other) AS id_b, min(record_id * 1000000000 + other) AS first_at FROM {out}_l JOIN {out}_o ON record_id <> other GROUP BY ALL),
  {out} AS MATERIALIZED (SELECT id_a, id_b FROM {out}_z UNION SELECT id_a, id_b FROM (SELECT * FROM {out}_f ORDER BY first_at LIMIT 50000))"""


# ---- String scores ----------------------------------------------------------------------------------------------------

_FIELDS = ["name", "address", "city"]
_SIDES = ", ".join(f"{O.sorted_words(f'{s}.{f}')} AS {f}_{s}, trim({s}.{f}) <> '' AS has_{f}_{s}" for f in _FIELDS for s in "xy")
_STRINGS = " UNION ".join(f"SELECT {f}_x AS a, {f}_y AS b FROM j" for f in _FIELDS)
_PARTS = {f: f"CASE WHEN has_{f}_x AND has_{f}_y THEN (SELECT ratio FROM r WHERE a = {f}_x AND b = {f}_y) / 100.0::DOUBLE END" for f in _FIELDS}
_FOUND = " + ".join(f"(has_{f}_x AND has_{f}_y)::INT" for f in _FIELDS)


@query("m13_mean_pairs", f"""{recursive(V_CTE)}, {_pairs('v', 'p', True)}, j AS MATERIALIZED (SELECT id_a, id_b, {_SIDES} FROM p JOIN v x ON x.record_id = id_a JOIN v y ON y.record_id = id_b),
  t AS (SELECT DISTINCT a, b FROM ({_STRINGS})), {O.ratios('t', 'r')}, s AS (SELECT id_a, id_b, {', '.join(f'{v} AS s_{f}' for f, v in _PARTS.items())}, {_FOUND} AS n FROM j)
  SELECT id_a, id_b, ({' + '.join(f'coalesce(s_{f}, 0.0::DOUBLE)' for f in _FIELDS)}) / n AS score FROM s WHERE n > 0 AND ({' + '.join(f'coalesce(s_{f}, 0.0::DOUBLE)' for f in _FIELDS)}) / n >= 0.85::DOUBLE""")  # fmt: skip
def _(spark, d):
    v = materialize(valid(spark, d), "valid")
    return scoring.mean_pairs(v, tiles.Blocks(v, with_fallback=True), _FIELDS)


def _clusters(part: str, least: int, where: str) -> str:
    """Common table expressions of one part of the name dedup: scored links, and what every record reaches."""
    key = lambda s: O.sorted_words(f"{s}.match_key")
    return f"""{_pairs('k', part, False, where)},
  {part}_j AS MATERIALIZED (SELECT id_a, id_b, {key('x')} AS a, {key('y')} AS b FROM {part} JOIN k x ON x.record_id = id_a JOIN k y ON y.record_id = id_b WHERE x.match_key <> '' AND y.match_key <> ''),
  {O.ratios(f'{part}_j', f'{part}_r')}, {part}_e AS MATERIALIZED (SELECT id_a, id_b, ratio FROM {part}_j JOIN {part}_r USING (a, b) WHERE ratio >= {least}),
  {part}_h AS MATERIALIZED (SELECT id_a AS u, id_b AS v FROM {part}_e UNION ALL SELECT id_b, id_a FROM {part}_e),
  {part}_c AS (SELECT DISTINCT u AS id, u AS c FROM {part}_h UNION SELECT v, c FROM {part}_c JOIN {part}_h ON u = id WHERE v > c)"""


_NAMES = f"""k AS MATERIALIZED (SELECT record_id, value AS name_parsed, {MATCH_KEY('value')} AS match_key, len({_HITS.replace('upper(name)', 'upper(value)')}) AS n_keywords, state,
  substr({O.digits('zip')}, 1, 5) AS zip_normalized, city AS city_normalized, {O.digits('phone')} AS phone_normalized FROM ({_FLIP}) JOIN ba USING (record_id))"""


@query("m15_name_dedup", f"""{recursive(CTE)}, {_NAMES}, {_clusters('auto', 85, 'n_keywords = 0')}, {_clusters('flag', 75, 'n_keywords > 0')},
  e AS (SELECT * FROM auto_e UNION ALL SELECT * FROM flag_e), best AS (SELECT id, max(ratio)::DOUBLE AS s FROM (SELECT id_a AS id, ratio FROM e UNION ALL SELECT id_b, ratio FROM e) GROUP BY id),
  cc AS (SELECT id, min(c) AS c FROM (SELECT * FROM auto_c UNION ALL SELECT * FROM flag_c) GROUP BY id)
  SELECT record_id, name_parsed, match_key, n_keywords, coalesce(c, -1) AS cluster_id, coalesce(s, 0.0::DOUBLE) AS similarity_score FROM k LEFT JOIN cc ON cc.id = record_id LEFT JOIN best ON best.id = record_id""")  # fmt: skip
def _(spark, d):
    auto, flagged = name_dedup(source(spark, d))
    return auto.unionByName(flagged).select("record_id", "name_parsed", "match_key", F.size("review_keywords").alias("n_keywords"), "cluster_id", "similarity_score")


def _two(column: str, least: float) -> str:
    return f"""{recursive(CTE)}, j AS MATERIALIZED (SELECT x.record_id AS id_a, y.record_id AS id_b, {O.sorted_words(f'x.{column}')} AS a, {O.sorted_words(f'y.{column}')} AS b, x.{column} <> '' AND y.{column} <> '' AS filled
  FROM ba x JOIN ba y ON y.record_id = x.record_id + 7), {O.ratios('j', 'r')}, s AS (SELECT id_a, id_b, CASE WHEN filled THEN ratio / 100.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM j JOIN r USING (a, b))
  SELECT id_a, id_b, score, score >= {least}::DOUBLE AS is_match FROM s"""


def _shifted(spark: SparkSession, d: str, column: str) -> DataFrame:
    a = source(spark, d).select(c("record_id").alias("id_a"), c(column).alias("a"))
    return a.join(a.select(c("id_a").alias("id_b"), c("a").alias("b")), c("id_b") == c("id_a") + 7)


query("m14_name_matches", _two("name", 0.85))(lambda spark, d: scoring.name_matches(_shifted(spark, d, "name"), "a", "b").select("id_a", "id_b", "score", "is_match"))
query("m14_address_matches", _two("address", 0.80))(lambda spark, d: scoring.address_matches(_shifted(spark, d, "address"), "a", "b").select("id_a", "id_b", "score", "is_match"))

_JARO = f"""{recursive(CTE)}, j AS MATERIALIZED ({' UNION ALL '.join(f"SELECT '{f}' AS field, x.record_id AS id_a, y.record_id AS id_b, x.{f} AS a, y.{f} AS b FROM ba x JOIN ba y ON y.record_id = x.record_id + 7" for f in ('name', 'address'))}), {O.jaro('j', 'r')}
  SELECT field, id_a, id_b, {{}} AS score FROM j JOIN r USING (a, b)"""


def _jaro(spark: SparkSession, d: str, udf) -> DataFrame:
    pairs = [_shifted(spark, d, f).select(F.lit(f).alias("field"), "id_a", "id_b", "a", "b") for f in ("name", "address")]
    return score_distinct(pairs[0].unionByName(pairs[1]), "a", "b", udf, "score").select("field", "id_a", "id_b", "score")


query("m01_jaro", _JARO.format("jaro"))(lambda spark, d: _jaro(spark, d, jaro_udf))
query("m02_jaro_winkler", _JARO.format("winkler"))(lambda spark, d: _jaro(spark, d, jaro_winkler_udf))

# ---- Record pairs, and the pipelines over them ----------------------------------------------------------------------------

_PLACE = O.squeeze(O.sub(O.chain(O.squeeze(f"lower({O.safe('ba.address')})"), values.PIPELINE_ADDRESS_RULES), r"[^\w\s\-]", ""))
_READY = f"""w AS MATERIALIZED (SELECT v.*, {_TYPE('ba.name')} AS kind, {_dept('ba.name')} AS dept, {O.squeeze(O.safe('t.rest'))} AS plain, {_SUFFIX('q.suffix')} AS gen, {_PLACE} AS addr
    FROM v JOIN ba USING (record_id) JOIN ({_SPLIT}) t USING (record_id) JOIN ({_PARSED}) q USING (record_id)),
  g AS MATERIALIZED (SELECT *, {_FULL('plain')} AS full_name, string_split(lower(plain), ' ')[1] AS given FROM w), y AS MATERIALIZED (SELECT *, coalesce(string_split({_FULL('given')}, ' ')[1], '') AS given_full FROM g)"""
_COLUMNS = ", ".join(f"{s}.{f} AS {f}_{s}" for f in ("plain", "full_name", "given", "given_full", "addr", "city_normalized", "state", "zip_normalized", "gen", "ssn_token") for s in ("a", "b"))
_SORTED = ", ".join(f"{O.sorted_words(f'{s}.{f}')} AS {f}_sorted_{s}" for f in ("plain", "full_name") for s in ("a", "b"))
_KINDS = {"base": "plain_sorted", "nick": "full_name_sorted", "addr": "addr", "town": "city_normalized", "gave": "given"}
_RATIO = ", ".join(f"(SELECT ratio FROM r WHERE a = {f}_a AND b = {f}_b) / 100.0::DOUBLE AS {k}" for k, f in _KINDS.items())
_LACKS = "city_normalized_a IN ('', 'nan', 'none') OR city_normalized_b IN ('', 'nan', 'none')"
_NO_STATE = "state_a IN ('', 'nan', 'none') OR state_b IN ('', 'nan', 'none')"


def _record_pairs(least: float) -> str:
    """Common table expressions up to ``scored(id_a, id_b, score, name_sim, addr_sim, match_method)``."""
    return f"""{recursive(V_CTE)}, {_READY}, {_pairs('v', 'p', True)},
  j AS MATERIALIZED (SELECT id_a, id_b, {_COLUMNS}, {_SORTED} FROM p JOIN y a ON a.record_id = id_a JOIN y b ON b.record_id = id_b
    WHERE a.kind = b.kind AND (a.kind <> 'department' OR a.dept = b.dept) AND NOT (a.gen <> '' AND b.gen <> '' AND a.gen <> b.gen)),
  f AS (SELECT * FROM j WHERE NOT (ssn_token_a <> '' AND ssn_token_a = ssn_token_b)),
  t AS ({' UNION '.join(f'SELECT {k}_a AS a, {k}_b AS b FROM f' for k in _KINDS.values())}), {O.ratios('t', 'r')},
  s1 AS (SELECT *, {_RATIO} FROM f),
  s2 AS (SELECT *, CASE WHEN nick > base AND nick >= 0.90::DOUBLE THEN least(0.99::DOUBLE, nick + 0.10::DOUBLE) ELSE greatest(base, nick) END AS name_sim, CASE WHEN {_LACKS} THEN 0.5::DOUBLE ELSE town END AS city,
    CASE WHEN {_NO_STATE} THEN 0.5::DOUBLE WHEN state_a = state_b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS same_state, CASE WHEN zip_normalized_a <> '' AND zip_normalized_a = zip_normalized_b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS same_zip FROM s1),
  s3 AS (SELECT *, name_sim * 0.40::DOUBLE + addr * 0.30::DOUBLE + city * 0.10::DOUBLE + same_state * 0.10::DOUBLE + same_zip * 0.10::DOUBLE AS x FROM s2),
  s4 AS (SELECT *, CASE WHEN given_a <> '' AND given_b <> '' AND given_full_a <> given_full_b AND gave < 0.70::DOUBLE THEN greatest(0.0::DOUBLE, x - 0.15::DOUBLE) ELSE x END AS x2 FROM s3),
  s5 AS (SELECT *, CASE WHEN (gen_a = '') <> (gen_b = '') THEN greatest(0.0::DOUBLE, x2 - 0.10::DOUBLE) ELSE x2 END AS x3 FROM s4),
  s6 AS (SELECT *, CASE WHEN same_zip = 1 AND addr >= 0.80::DOUBLE AND name_sim >= 0.80::DOUBLE THEN least(1.0::DOUBLE, x3 + 0.10::DOUBLE) ELSE x3 END AS score FROM s5),
  scored AS MATERIALIZED (SELECT id_a, id_b, score, name_sim, addr AS addr_sim, 'fuzzy' AS match_method FROM s6 WHERE score >= {least}::DOUBLE
    UNION ALL SELECT id_a, id_b, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, 'ssn_exact' FROM j WHERE ssn_token_a <> '' AND ssn_token_a = ssn_token_b)"""


def _assigned(links: str, out: str) -> str:
    """Common table expressions ``out(record_id, cluster_id, similarity_score)`` from links (id_a, id_b, score)."""
    return f"""{out}_h AS MATERIALIZED (SELECT id_a AS u, id_b AS v, score FROM {links} UNION ALL SELECT id_b, id_a, score FROM {links}),
  {out}_c AS (SELECT DISTINCT u AS id, u AS c FROM {out}_h UNION SELECT v, c FROM {out}_c JOIN {out}_h ON u = id WHERE v > c),
  {out}_m AS (SELECT id, min(c) AS c FROM {out}_c GROUP BY id), {out}_s AS (SELECT u, max(score) AS s FROM {out}_h GROUP BY u),
  {out} AS MATERIALIZED (SELECT record_id, coalesce(c, -1) AS cluster_id, coalesce(s, 0.0::DOUBLE) AS similarity_score FROM ba LEFT JOIN {out}_m ON id = record_id LEFT JOIN {out}_s ON u = record_id)"""


_FILLED = " + ".join(f"(trim({f}) <> '')::INT" for f in values.COMPLETENESS_FIELDS)
_OUTPUT = f"""o AS (SELECT z.record_id, z.cluster_id, similarity_score, v.* EXCLUDE (record_id) FROM z JOIN v USING (record_id)),
  n AS (SELECT *, CASE WHEN cluster_id = -1 THEN -record_id - 2 ELSE cluster_id END AS grp FROM o),
  k AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY ({_FILLED}) DESC, record_id) AS place, first_value(CASE WHEN trim(name) <> '' THEN name END IGNORE NULLS) OVER w AS fn,
    first_value(CASE WHEN trim(zip) <> '' THEN zip END IGNORE NULLS) OVER w AS fz, list(zip) OVER w AS zs FROM n WINDOW w AS (PARTITION BY grp ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
  b AS (SELECT *, CASE WHEN trim(zip) = '' THEN coalesce(fz, zip) ELSE zip END AS zz FROM k WHERE place = 1)
  SELECT record_id, cluster_id, similarity_score, CASE WHEN cluster_id <> -1 AND trim(name) = '' THEN coalesce(fn, name) ELSE name END AS name, CASE WHEN cluster_id = -1 THEN zip WHEN zz LIKE '%-%' OR substr({O.digits('zz')}, 1, 5) = '' THEN zz ELSE
    coalesce((list_filter(zs, lambda x: x LIKE '%-%' AND substr(regexp_replace(x, '[^0-9]', '', 'g'), 1, 5) = substr({O.digits('zz')}, 1, 5)))[1], zz) END AS zip FROM b"""
_WITHIN = """inside AS (SELECT a.record_id AS id_a, b.record_id AS id_b, (a.similarity_score + b.similarity_score) / 2 AS score FROM z0 a JOIN z0 b ON a.cluster_id = b.cluster_id AND a.cluster_id >= 0 AND a.record_id < b.record_id),
  certain AS MATERIALIZED (SELECT * FROM inside WHERE score >= 0.95::DOUBLE)"""


@query("m12_record_pairs", f"{_record_pairs(0.85)} SELECT * FROM scored")
def _(spark, d):
    v = materialize(valid(spark, d), "valid")
    return scoring.record_pairs(v, tiles.Blocks(v, with_fallback=True))


def _run(spark: SparkSession, d: str, stage: str) -> DataFrame:
    steps = [{"stage": "validate", "config": {"salt": SALT}}, {"stage": stage}, {"stage": "merge"}, {"stage": "output"}]
    return Pipeline(steps).run(source(spark, d)).select("record_id", "cluster_id", "similarity_score", "name", "zip")


query("o01_record_pipeline", f"{_record_pairs(0.85)}, {_assigned('scored', 'z')}, {_OUTPUT}")(lambda spark, d: _run(spark, d, "match"))
query("m22_hybrid_pipeline", f"{_record_pairs(0.75)}, {_assigned('scored', 'z0')}, {_WITHIN}, {_assigned('certain', 'z')}, {_OUTPUT}")(lambda spark, d: _run(spark, d, "hybrid_match"))

# ---- Blocking and clusters ----------------------------------------------------------------------------------------------

query("j21_block_fields", f"{V_CTE} SELECT a.record_id AS id_a, b.record_id AS id_b FROM v a JOIN v b ON a.city = b.city AND a.zip_normalized = b.zip_normalized AND trim(a.city) <> '' AND trim(a.zip_normalized) <> '' AND a.record_id < b.record_id")(
    lambda spark, d: blocking.by_fields(valid(spark, d), ["city", "zip_normalized"], with_fallback=False)
)
query("w09_largest_block", f"{V_CTE} SELECT state AS block, count(*) AS n_rows, (count(*) * (count(*) - 1) // 2)::BIGINT AS n_pairs FROM v WHERE state <> '' GROUP BY 1 ORDER BY n_pairs DESC, block LIMIT 1")(
    lambda spark, d: blocking.largest_block(valid(spark, d), "state")
)
query("j14_cluster_mean_scores", f"""{CL_CTE} SELECT a.record_id AS id_a, b.record_id AS id_b, (a.similarity_score + b.similarity_score) / 2 AS score FROM cl a JOIN cl b
  ON a.cluster_id = b.cluster_id AND a.cluster_id >= 0 AND a.record_id < b.record_id""")(lambda spark, d: scoring.cluster_pairs(clustered(spark, d)).drop("match_method"))  # fmt: skip


def same_name(batches):
    """A judge that accepts equal names."""
    for x in batches:
        x = x[x.name_1.str.upper() == x.name_2.str.upper()]
        yield x[["id_a", "id_b"]].assign(score=1.0, reasoning="equal")


same_name.reads = ["name"]

query("m26_judged_in_state", f"""{CTE}, g AS (SELECT record_id, trim(state) <> '' AS placed, count(*) OVER w AS n, min(record_id) OVER w AS c FROM ba WINDOW w AS (PARTITION BY upper(trim(state)), upper(name)))
  SELECT record_id, CASE WHEN placed AND n > 1 THEN c ELSE -1 END AS cluster_id, CASE WHEN placed AND n > 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS similarity_score FROM g""")(
    lambda spark, d: Pipeline([{"stage": "validate", "config": {"salt": SALT}}, {"stage": "judge_match", "config": {"judge": same_name}}]).run(source(spark, d)).select("record_id", "cluster_id", "similarity_score")
)
query("m27_hybrid_counters", f"""{CTE}, s AS (SELECT (record_id % 101) / 100.0::DOUBLE AS s FROM ba), b AS (SELECT count(*) AS pairs, count(*) FILTER (s >= 0.95) AS certain,
  count(*) FILTER (s >= 0.75 AND s < 0.95) AS uncertain, count(*) FILTER (s < 0.75) AS low, count(*) FILTER (s >= 0.9 AND s < 0.95) AS accepted FROM s)
  SELECT *, uncertain AS asked, certain + accepted AS linked FROM b""")(
    lambda spark, d: (lambda x: scoring.hybrid_counters(x, x.filter("bucket = 'uncertain' and score >= 0.9")))(scoring.hybrid_buckets(source(spark, d).select(((c("record_id") % 101) / 100.0).alias("score"))))
)


def merged(spark: SparkSession, d: str) -> facade.Merges:
    m = facade.Merges("ann")
    m.merge(clustered(spark, d).select("record_id", "cluster_id", "name", "city", "similarity_score").withColumns({x: F.lit("") for x in values.COMPLETENESS_FIELDS if x not in ("name", "city")}), F.expr(TS), "first")
    return m


query("v08_merge_facade", f"{CL_CTE} SELECT row_number() OVER (ORDER BY cluster_id) AS operation_id, cluster_id, count(*) AS affected_records FROM cl WHERE cluster_id <> -1 GROUP BY cluster_id")(
    lambda spark, d: merged(spark, d).audit_trail(user="ann").select("operation_id", "cluster_id", "affected_records")
)

# ---- Bands, verdicts, details -------------------------------------------------------------------------------------------

_S = "(record_id % 21) * 5"
query("p15_ambiguous_names", f"{CTE} SELECT record_id FROM ba WHERE {_S} BETWEEN 15 AND 70 AND record_id % 2 = 0")(
    lambda spark, d: source(spark, d).filter(master.ambiguous_name((c("record_id") % 21) * 5, (c("record_id") % 2 == 0).cast("int") * 100)).select("record_id")
)
_NUMS = f"list_sort(list_distinct(regexp_extract_all({O.sub('n.value', values.ANY_DATES, ' ')}, '\\d{{2,}}')))"
_ZIP5 = f"CASE WHEN length({O.digits('zip')}) >= 4 THEN lpad(substr({O.digits('zip')}, 1, 5), 5, '0') ELSE {O.digits('zip')} END"
query("p16_ambiguous_addresses", f"{CTE}, n AS ({_ADDR}) SELECT record_id FROM ba JOIN n USING (record_id) WHERE {_S} BETWEEN 15 AND 65 OR ({_S} = 0 AND {_ZIP5} <> '' AND len({_NUMS}) > 0)")(
    lambda spark, d: source(spark, d).withColumns({"z": master.normalize_zip(c("zip")), "n": F.array_sort(master.address_numbers(master.normalize_address(c("address"))))})
    .filter(master.ambiguous_address((c("record_id") % 21) * 5, c("z"), c("z"), c("n"), c("n"))).select("record_id")
)
query("p20_three_way", f"{CTE} SELECT record_id, CASE WHEN record_id % 5 = 0 THEN 'EXISTING ADDRESS' WHEN (record_id % 21) / 20.0::DOUBLE >= 0.75 THEN 'LIKELY SAME ADDRESS' ELSE 'NEW ADDRESS' END AS value FROM ba")(
    lambda spark, d: source(spark, d).select("record_id", compare.three_way(c("record_id") % 5 == 0, (c("record_id") % 21) / 20.0).alias("value"))
)
query("f44_details", f"""{CTE} SELECT record_id, concat_ws(' | ', CASE WHEN city <> '' THEN 'source: ' || city END, CASE WHEN state <> '' THEN 'dec: ' || state END) AS norm,
  concat_ws('; ', CASE WHEN city <> '' THEN city END, CASE WHEN record_id % 3 = 0 THEN printf('BOOST(DEC_CONTACT): %.3f', (record_id % 8) / 8.0::DOUBLE) END) AS matched FROM ba""")(
    lambda spark, d: source(spark, d).select(
        "record_id", master.audit_detail(c("city"), c("state")).alias("norm"), master.boost_detail(c("city"), F.when(c("record_id") % 3 == 0, "DEC_CONTACT"), (c("record_id") % 8) / 8.0).alias("matched"),
    )
)
_WORDS = [("TRUST_KEYWORD", "OIL", None), ("TRUST_KEYWORD", "HOSPITAL", None), ("BAD_SSN", "411111111", None)]


@query("s17_lookups_take_effect", f"{CTE} SELECT record_id, regexp_matches(name, '(?i)\\b(HOSPITAL|OIL)\\b') OR regexp_matches(address, '(?i)\\b(HOSPITAL|OIL)\\b') AS flagged FROM ba")
def _(spark, d):
    found = readers.load_lookups(spark.createDataFrame(_WORDS, "LOOKUP_TYPE string, LOOKUP_KEY string, LOOKUP_VALUE string"))
    return source(spark, d).select("record_id", master.is_trust(c("name"), c("address"), found["TRUST_KEYWORD"]).alias("flagged"))


@query("m25_validated_addresses", f"{CTE} SELECT record_id, upper(address) AS address, city, zip FROM ba")
def _(spark, d):
    def upper(batches):
        for x in batches:
            yield x.assign(new_address=x.address.str.upper(), new_city=x.city, new_state=x.state, new_zip=x.zip)

    return match_master.validate_addresses(source(spark, d), upper).select("record_id", "address", "city", "zip")


# ---- Reports ------------------------------------------------------------------------------------------------------------

_BUCKETS = [*(b[0] for b in values.BUCKETS), values.NEEDS_REVIEW]
_SOURCES = ["DEC_CONTACT", "SOURCE_ADDR_NAME", "SOURCE_ADDR+DEC_CONTACT", "DEC_ADDR_NAME", "SOURCE_ADDR+DEC_ADDR"]
_MADE = f"""m AS (SELECT ssn AS ssn_masked, CASE WHEN record_id % 3 > 0 THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS ssn_match, ((record_id % 21) * 5)::DOUBLE AS name_score, (record_id % 4)::BIGINT AS match_count,
  {O.table('record_id % 7', {str(k): v for k, v in enumerate(_SOURCES)}).replace("WHEN '", "WHEN ").replace("' THEN", " THEN")} AS boost, (record_id % 5 = 0) AS trust,
  {O.table(f'record_id % {len(_BUCKETS)}', {str(k): v for k, v in enumerate(_BUCKETS)}).replace("WHEN '", "WHEN ").replace("' THEN", " THEN")} AS rec, record_id % 2 AS possible FROM ba)"""
_ROWS = [
    ("OVERALL", "records", "count(*)"), ("OVERALL", "distinct identifiers", "count(DISTINCT nullif(ssn_masked, ''))"), ("OVERALL", "matched", "count(*) FILTER (ssn_match = 100)"), ("OVERALL", "not matched", "count(*) FILTER (ssn_match <> 100)"),
    *(("BY RECOMMENDATION", b, f"count(*) FILTER (rec = '{b}')") for b in _BUCKETS),
    ("NAME BOOST", "boosted", "count(*) FILTER (ssn_match = 100 AND boost IS NOT NULL)"), *(("NAME BOOST", b, f"count(*) FILTER (ssn_match = 100 AND boost = '{b}')") for b in _SOURCES),
    ("TRUST", "trusts", "count(*) FILTER (trust)"), ("TRUST", "matched trusts", "count(*) FILTER (trust AND ssn_match = 100)"), ("TRUST", "unmatched trusts", "count(*) FILTER (trust AND ssn_match <> 100)"),
    ("TRUST", "percent of records", "round(100.0::DOUBLE * count(*) FILTER (trust) / count(*), 1)"), ("DUPLICATE RISK", "multiple matches", "count(*) FILTER (ssn_match = 100 AND match_count > 1)"),
    ("DUPLICATE RISK", "possible address matches", "count(*) FILTER (possible > 0)"), ("DUPLICATE RISK", "mean matches", "round(avg(match_count) FILTER (ssn_match = 100), 1)"), ("DUPLICATE RISK", "most matches", "max(match_count) FILTER (ssn_match = 100)"),
    *(("NAME SCORES", b, f"count(*) FILTER (ssn_match = 100 AND {w})") for b, w in (("100", "name_score = 100"), ("90-95", "name_score BETWEEN 90 AND 95"), ("80-85", "name_score BETWEEN 80 AND 85"), ("70-75", "name_score BETWEEN 70 AND 75"), ("<70", "name_score < 70"))),
]


@query("a09_summary_rows", f"{CTE}, {_MADE} " + " UNION ALL ".join(f"SELECT '{a}' AS section, '{b}' AS metric, ({x})::DOUBLE AS value FROM m" for a, b, x in _ROWS))
def _(spark, d):
    pick = lambda n, of: F.element_at(F.array(*map(F.lit, [*of, *[None] * (n - len(of))])), (c("record_id") % n + 1).cast("int"))
    made = source(spark, d).select(
        c("ssn").alias("ssn_masked"), F.when(c("record_id") % 3 > 0, 100.0).otherwise(0.0).alias("ssn_match"), ((c("record_id") % 21) * 5).cast("double").alias("name_score"), (c("record_id") % 4).alias("match_count"),
        pick(7, _SOURCES).alias("name_boost_source"), (c("record_id") % 5 == 0).cast("int").alias("is_trust"), pick(len(_BUCKETS), _BUCKETS).alias("recommendation"), (c("record_id") % 2).alias("possible_address_matches"),
    )
    return reports.summary(made, _BUCKETS, _SOURCES)


query("k10_grouped_review", f"""{CL_CTE} SELECT CASE WHEN cluster_id = -1 THEN 'Single record' ELSE 'Potential duplicate group' END AS group_type, cluster_id, record_id, name, city, state, similarity_score AS similarity FROM cl""")(
    lambda spark, d: sinks.grouped_review(clustered(spark, d).withColumnRenamed("similarity_score", "similarity"))
)
query("r08_by_id", f"{Q_CTE} SELECT id, name_parsed FROM q WHERE id = (SELECT min(id) FROM q)")(
    lambda spark, d: (lambda q: review.by_id(q, q.agg(F.min("id")).first()[0]).select("id", "name_parsed"))(queue(spark, d))
)
query("r07_approved", f"{Q_CTE} SELECT name_parsed AS name, city FROM q WHERE review_status = 'approved'")(lambda spark, d: review.approved(queue(spark, d)).select("name", "city"))
query("k11_requeue", f"{Q_CTE} SELECT id, review_status FROM q WHERE review_status <> 'pending' UNION ALL SELECT id, 'pending' FROM q WHERE id % 2 = 0 AND review_status = 'pending'")(
    lambda spark, d: (lambda q: review.requeue(q, q.filter("review_status = 'pending' and id % 2 = 0")).select("id", "review_status"))(queue(spark, d))
)

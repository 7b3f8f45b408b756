"""Queries for the table operators: ingest, blocking, clustering, survivorship, matching, review, versioning, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions import values as V
from ..functions.text import digits
from ..operators import blocking as B
from ..operators import geo, match_master, prefilter, reports, review, scoring, validate, versioning
from ..operators import survivorship as S
from ..operators.components import connected_components
from ..operators.numbering import numbered
from ..session import materialize
from ..sources import readers, sinks
from . import oracle as O
from .people import CTE, master, source
from .q_functions import MATCH_KEY, NAME_TOKEN, SALT, SSN, SSN_MASTER
from .registry import query

c = F.col
TS = "TIMESTAMP '2025-01-01 00:00:00'"

# ---- The validated records, and clusters by match key and zip -------------------------------------------------------


def valid(spark: SparkSession, d: str) -> DataFrame:
    return validate.validate(source(spark, d), SALT)


V_CTE = f"""{CTE}, v AS (SELECT record_id, name, address, contact_person, updated_date, CASE WHEN contains(email, '@') THEN lower(trim(email)) ELSE '' END AS email, zip, city, phone,
  upper(trim(state)) AS state, substr({O.digits('zip')}, 1, 5) AS zip_normalized, {O.squeeze('city')} AS city_normalized, {O.digits('phone')} AS phone_normalized,
  CASE WHEN {SSN} = '' THEN '' ELSE sha256({SSN} || '|{SALT}') END AS ssn_token FROM ba)"""
CL_CTE = f"""{CTE}, k AS (SELECT *, {MATCH_KEY('name')} AS mk, substr({O.digits('zip')}, 1, 3) || (record_id % 5) AS z FROM ba),
  cl AS (SELECT *, CASE WHEN count(*) OVER w > 1 THEN min(record_id) OVER w ELSE -1 END AS cluster_id, (record_id % 20) / 20.0::DOUBLE AS similarity_score FROM k WINDOW w AS (PARTITION BY mk, z))"""


def clustered(spark: SparkSession, d: str) -> DataFrame:
    from ..functions import keys as K

    df = source(spark, d).withColumn("mk", K.match_key(c("name"))).withColumn("z", F.concat(F.substring(digits(c("zip")), 1, 3), (c("record_id") % 5).cast("string")))
    w = Window.partitionBy("mk", "z")
    cid = F.when(F.count(F.lit(1)).over(w) > 1, F.min("record_id").over(w)).otherwise(-1)
    return df.withColumn("cluster_id", cid).withColumn("similarity_score", (c("record_id") % 20) / 20.0).drop("mk", "z")


# ---- Sources and sinks ------------------------------------------------------------------------------------------------


@query("s01_csv_round_trip", f"{CTE} SELECT record_id::VARCHAR AS record_id, nullif(name, '') AS name, nullif(zip, '') AS zip FROM ba")
def _(spark, d):
    from ..session import work_dir

    path = f"{work_dir(spark)}/kinloom/csv"
    sinks.export_csv(source(spark, d).select("record_id", "name", "zip"), path)
    return readers.ingest(spark, "csv", path=path)


query("s10_master_join", f"{CTE} SELECT record_id, {SSN_MASTER('ssn')} AS ssn_clean, addr FROM (SELECT record_id, ssn FROM ba WHERE record_id % 3 > 0) JOIN (SELECT record_id AS code, address AS addr FROM master WHERE record_id % 2 = 0) ON record_id = code")(
    lambda spark, d: match_master.load_master(
        source(spark, d).select(c("record_id").alias("BUS_ASSOC_CODE"), c("ssn").alias("SSN"), F.when(c("record_id") % 3 > 0, "TaxInfo").otherwise("Other").alias("ATT_TYPE")),
        master(spark, d).select(c("record_id").alias("HDRCODE"), c("address").alias("addr"), F.when(c("record_id") % 2 == 0, "BusAssoc").otherwise("x").alias("HDRTYPECODE")),
    ).select(c("HDRCODE").alias("record_id"), "ssn_clean", "addr")
)
query("s12_master_load", f"{CTE} SELECT record_id, {O.squeeze(O.sub("name || chr(10) || ' x'", r'[\r\n]+', ' '))} AS hdrname, {O.digits('ssn')} AS ssn FROM master")(
    lambda spark, d: readers.load_master_csv(master(spark, d).select("record_id", F.concat(c("name"), F.lit("\n x")).alias("hdrname"), "ssn"))
)
query("s08_filled_upper", f"{CTE} SELECT record_id::VARCHAR AS RECORD_ID, coalesce(nullif(name, ''), '') AS NAME FROM ba")(
    lambda spark, d: readers.filled_upper(source(spark, d).select("record_id", F.when(c("name") != "", c("name")).alias("name")))
)
_LOOK = "SELECT * FROM (VALUES ('NICK', 'BILL', 'WILLIAM'), ('NICK', 'BOB', 'ROBERT'), ('SUFFIX', 'LLC', NULL), ('SUFFIX', 'INC', NULL)) AS t(LOOKUP_TYPE, LOOKUP_KEY, LOOKUP_VALUE)"
query("s17_lookup_sizes", f"SELECT LOOKUP_TYPE, count(*) AS n, count(LOOKUP_VALUE) = 0 AS is_set FROM ({_LOOK}) GROUP BY 1")(lambda spark, d: readers.lookup_sizes(spark.sql(_LOOK)))
query("k01_table_modes", f"{CTE} SELECT record_id, name FROM ba UNION ALL SELECT record_id, name FROM ba WHERE record_id % 2 = 0")(
    lambda spark, d: _table_modes(spark, source(spark, d).select("record_id", "name"))
)


def _table_modes(spark: SparkSession, df: DataFrame) -> DataFrame:
    name = f"kinloom_modes_{uuid.uuid4().hex}"
    sinks.write_table(df, name, "fail")
    sinks.write_table(df.filter("record_id % 2 = 0"), name, "append")
    return spark.table(name)


@query("k05_archive_and_replace", f"{CTE} SELECT 'now' AS place, 'r2' AS run_id, count(*) AS n FROM ba WHERE record_id % 3 = 0 UNION ALL SELECT 'archive', 'r1', count(*) FROM ba WHERE record_id % 3 = 1")
def _(spark, d):
    now, old = (f"kinloom_{n}_{uuid.uuid4().hex}" for n in ("now", "archive"))
    df = source(spark, d).select("record_id")
    sinks.archive_and_replace(df.filter("record_id % 3 = 1"), now, old, "r1")
    sinks.archive_and_replace(df.filter("record_id % 3 = 0"), now, old, "r2")
    one = lambda t, p: spark.table(t).groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(p).alias("place"), "run_id", "n")
    return one(now, "now").unionByName(one(old, "archive"))


query("k04_output_columns", f"{CTE} SELECT record_id, name FROM ba")(
    lambda spark, d: validate.drop_working_columns(source(spark, d).select("record_id", "name", c("zip").alias("zip_normalized"), c("zip").alias("_z")))
)

# ---- Projections and filters -------------------------------------------------------------------------------------------

query("p01_rename_headers", f"{CTE} SELECT record_id AS id_no, name AS full_name FROM ba")(
    lambda spark, d: validate.rename_fields(validate.normalize_headers(source(spark, d).select(c("record_id").alias("ID-No"), c("name").alias("Client Name"))), {"client_name": "full_name", "absent": "x"})
)
query("p03_required_blanks", f"{CTE} SELECT count(*) FILTER (trim(name) = '') AS blank_name, count(*) FILTER (trim(address) = '') AS blank_address FROM ba")(lambda spark, d: validate.blank_counts(source(spark, d)))
query("p03_drop_invalid", f"{CTE} SELECT record_id FROM ba WHERE trim(name) <> '' AND trim(address) <> ''")(lambda spark, d: validate.require_fields(source(spark, d), drop_invalid=True).select("record_id"))
query("p04_optional_fields", f"{CTE} SELECT record_id, '' AS city, '' AS notes FROM ba")(lambda spark, d: validate.add_optional_fields(source(spark, d).select("record_id")).select("record_id", "city", "notes"))
query("p07_cluster_records", f"{CL_CTE} SELECT record_id, name FROM cl WHERE cluster_id = (SELECT min(cluster_id) FROM cl WHERE cluster_id >= 0)")(
    lambda spark, d: (lambda x: S.cluster_records(x, x.filter("cluster_id >= 0").agg(F.min("cluster_id").alias("cluster_id"))).select("record_id", "name"))(clustered(spark, d))
)
_BY_ZIP = "a JOIN v b ON a.zip_normalized = b.zip_normalized AND a.zip_normalized <> '' AND a.record_id < b.record_id"
query("p17_hybrid_buckets", f"{CTE} SELECT CASE WHEN s >= 0.95 THEN 'certain' WHEN s >= 0.75 THEN 'uncertain' ELSE 'low' END AS bucket, count(*) AS n FROM (SELECT (record_id % 101) / 100.0::DOUBLE AS s FROM ba) GROUP BY 1")(
    lambda spark, d: scoring.hybrid_buckets(source(spark, d).select(((c("record_id") % 101) / 100.0).alias("score"))).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
)
query("p18_quality_warnings", f"""{CTE} SELECT count(*) FILTER (trim(name) <> '' AND length(trim(name)) < 3) AS short_name, count(*) FILTER (trim(email) <> '' AND NOT contains(email, '@')) AS bad_email,
  count(*) FILTER (length(substr({O.digits('zip')}, 1, 5)) BETWEEN 1 AND 4) AS short_zip, count(*) FILTER (length({O.digits('phone')}) BETWEEN 1 AND 9) AS short_phone FROM ba""")(lambda spark, d: validate.quality_warnings(source(spark, d)))  # fmt: skip

# ---- Blocking ----------------------------------------------------------------------------------------------------------


def pair_query(name: str, f, on: str, keep: str = "true"):
    query(name, f"{V_CTE}, w AS (SELECT *, {O.digits('phone')} AS ph, {NAME_TOKEN} AS tok FROM v) SELECT a.record_id AS id_a, b.record_id AS id_b FROM (SELECT * FROM w WHERE {keep}) a JOIN (SELECT * FROM w WHERE {keep}) b ON {on} AND a.record_id < b.record_id")(
        lambda spark, d: f(valid(spark, d))
    )


pair_query("j04_block_ssn", B.by_ssn, "a.ssn_token = b.ssn_token", "ssn_token <> ''")
pair_query("j05_block_state_zip", B.by_state, "a.state = b.state AND a.zip_normalized = b.zip_normalized", "state <> '' AND zip_normalized <> ''")
pair_query("j06_block_zip", B.by_zip, "a.zip_normalized = b.zip_normalized", "zip_normalized <> ''")
pair_query("j07_block_city", B.by_city, "a.city_normalized = b.city_normalized", "city_normalized <> '' AND (state = '' OR zip_normalized = '')")
pair_query("j08_block_phone", B.by_phone, "substr(a.ph, 1, 6) = substr(b.ph, 1, 6)", "length(ph) >= 6")
_TOK = "length(tok) >= 3"
query("j09_block_name_token", f"{CTE}, w AS (SELECT record_id, {NAME_TOKEN} AS tok FROM ba) SELECT tok AS block, count(*) AS n_rows, (count(*) * (count(*) - 1) // 2)::BIGINT AS n_pairs FROM w WHERE {_TOK} GROUP BY 1")(
    lambda spark, d: B.block_sizes(source(spark, d).select(F.when(F.length(R.name_token(c("name"))) >= 3, R.name_token(c("name"))).alias("tok")), "tok")
)
pair_query("j09_name_token_pairs", B.by_name_token, "a.tok = b.tok", _TOK)
_UNION = """u AS (SELECT a.record_id AS id_a, b.record_id AS id_b, 0 AS o, 'ssn' AS strategy FROM v a JOIN v b ON a.ssn_token = b.ssn_token AND a.ssn_token <> '' AND a.record_id < b.record_id
  UNION ALL SELECT a.record_id, b.record_id, 1, 'state' FROM v a JOIN v b ON a.state = b.state AND a.zip_normalized = b.zip_normalized AND a.state <> '' AND a.zip_normalized <> '' AND a.record_id < b.record_id
  UNION ALL SELECT a.record_id, b.record_id, 2, 'zip' FROM v a JOIN v b ON a.zip_normalized = b.zip_normalized AND a.zip_normalized <> '' AND a.record_id < b.record_id)"""
query("j11_block_union", f"{V_CTE}, {_UNION} SELECT id_a, id_b, arg_min(strategy, o) AS strategy FROM u GROUP BY ALL")(lambda spark, d: B.candidates(valid(spark, d), ["ssn", "state", "zip"]))
_LONE = f"""SELECT record_id FROM v WHERE record_id NOT IN (SELECT id_a FROM z UNION SELECT id_b FROM z)"""
_Z = "z AS (SELECT a.record_id AS id_a, b.record_id AS id_b FROM v a JOIN v b ON a.zip_normalized = b.zip_normalized AND a.zip_normalized <> '' AND a.record_id < b.record_id)"
query("j18_uncovered", f"{V_CTE}, {_Z} {_LONE}")(lambda spark, d: (lambda v: B.uncovered(v.select("record_id"), B.by_zip(v)))(valid(spark, d)))
_FALLBACK = f"""{V_CTE}, {_Z}, n AS (SELECT record_id, row_number() OVER (ORDER BY record_id) - 1 AS i, count(*) OVER () AS n FROM v),
  s AS (SELECT record_id AS other FROM n WHERE i % greatest(1, n // greatest(1, least(100, n))) = 0),
  b AS (SELECT least(record_id, other) AS id_a, greatest(record_id, other) AS id_b, record_id, other FROM ({_LONE}) JOIN s ON record_id <> other),
  g AS (SELECT id_a, id_b, min(record_id * 1000000000 + other) AS first_at FROM b GROUP BY ALL) SELECT id_a, id_b FROM g ORDER BY first_at LIMIT """
query("j10_fallback", f"{_FALLBACK}2000")(lambda spark, d: (lambda v: B.fallback(v, B.by_zip(v), 2000))(valid(spark, d)))
query("j10_fallback_full", f"{_FALLBACK}50000")(lambda spark, d: (lambda v: B.fallback(v, B.by_zip(v)))(valid(spark, d)))
query("j13_pairs_in_state", f"{V_CTE} SELECT state AS block, count(*) AS n_rows, (count(*) * (count(*) - 1) // 2)::BIGINT AS n_pairs FROM v WHERE state <> '' GROUP BY 1")(lambda spark, d: B.block_sizes(valid(spark, d), "state"))
pair_query("j13_all_pairs_in_state", B.all_pairs_by_state, "a.state = b.state", "state <> ''")
query("j14_pairs_in_cluster", f"{CL_CTE} SELECT a.record_id AS id_a, b.record_id AS id_b FROM cl a JOIN cl b ON a.cluster_id = b.cluster_id AND a.cluster_id >= 0 AND a.record_id < b.record_id")(lambda spark, d: B.within_clusters(clustered(spark, d)))
query("a15_blocking_coverage", f"{V_CTE} SELECT count(*) AS n_rows, (count(*) * (count(*) - 1) // 2)::BIGINT AS all_pairs, count(*) FILTER (ssn_token <> '') AS has_ssn_token, count(*) FILTER (zip_normalized <> '') AS has_zip_normalized FROM v")(
    lambda spark, d: B.coverage(valid(spark, d), ["ssn_token", "zip_normalized"])
)
query("a16_comparison_savings", f"{V_CTE}, {_Z} SELECT round(100 * (1 - (SELECT count(*) FROM z) / (count(*) * (count(*) - 1) / 2)), 1) AS saved_pct FROM v")(
    lambda spark, d: (lambda v: v.agg(F.count(F.lit(1)).alias("n")).crossJoin(B.by_zip(v).agg(F.count(F.lit(1)).alias("p"))).select(reports.savings(c("n"), c("p")).alias("saved_pct")))(valid(spark, d))
)

# ---- Clusters and golden records --------------------------------------------------------------------------------------

_EDGES = "e AS (SELECT record_id AS a, record_id + 7 AS b FROM ba WHERE record_id % 10 < 3 UNION ALL SELECT record_id, record_id + 11 FROM ba WHERE record_id % 25 = 0)"
query("m16_components", f"""{CTE.replace('WITH', 'WITH RECURSIVE', 1)}, {_EDGES}, s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  r AS (SELECT a AS id, a AS c FROM s UNION SELECT s.b, r.c FROM r JOIN s ON s.a = r.id) SELECT id, min(c) AS component FROM r GROUP BY id""")(
    lambda spark, d: connected_components(
        source(spark, d).select(F.explode(F.array_compact(F.array(F.when(c("record_id") % 10 < 3, F.struct(c("record_id").alias("id_a"), (c("record_id") + 7).alias("id_b"))), F.when(c("record_id") % 25 == 0, F.struct(c("record_id").alias("id_a"), (c("record_id") + 11).alias("id_b")))))).alias("e")).select("e.*")
    )
)
_COUNT = " + ".join(f"(trim({f}) <> '')::INT" for f in V.COMPLETENESS_FIELDS)
_FIRST = "row_number() OVER (PARTITION BY cluster_id ORDER BY {} record_id) AS r"
query("w01_most_complete", f"{CL_CTE} SELECT cluster_id, record_id FROM (SELECT *, {_FIRST.format(f'({_COUNT}) DESC,')} FROM cl WHERE cluster_id <> -1) WHERE r = 1")(
    lambda spark, d: S.most_complete(clustered(spark, d).filter("cluster_id <> -1"), fill=False).select("cluster_id", "record_id")
)
_FILL = lambda f: f"first_value(CASE WHEN trim({f}) <> '' THEN {f} END IGNORE NULLS) OVER (PARTITION BY cluster_id ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
_GOLD = f"""SELECT cluster_id, record_id, phone, email, CASE WHEN zip LIKE '%-%' OR substr({O.digits('zip')}, 1, 5) = '' THEN zip ELSE
  coalesce((list_filter(zs, lambda z: z LIKE '%-%' AND substr(regexp_replace(z, '[^0-9]', '', 'g'), 1, 5) = substr({O.digits('zip')}, 1, 5)))[1], zip) END AS zip FROM (
  SELECT cluster_id, record_id, r, CASE WHEN trim(phone) = '' THEN coalesce(fp, phone) ELSE phone END AS phone, CASE WHEN trim(email) = '' THEN coalesce(fe, email) ELSE email END AS email,
    CASE WHEN trim(zip) = '' THEN coalesce(fz, zip) ELSE zip END AS zip, zs FROM (SELECT *, {_FIRST.format(f'({_COUNT}) DESC,')}, {_FILL('phone')} AS fp, {_FILL('email')} AS fe, {_FILL('zip')} AS fz,
    list(zip) OVER (PARTITION BY cluster_id ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS zs FROM cl WHERE cluster_id <> -1)) WHERE r = 1"""
query("m18_golden_filled", f"{CL_CTE} {_GOLD}")(lambda spark, d: S.most_complete(clustered(spark, d).filter("cluster_id <> -1")).select("cluster_id", "record_id", "phone", "email", "zip"))
query("w05_most_recent", f"{CL_CTE} SELECT cluster_id, record_id FROM (SELECT *, {_FIRST.format('updated_date DESC,')} FROM cl WHERE cluster_id <> -1) WHERE r = 1")(
    lambda spark, d: S.most_recent(clustered(spark, d).filter("cluster_id <> -1")).select("cluster_id", "record_id")
)
_MODE = lambda f: f"coalesce((SELECT {f} FROM cl x WHERE x.cluster_id = g.cluster_id AND trim({f}) <> '' GROUP BY {f} ORDER BY count(*) DESC, {f} LIMIT 1), '') AS {f}"
query("a04_best_values", f"{CL_CTE} SELECT cluster_id, {_MODE('city')}, {_MODE('phone')} FROM (SELECT DISTINCT cluster_id FROM cl WHERE cluster_id <> -1) g")(lambda spark, d: S.best_values(clustered(spark, d).filter("cluster_id <> -1"), ["city", "phone"]))
query("u01_singletons_union", f"{CL_CTE} SELECT record_id FROM cl WHERE cluster_id = -1 UNION ALL SELECT min(record_id) FROM cl WHERE cluster_id <> -1 GROUP BY cluster_id")(lambda spark, d: S.merge_all(clustered(spark, d), "first")[0].select("record_id"))
query("v07_merge_audit", f"{CL_CTE} SELECT cluster_id, count(*) AS source_record_count, array_to_string(list(record_id ORDER BY record_id), ',') AS ids, 'first' AS merge_strategy FROM cl WHERE cluster_id <> -1 GROUP BY 1")(
    lambda spark, d: S.merge_audit(clustered(spark, d), "first").select("cluster_id", "source_record_count", F.array_join(F.transform("source_record_ids", lambda x: x.cast("string")), ",").alias("ids"), "merge_strategy")
)
query("a03_cluster_stats", f"{CL_CTE} SELECT cluster_id, count(*) AS n, avg({_COUNT}) AS avg_completeness, max({_COUNT}) AS max_completeness, true AS has_phone, true AS has_email, true AS has_address FROM cl WHERE cluster_id <> -1 GROUP BY 1")(lambda spark, d: S.cluster_stats(clustered(spark, d)))
query("a06_merge_summary", f"""{CL_CTE}, m AS (SELECT cluster_id, name, min(record_id) AS f FROM cl WHERE cluster_id <> -1 GROUP BY ALL), t AS (SELECT cluster_id, count(*) AS record_count FROM cl WHERE cluster_id <> -1 GROUP BY 1)
  SELECT m.cluster_id, arg_min(name, f) AS first_name, array_to_string((list(name ORDER BY f))[1:5], ' | ') AS all_names, any_value(record_count) AS record_count FROM m JOIN t USING (cluster_id) GROUP BY 1""")(lambda spark, d: S.merge_summary(clustered(spark, d)))
_SC = "sc AS (SELECT record_id AS id_a, record_id + 7 AS id_b, (record_id % 13) * 5 AS score FROM ba)"


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return source(spark, d).select(c("record_id").alias("id_a"), (c("record_id") + 7).alias("id_b"), ((c("record_id") % 13) * 5).alias("score"))


query("a17_best_score", f"{CTE}, {_SC} SELECT id AS record_id, max(score)::DOUBLE AS similarity_score FROM (SELECT id_a AS id, score FROM sc UNION ALL SELECT id_b, score FROM sc) GROUP BY 1")(lambda spark, d: S.best_score(_scored(spark, d)))
query("a18_best_reason", f"{CTE}, {_SC} SELECT id AS record_id, arg_min('p' || id_a, (-score, id_a, id_b)) AS reason FROM (SELECT id_a AS id, * FROM sc UNION ALL SELECT id_b, * FROM sc) GROUP BY 1")(
    lambda spark, d: S.best_reason(_scored(spark, d).withColumn("reason", F.concat(F.lit("p"), c("id_a").cast("string"))), "reason")
)
query("w07_similarity_to_first", f"""{CL_CTE}, {_SC}, f AS (SELECT record_id, cluster_id, min(record_id) OVER (PARTITION BY cluster_id) AS first_id FROM cl WHERE cluster_id <> -1)
  SELECT record_id, cluster_id, first_id, CASE WHEN record_id = first_id THEN 100.0::DOUBLE ELSE score::DOUBLE END AS similarity FROM f LEFT JOIN sc ON id_a = first_id AND id_b = record_id""")(lambda spark, d: S.similarity_to_first(clustered(spark, d), _scored(spark, d)))
query("m21_exact_names", f"{CTE} SELECT record_id FROM (SELECT *, row_number() OVER (PARTITION BY upper(trim(name)) ORDER BY ({_COUNT}) DESC, record_id) AS r FROM ba) WHERE r = 1")(lambda spark, d: S.exact_names(source(spark, d)).select("record_id"))
query("w08_row_labels", f"{CTE} SELECT record_id, 'R' || lpad(row_number() OVER (ORDER BY record_id)::VARCHAR, 4, '0') AS label FROM ba")(
    lambda spark, d: numbered(source(spark, d).select("record_id"), "record_id").select("record_id", F.concat(F.lit("R"), F.lpad((c("number") + 1).cast("string"), 4, "0")).alias("label"))  # as in SQL, lpad also cuts to four places
)
query("l05_batches", f"{CTE} SELECT record_id, ((row_number() OVER (ORDER BY record_id) - 1) // 400)::INT AS batch_id FROM ba")(lambda spark, d: prefilter.batches(source(spark, d), 400).select("record_id", "batch_id"))
query("a02_prefilter_split", f"{V_CTE} SELECT record_id, CASE WHEN ssn_token = '' THEN 0 ELSE n END AS key_count, ssn_token = '' OR n <> 1 AS needs_dedup FROM (SELECT record_id, ssn_token, count(*) OVER (PARTITION BY ssn_token) AS n FROM v)")(
    lambda spark, d: prefilter.split_unique(valid(spark, d), c("ssn_token")).select("record_id", "key_count", "needs_dedup")
)
query("a01_exact_dedup", f"{CTE} SELECT record_id, name, address FROM ba")(
    lambda spark, d: (lambda df: validate.validate(df.unionByName(df.filter("record_id % 3 = 0")), SALT).select("record_id", "name", "address"))(source(spark, d))
)
query("f41_geo_enrich", f"""{CTE}, p AS (SELECT * FROM (VALUES {', '.join(str((k, *r)) for k, r in enumerate(geo.PLACES))}) AS t(ord, pz, pc, ps, county)),
  x AS (SELECT record_id, zip, city, state, (SELECT arg_min(pz, ord) FROM p WHERE lower(pc) = lower(trim(city)) AND ps = upper(trim(state))) AS fz, (SELECT arg_min(pc, ord) FROM p WHERE pz = substr(zip, 1, 5)) AS fc, (SELECT arg_min(ps, ord) FROM p WHERE pz = substr(zip, 1, 5)) AS fs FROM ba)
  SELECT record_id, CASE WHEN zip = '' THEN coalesce(fz, zip) ELSE zip END AS zip, CASE WHEN city = '' THEN coalesce(fc, city) ELSE city END AS city, CASE WHEN state = '' THEN coalesce(fs, state) ELSE state END AS state,
  CASE WHEN zip <> '' THEN 'original' WHEN fz IS NOT NULL THEN 'lookup' ELSE 'missing' END AS zip_source FROM x""")(
    lambda spark, d: geo.enrich(source(spark, d), geo.places(spark)).select("record_id", "zip", "city", "state", "zip_source")
)
query("f42_infer_location", f"""{CTE}, i1 AS MATERIALIZED (SELECT record_id, address, city, coalesce(nullif(state, ''), nullif(lower(regexp_extract(address, '\\b([A-Z]{{2}})\\b', 1)), '')) AS state, coalesce(nullif(zip, ''), nullif(regexp_extract(address, '\\b(\\d{{5}})\\b', 1), '')) AS zip FROM ba),
  ms AS MATERIALIZED (SELECT address, state AS ms FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY n DESC, state) AS r FROM (SELECT address, state, count(*) AS n FROM i1 WHERE state IS NOT NULL GROUP BY 1, 2)) WHERE r = 1),
  mz AS MATERIALIZED (SELECT address, zip AS mz FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY n DESC, zip) AS r FROM (SELECT address, zip, count(*) AS n FROM i1 WHERE zip IS NOT NULL GROUP BY 1, 2)) WHERE r = 1),
  i2 AS MATERIALIZED (SELECT record_id, address, city, coalesce(state, ms) AS state, coalesce(zip, mz) AS zip FROM i1 LEFT JOIN ms USING (address) LEFT JOIN mz USING (address)),
  mc AS MATERIALIZED (SELECT city, state, zip AS mc FROM (SELECT *, row_number() OVER (PARTITION BY city, state ORDER BY n DESC, zip) AS r FROM (SELECT city, state, zip, count(*) AS n FROM i2 WHERE zip IS NOT NULL GROUP BY 1, 2, 3)) WHERE r = 1)
  SELECT record_id, coalesce(i2.state, '') AS state, coalesce(zip, mc, '') AS zip FROM i2 LEFT JOIN mc ON i2.city = mc.city AND i2.state = mc.state""")(
    lambda spark, d: validate.infer_location(source(spark, d)).select("record_id", "state", "zip")
)

# ---- Scores (Python kernels: checked against goldens and brute force in the tests) --------------------------------------


@query("m09_match_master")
def _(spark, d):
    return match_master.match(source(spark, d), master(spark, d))


query("j02_source_master", f"""{CTE}, s AS (SELECT record_id, {SSN_MASTER('ssn')} AS k FROM ba), m AS (SELECT record_id AS m_record_id, {SSN_MASTER('ssn')} AS k FROM master), n AS (SELECT k, count(*) AS n FROM m WHERE k <> '' GROUP BY k)
  SELECT s.record_id, m.m_record_id, CASE WHEN s.k = '' THEN 'NO_SSN' WHEN n IS NULL THEN 'SSN_NOT_FOUND' ELSE 'MATCHED' END AS ssn_status, coalesce(n, 0) AS match_count
  FROM s LEFT JOIN m ON s.k = m.k AND s.k <> '' LEFT JOIN n ON s.k = n.k""")(
    lambda spark, d: match_master.candidates(source(spark, d), master(spark, d)).select("record_id", "m_record_id", "ssn_status", "match_count")
)

# ---- Reports -------------------------------------------------------------------------------------------------------------

query("a05_record_stats", f"""{CL_CTE} SELECT count(*) AS total, count(*) FILTER (cluster_id <> -1) AS in_clusters, count(DISTINCT CASE WHEN cluster_id <> -1 THEN cluster_id END) AS clusters, count(*) FILTER (cluster_id = -1) AS singletons,
  count(*) FILTER (cluster_id = -1) + count(DISTINCT CASE WHEN cluster_id <> -1 THEN cluster_id END) AS unique_entities, round(100.0::DOUBLE * count(*) FILTER (cluster_id <> -1) / count(*), 1) AS duplicate_pct FROM cl""")(lambda spark, d: reports.record_stats(clustered(spark, d)))  # fmt: skip
query("a10_fill_rates", f"{CTE} SELECT field, filled, n - filled AS empty, round(filled * 100.0::DOUBLE / n, 1) AS pct FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER (trim({f}) <> '') AS filled, count(*) AS n FROM ba" for f in ("name", "zip", "email")) + ")")(
    lambda spark, d: reports.fill_rates(source(spark, d), ["name", "zip", "email"])
)
query("a09_score_bands", f"{CTE} SELECT CASE WHEN s = 100 THEN '100' WHEN s >= 90 THEN '90-95' WHEN s >= 80 THEN '80-85' WHEN s >= 70 THEN '70-75' ELSE '<70' END AS band, count(*) AS n FROM (SELECT (record_id % 21) * 5 AS s FROM ba) GROUP BY 1")(
    lambda spark, d: reports.score_bands(source(spark, d).select(((c("record_id") % 21) * 5).alias("s")), "s")
)
query("l01_top_states", f"{CTE} SELECT state, count(*) AS n FROM ba WHERE trim(state) <> '' GROUP BY 1 ORDER BY n DESC, state LIMIT 10")(lambda spark, d: reports.top_states(source(spark, d)))
query("a13_group_report", f"{CL_CTE} SELECT cluster_id, count(*) AS n, string_agg(name, ',' ORDER BY record_id) AS names, round(max(similarity_score) * 100, 1) AS max_score, round(avg(similarity_score) * 100, 1) AS avg_score FROM cl WHERE cluster_id <> -1 GROUP BY 1")(lambda spark, d: reports.group_report(clustered(spark, d)))
query("a13_size_histogram", f"{CL_CTE} SELECT size, count(*) AS clusters FROM (SELECT count(*) AS size FROM cl WHERE cluster_id <> -1 GROUP BY cluster_id) GROUP BY 1")(lambda spark, d: reports.size_histogram(clustered(spark, d)))


@query("a09_match_summary")
def _(spark, d):
    return reports.match_summary(match_master.match(source(spark, d), master(spark, d)))


@query("a11_recommendations")
def _(spark, d):
    return reports.recommendation_stats(match_master.match(source(spark, d), master(spark, d)))


# ---- Review queue --------------------------------------------------------------------------------------------------------


def queue(spark: SparkSession, d: str) -> DataFrame:
    """A queue whose rows were decided by id: every fourth approved, every seventh rejected, every ninth merged."""
    df = source(spark, d).withColumn("name_parsed", c("name"))
    q = review.queue(df, F.expr(TS) + F.make_dt_interval((c("record_id") % 50).cast("int")))
    act = F.when(c("id") % 4 == 0, "approve").when(c("id") % 7 == 0, "reject").when(c("id") % 9 == 0, "merge")
    made = q.select("id", act.alias("action"), F.concat(F.lit("rev"), (c("id") % 3).cast("string")).alias("reviewed_by"), (F.expr(TS) + F.make_dt_interval((c("id") % 90).cast("int"))).alias("reviewed_date"), F.lit("ok").alias("notes"), (c("id") * 10).alias("cluster_id"))
    return review.apply_decisions(q, made.filter("action is not null"))


_HITS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(upper(name), {O.q(rf'\b{k}\b')}) THEN {O.q(k)} END" for k in V.REVIEW_KEYWORDS) + "], lambda k: k IS NOT NULL)"
Q_CTE = f"""{CTE}, q AS (SELECT record_id AS id, name AS name_parsed, address, city, state, phone, array_to_string(h, ',') AS review_keywords, {TS} + to_days((record_id % 50)::INT) AS flagged_date,
  CASE WHEN record_id % 4 = 0 THEN 'approved' WHEN record_id % 7 = 0 THEN 'rejected' WHEN record_id % 9 = 0 THEN 'merged' ELSE 'pending' END AS review_status,
  CASE WHEN record_id % 4 = 0 OR record_id % 7 = 0 OR record_id % 9 = 0 THEN 'rev' || (record_id % 3) END AS reviewed_by,
  CASE WHEN record_id % 4 = 0 OR record_id % 7 = 0 OR record_id % 9 = 0 THEN {TS} + to_days((record_id % 90)::INT) END AS reviewed_date,
  CASE WHEN record_id % 4 <> 0 AND record_id % 7 <> 0 AND record_id % 9 = 0 THEN record_id * 10 END AS merge_with_cluster_id FROM (SELECT *, {_HITS} AS h FROM ba) WHERE len(h) > 0)"""
query("r01_pending", f"{Q_CTE} SELECT id, review_keywords, CASE WHEN trim(address) = '' THEN 'No' ELSE 'Yes' END AS has_address, CASE WHEN trim(phone) = '' THEN 'No' ELSE 'Yes' END AS has_phone FROM q WHERE review_status = 'pending'")(
    lambda spark, d: review.pending(queue(spark, d)).select("id", "review_keywords", "has_address", "has_phone")
)
query("r02_by_keyword", f"{Q_CTE} SELECT id FROM q WHERE review_status = 'pending' AND contains(review_keywords, 'TRUST')")(lambda spark, d: review.by_keyword(queue(spark, d), "TRUST").select("id"))
query("r03_decisions", f"{Q_CTE} SELECT id, review_status, reviewed_by, merge_with_cluster_id FROM q")(lambda spark, d: queue(spark, d).select("id", "review_status", "reviewed_by", "merge_with_cluster_id"))
query("r04_status_stats", f"{Q_CTE} SELECT review_status, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM q), 1) AS percentage FROM q GROUP BY 1")(lambda spark, d: review.status_stats(queue(spark, d)))
query("a07_keyword_stats", f"{Q_CTE} SELECT review_keywords, count(*) AS pending_count FROM q WHERE review_status = 'pending' GROUP BY 1")(lambda spark, d: review.keyword_stats(queue(spark, d)))
query("a07_reviewer_stats", f"{Q_CTE} SELECT reviewed_by, count(*) AS reviews_completed, min(reviewed_date) AS first_review, max(reviewed_date) AS last_review FROM q WHERE review_status <> 'pending' GROUP BY 1")(lambda spark, d: review.reviewer_stats(queue(spark, d)))
query("a20_keyword_breakdown", f"{Q_CTE} SELECT keyword, count(*) AS n FROM q JOIN (VALUES ('TRUST'), ('ESTATE'), ('DEPT')) AS k(keyword) ON contains(review_keywords, keyword) WHERE review_status = 'pending' GROUP BY 1")(
    lambda spark, d: review.keyword_breakdown(queue(spark, d), ["TRUST", "ESTATE", "DEPT"])
)
query("a20_keyword_breakdown_all", f"{Q_CTE} SELECT keyword, count(*) AS n FROM q JOIN (VALUES {', '.join(f'({O.q(k)})' for k in V.REVIEW_KEYWORDS)}) AS k(keyword) ON contains(review_keywords, keyword) WHERE review_status = 'pending' GROUP BY 1")(
    lambda spark, d: review.keyword_breakdown(queue(spark, d), V.REVIEW_KEYWORDS)
)
query("a12_review_duplicates", f"{Q_CTE} SELECT name_parsed, count(*) AS duplicate_count, string_agg(id::VARCHAR, ',' ORDER BY id) AS review_ids, string_agg(city || ', ' || state, ',' ORDER BY id) AS locations FROM q WHERE review_status = 'pending' GROUP BY 1 HAVING count(*) > 1")(lambda spark, d: review.duplicates(queue(spark, d)))
query("a21_review_counters", f"{Q_CTE} SELECT count(*) AS total, {', '.join(f"count(*) FILTER (review_status = '{s}') AS {s}" for s in ('pending', 'approved', 'rejected', 'merged'))} FROM q")(lambda spark, d: review.counters(queue(spark, d)))
query("r05_search", f"{Q_CTE} SELECT id FROM q WHERE review_status = 'pending' AND name_parsed ILIKE '%smith%' AND (city ILIKE '%o%' OR state = 'TX')")(lambda spark, d: review.search(queue(spark, d), "smith").filter(c("city").ilike("%o%") | (c("state") == "TX")).select("id"))
query("r06_without_contact", f"{Q_CTE} SELECT id FROM q WHERE review_status = 'pending' AND trim(address) = '' AND trim(phone) = ''")(lambda spark, d: review.without_contact(queue(spark, d)).select("id"))
query("r07_purge", f"{Q_CTE} SELECT id FROM q WHERE NOT (review_status <> 'pending' AND coalesce(reviewed_date < {TS} + to_days(60) - to_days(30), false))")(lambda spark, d: review.purge(queue(spark, d), F.expr(f"{TS} + INTERVAL 60 DAYS")).select("id"))
query("l02_page", f"{Q_CTE} SELECT id FROM q WHERE review_status = 'pending' ORDER BY flagged_date DESC, id LIMIT 10 OFFSET 5")(lambda spark, d: review.page(queue(spark, d), 10, 5).select("id"))
query("l03_oldest", f"{Q_CTE} SELECT id, flagged_date FROM q WHERE review_status = 'pending' ORDER BY flagged_date, id LIMIT 50")(lambda spark, d: review.oldest(queue(spark, d)).select("id", "flagged_date"))

# ---- Merge history -------------------------------------------------------------------------------------------------------


def merges(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    x = clustered(spark, d).select("record_id", "cluster_id", "name", "city", "similarity_score")
    ops, versions, links = versioning.record_merges(x, S.first_record(x.filter("cluster_id <> -1")), "ann", F.expr(TS))
    return ops.withColumn("operation_timestamp", F.expr(TS) + F.make_dt_interval((c("operation_id") % 40).cast("int"))), versions, links


OPS = f"""{CL_CTE}, o AS (SELECT row_number() OVER (ORDER BY cluster_id) AS operation_id, cluster_id, count(*) AS record_count, cluster_id AS golden_record_id FROM cl WHERE cluster_id <> -1 GROUP BY cluster_id),
  ops AS (SELECT *, {TS} + to_days((operation_id % 40)::INT) AS operation_timestamp FROM o), links AS (SELECT operation_id, record_id, cluster_id FROM cl JOIN o USING (cluster_id))"""
query("v01_merge_operations", f"{OPS} SELECT operation_id, cluster_id, record_count, golden_record_id FROM ops")(lambda spark, d: merges(spark, d)[0].select("operation_id", "cluster_id", "record_count", "golden_record_id"))
query("v01_version_counts", f"{OPS} SELECT operation_id, count(*) + 1 AS n FROM links GROUP BY 1")(lambda spark, d: merges(spark, d)[1].groupBy("operation_id").agg(F.count(F.lit(1)).alias("n")))
_SCHEMA = "record_id bigint, cluster_id bigint, name string, city string, similarity_score double"
query("v02_undo_restores", f"{OPS} SELECT cl.record_id, cl.name, cl.city FROM cl JOIN ops USING (cluster_id) WHERE operation_id % 3 = 0")(
    lambda spark, d: (lambda m: versioning.undo(m[0], m[1], c("operation_id") % 3 == 0, "bob", F.expr(TS), _SCHEMA)[1].select("record_id", "name", "city"))(merges(spark, d))
)


@query("v02_undo_state", f"{OPS} SELECT operation_id, operation_id % 3 = 0 AS is_undone FROM ops")
def _(spark, d):
    ops, versions, _ = merges(spark, d)
    made, _ = versioning.undo(ops, versions, c("operation_id") % 3 == 0, "bob", F.expr(TS), _SCHEMA)
    return versioning.with_state(ops.unionByName(made)).filter("operation_type <> 'undo'").select("operation_id", "is_undone")


query("v03_history", f"{OPS} SELECT operation_id, cluster_id FROM ops ORDER BY operation_timestamp DESC, operation_id DESC LIMIT 25")(lambda spark, d: (lambda m: versioning.history(m[0], m[2], limit=25).select("operation_id", "cluster_id"))(merges(spark, d)))
query("v04_rollback", f"{OPS} SELECT operation_id AS undoes FROM ops WHERE operation_timestamp > {TS} + to_days(20)")(
    lambda spark, d: (lambda m: versioning.rollback(m[0], m[1], F.expr(f"{TS} + INTERVAL 20 DAYS"), "bob", F.expr(TS), _SCHEMA)[0].select("undoes"))(merges(spark, d))
)
query("v05_compare_versions", f"{OPS} SELECT record_id, 'city' AS field, city AS old_value, upper(city) AS new_value FROM cl JOIN o USING (cluster_id) WHERE city <> upper(city)")(
    lambda spark, d: (lambda v: versioning.compare_versions(v, v.withColumn("record_data", F.to_json(F.struct(*(F.upper(f"r.{n}").alias(n) if n == "city" else c(f"r.{n}") for n in ("record_id", "cluster_id", "name", "city", "similarity_score")))))))(
        merges(spark, d)[1].filter("version_type = 'before_merge'").withColumn("r", F.from_json("record_data", _SCHEMA))
    )
)
query("v06_audit_trail", f"{OPS} SELECT ops.operation_id, count(DISTINCT record_id) AS affected_records FROM ops LEFT JOIN links USING (operation_id) WHERE operation_timestamp >= {TS} + to_days(5) AND operation_timestamp <= {TS} + to_days(30) GROUP BY 1")(
    lambda spark, d: (lambda m: versioning.audit_trail(m[0], m[2], F.expr(f"{TS} + INTERVAL 5 DAYS"), F.expr(f"{TS} + INTERVAL 30 DAYS"), "ann").select("operation_id", "affected_records"))(merges(spark, d))
)

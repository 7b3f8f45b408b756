"""Source records against a reference master with the same SSN."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import compare as C
from ..functions import master as M
from ..functions import values as V
from ..functions.similarity import jaro_winkler_udf, score_distinct
from ..functions.text import safe, scrub_newlines, squeeze
from ..session import materialize

#: Pairs that one SSN's source rows of a part make, about.
PART = 1 << 22


def load_master(associates: DataFrame, addresses: DataFrame) -> DataFrame:
    """The master view: tax-info associates joined with their business addresses, newlines scrubbed, by clean SSN."""
    a = associates.filter("ATT_TYPE = 'TaxInfo'").select("BUS_ASSOC_CODE", F.col("SSN").alias("ssn"))
    b = addresses.filter("HDRTYPECODE = 'BusAssoc'")
    out = a.join(b, F.col("BUS_ASSOC_CODE") == F.col("HDRCODE"))
    return out.withColumns({c: scrub_newlines(F.col(c)) for c, t in out.dtypes if t == "string"}).withColumn("ssn_clean", M.clean_ssn(F.col("ssn")))


def candidates(source: DataFrame, master: DataFrame) -> DataFrame:
    """Source rows with every master row of their SSN: ssn_status NO_SSN, SSN_NOT_FOUND or MATCHED, and match_count.

    An invalid SSN has a null key, so it meets nothing. Master rows carry the prefix m_. Source rows of an SSN with many
    pairs are dealt to parts by a hash of record_id, each of which meets the SSN's master rows, so that pairs are made
    in many tasks however few SSNs, or bytes, there are."""
    key = F.when(M.clean_ssn(F.col("ssn")) != "", M.clean_ssn(F.col("ssn")))
    s = source.withColumn("ssn_clean", key)
    m = master.withColumn("m_key", M.clean_ssn(F.col("ssn"))).filter("m_key <> ''")
    m = m.select("m_key", *(F.col(c).alias(f"m_{c}") for c in master.columns))
    held = s.filter("ssn_clean is not null").groupBy(F.col("ssn_clean").alias("n_key")).agg(F.count(F.lit(1)).alias("n_rows"))
    sizes = m.groupBy(F.col("m_key").alias("n_key")).agg(F.count(F.lit(1)).alias("match_count")).join(held, "n_key")
    pairs = F.col("n_rows") * F.col("match_count")
    sizes = materialize(sizes.select("n_key", "match_count", pairs.alias("n_pairs"), F.ceil(pairs / PART).alias("parts")), "sizes")
    total, parts = sizes.agg(F.coalesce(F.sum("n_pairs"), F.lit(0)), F.coalesce(F.sum("parts"), F.lit(0))).first()
    tasks = int(max(1, total // (2 * PART), min(parts, source.sparkSession.sparkContext.defaultParallelism)))
    of = sizes.select("n_key", "match_count", "parts")
    left = s.join(of, s.ssn_clean == of.n_key, "left")
    names = [f"m_{c}" for c in master.columns]
    status = F.when(F.col("ssn_clean").isNull(), "NO_SSN").otherwise("SSN_NOT_FOUND")
    lone = left.filter("n_key is null").select(*s.columns, *(F.lit(None).cast(m.schema[c].dataType).alias(c) for c in names), F.lit(0).cast("long").alias("match_count"), status.alias("ssn_status"))
    dealt = left.filter("n_key is not null").withColumn("part", F.pmod(F.xxhash64("record_id"), "parts")).repartition(tasks, "n_key", "part")
    copies = m.join(of.select("n_key", "parts"), F.col("m_key") == F.col("n_key")).select("n_key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), *names)
    met = dealt.drop("parts").join(copies, ["n_key", "part"])
    return met.select(*s.columns, *names, "match_count", F.lit("MATCHED").alias("ssn_status")).unionByName(lone)


def features(df: DataFrame, prefix: str, gate: str = "") -> DataFrame:
    """``df`` with all that the matcher reads of one side: address features, normalized names (the name, those in the address,
    the contact), what normalizing changed, the quality gate and the trust flag. Each different text is normalized once."""
    p = lambda n: f"{prefix}_{n}"
    t = F.col("text")
    texts = {
        "address": lambda x: C.address_texts(x, "text", prefix).withColumn(p("names"), F.transform(M.names_in_address(t), lambda n: M.normalize_name(n))).withColumn("__trust_address", M.is_trust(F.lit(""), t)),
        "name": lambda x: x.withColumns({p("name"): M.normalize_name(t), p("detail"): M.normalization_detail(t), "__trust_name": M.is_trust(t, F.lit(""))}),
        "contact_person": lambda x: x.withColumn(p("contact"), F.array_compact(F.array(F.when(safe(t) != "", M.normalize_name(t))))),
    }
    out = df.withColumns({p("city"): M.normalize_city(F.col("city")), p("zip"): M.normalize_zip(F.col("zip"))})
    for column, add in texts.items():
        distinct = df.select(F.col(column).alias("text")).distinct().repartition(df.sparkSession.sparkContext.defaultParallelism)
        out = out.join(materialize(add(distinct), column), F.col(column).eqNullSafe(F.col("text"))).drop("text")
    held = M.quality_gate(*(F.col(x) for x in ("name", "address", "city", "state", "zip")), prefix=gate)
    return out.withColumns({p("gate"): held, p("trust"): F.col("__trust_name") | F.col("__trust_address")}).drop("__trust_name", "__trust_address")


def _who(prefix: str) -> Column:
    """All that the names of one side say, as one text."""
    return F.to_json(F.struct(F.col(f"{prefix}_name").alias("name"), F.col(f"{prefix}_names").alias("names"), F.col(f"{prefix}_contact").alias("contact")))


_WHO = "struct<name:string,names:array<string>,contact:array<string>>"


def _boost(df: DataFrame) -> DataFrame:
    """Adds name_rule, name_score and name_boost_source by s_who and m_f_who: where the plain comparison stays below 0.95,
    names in the address fields and the master's contact may raise it, to 0.95 at most; of equal scores the first source
    in order counts. Names that meet often are compared once."""

    def cross(what: str, left: Column, right: Column) -> Column:
        return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.struct(F.lit(what).alias("what"), a.alias("a"), b.alias("b")))))

    both = ["s_who", "m_f_who"]
    met = materialize(df.select(*both).distinct(), "met").withColumns({"s": F.from_json("s_who", _WHO), "m": F.from_json("m_f_who", _WHO)})
    name, others = F.array("s.name"), F.col("s.names")
    master, contact, m_names = F.array("m.name"), F.col("m.contact"), F.col("m.names")
    tries = F.concat(
        cross("PRIMARY", name, master), cross("DEC_CONTACT", name, contact), cross("SOURCE_ADDR_NAME", others, master), cross("SOURCE_ADDR+DEC_CONTACT", others, contact),
        cross("DEC_ADDR_NAME", name, m_names), cross("SOURCE_ADDR+DEC_ADDR", others, m_names),
    )
    rows = materialize(met.select(*both, F.posexplode(tries)).select(*both, "pos", "col.what", "col.a", "col.b"), "names")
    rows = score_distinct(rows, "a", "b", C.name_compare, "r").withColumn("s", F.col("r.name_score"))
    primary = F.max(F.when(F.col("what") == "PRIMARY", F.col("s")))
    rule = F.max(F.when(F.col("what") == "PRIMARY", F.col("r.rule"))).alias("name_rule")
    got = rows.groupBy(*both).agg(rule, primary.alias("p"), F.max_by(F.struct("what"), F.struct(F.when(F.col("what") != "PRIMARY", F.least("s", F.lit(0.95))), -F.col("pos"))).alias("w"), F.max(F.when(F.col("what") != "PRIMARY", F.least("s", F.lit(0.95)))).alias("x"))
    lifted = (F.col("p") < 0.95) & (F.col("x") > F.col("p"))
    got = got.select(*both, "name_rule", F.when(lifted, F.col("x")).otherwise(F.col("p")).alias("name_score"), F.when(lifted, F.col("w.what")).alias("name_boost_source"))
    return df.join(materialize(got, "named"), both)


def deciding(s: DataFrame, m: DataFrame) -> DataFrame:
    """The pairs that decide a source row with a master row of its SSN: those whose addresses a rule weighs, and the one with
    the SSN's first master row. Any other pair scores 0 and comes after that one, so it is neither the best nor a possible
    match, and an SSN of many rows on both sides does not give all their pairs. Columns are those of ``candidates``."""
    key = lambda: F.when(M.clean_ssn(F.col("ssn")) != "", M.clean_ssn(F.col("ssn")))
    m = m.withColumn("m_key", key()).filter("m_key is not null")
    first = m.groupBy("m_key").agg(F.count(F.lit(1)).alias("match_count"), F.min("record_id").alias("first_id"))
    s = s.withColumn("ssn_clean", key()).join(first, F.col("ssn_clean") == F.col("m_key")).drop("m_key").withColumn("s_meets", C.meeting_key("s"))
    m = m.withColumn("m_meets", C.meeting_key("f")).select("m_key", "m_meets", *(F.col(c).alias(f"m_{c}") for c in m.columns if c != "m_key"))
    weighed = s.join(m, (s.ssn_clean == m.m_key) & (s.s_meets == m.m_meets) & (s.first_id != m.m_record_id))
    return weighed.unionByName(s.join(m, s.first_id == m.m_record_id)).drop("m_key", "m_meets", "s_meets", "first_id")


def match(source: DataFrame, master: DataFrame, buckets=V.BUCKETS) -> DataFrame:
    """One row for each source record: its best master row (largest address score, the first id of ties) with scores
    in steps of five, the composite score, the trust flag and the recommendation.

    ``source`` and ``master`` have record_id, name, address, city, state, zip, contact_person and ssn."""
    fields = ["record_id", "name", "address", "city", "state", "zip", "contact_person", "ssn"]
    source, master = source.select(*fields), master.select(*fields)
    s, m = materialize(features(source, "s"), "source"), materialize(features(master, "f", "DEC_"), "master")
    # Pairs carry what the address rules read and who their rows name; the other columns join the best pair.
    late = {"s": [*fields[1:-1], "s_name", "s_names", "s_contact", "s_detail", "s_gate", "s_trust"], "f": [*fields[1:-1], "f_name", "f_names", "f_contact", "f_detail", "f_gate", "f_trust"]}
    met = deciding(s.withColumn("s_who", _who("s")).drop(*late["s"]), m.withColumn("f_who", _who("f")).drop(*late["f"]))
    met = C.compare_addresses(met, "s", "m_f").withColumn("a100", M.round5(F.col("address_score") * 100))
    met = met.select("record_id", "m_record_id", "match_count", "s_who", "m_f_who", "address_score", "address_reason", "a100")
    best = F.row_number().over(Window.partitionBy("record_id").orderBy(F.desc("address_score"), "m_record_id"))
    # Names count only for the best row and for rows whose address is good enough for a possible match.
    met = _boost(materialize(met.withColumn("r", best).filter("r = 1 OR a100 > 84"), "compared")).withColumn("n100", M.round5(F.col("name_score") * 100))
    found = met.groupBy("record_id").agg(F.count_if((F.col("n100") > 94) & (F.col("a100") > 84)).alias("possible_address_matches"))
    met = met.filter("r = 1").join(found, "record_id").withColumn("ssn_status", F.lit("MATCHED")).join(s.select(*[c for c in s.columns if c not in met.columns or c == "record_id"]), "record_id")
    met = met.join(m.select(F.col("record_id").alias("m_record_id"), *(F.col(x).alias(f"m_{x}") for x in m.columns if x != "record_id")), "m_record_id")
    trust = F.col("s_trust")
    gate = F.coalesce("s_gate", "m_f_gate", F.when(F.col("address_reason") == "UNKNOWN_ADDRESS", "UNKNOWN_ADDRESS"))
    as_is = lambda c, normal: F.when(trust, squeeze(F.upper(safe(F.col(c))))).otherwise(F.col(normal))
    combo = lambda p, q, name, address: F.concat_ws(" ", name, address, F.col(f"{q}_city"), F.upper(safe(F.col(f"{p}state"))), F.col(f"{q}_zip"))
    met = materialize(met.withColumns({"ca": combo("", "s", as_is("name", "s_name"), as_is("address", "s_addr")), "cb": combo("m_", "m_f", F.col("m_f_name"), F.col("m_f_addr"))}), "best")
    met = met.withColumn("nameaddrscore", M.round5(jaro_winkler_udf("ca", "cb") * 100))
    met = met.withColumns({
        "name_ambiguous": M.ambiguous_name(F.col("n100"), F.lit(100.0)),
        "address_ambiguous": M.ambiguous_address(F.col("a100"), F.col("s_zip"), F.col("m_f_zip"), F.array_sort("s_nums"), F.array_sort("m_f_nums")),
        "name_norm_detail": M.audit_detail(F.col("s_detail"), F.col("m_f_detail")),
        "name_match_detail": M.boost_detail(F.col("name_rule"), F.col("name_boost_source"), F.col("name_score")),
    })
    met = met.withColumns({"review_reason": gate, "is_trust": (trust | F.col("m_f_trust")).cast("int")})
    verdict = F.when(F.col("review_reason").isNotNull(), V.NEEDS_REVIEW).otherwise(M.classify(F.col("n100"), F.col("a100"), buckets))
    best = met.select(
        "record_id", "ssn_status", "match_count", F.col("m_record_id").alias("master_id"), F.lit(100.0).alias("ssn_match"), F.col("n100").alias("name_score"), F.col("a100").alias("address_score"),
        "address_reason", "name_boost_source", "nameaddrscore", "possible_address_matches", "review_reason", "is_trust", verdict.alias("recommendation"), M.mask_ssn(F.col("ssn")).alias("ssn_masked"), "name", "state", "m_name", "name_ambiguous", "address_ambiguous", "name_norm_detail", "name_match_detail",
    )
    rest = candidates(s, m.select("ssn").distinct()).filter("ssn_status <> 'MATCHED'")
    gate = F.col("s_gate")
    zero = F.lit(0.0)
    alone = rest.select(
        "record_id", "ssn_status", "match_count", F.lit(None).cast("long").alias("master_id"), zero.alias("ssn_match"), zero.alias("name_score"), zero.alias("address_score"),
        F.col("ssn_status").alias("address_reason"), F.lit(None).cast("string").alias("name_boost_source"), F.lit(None).cast("double").alias("nameaddrscore"), F.lit(0).cast("long").alias("possible_address_matches"),
        gate.alias("review_reason"), F.col("s_trust").cast("int").alias("is_trust"),
        F.when(gate.isNotNull() | (F.col("ssn_status") == "NO_SSN"), V.NEEDS_REVIEW).otherwise(M.classify(zero, zero, buckets)).alias("recommendation"), M.mask_ssn(F.col("ssn")).alias("ssn_masked"), "name", "state", F.lit("").alias("m_name"),
        F.lit(False).alias("name_ambiguous"), F.lit(False).alias("address_ambiguous"), F.lit("").alias("name_norm_detail"), F.lit("").alias("name_match_detail"),
    )
    return best.unionByName(alone)


def override_scores(results: DataFrame, judged: DataFrame, buckets=V.BUCKETS) -> DataFrame:
    """Name scores replaced by a judge's (record_id, score 0 to 100), and the recommendation decided anew for rows
    that no quality gate holds."""
    out = results.join(judged.select("record_id", M.round5(F.col("score")).alias("__j")), "record_id", "left")
    out = out.withColumns({"score_changed": M.score_changed(F.col("name_score"), F.col("__j")), "name_score": F.coalesce("__j", "name_score")})
    again = F.when(F.col("review_reason").isNull() & F.col("__j").isNotNull(), M.classify(F.col("name_score"), F.col("address_score"), buckets)).otherwise(F.col("recommendation"))
    return out.withColumn("recommendation", again).drop("__j")


def judge_names(results: DataFrame, judge, buckets=V.BUCKETS) -> DataFrame:
    """The ambiguous names go to an outside judge (pandas batches of record_id, name, m_name in; record_id, score out);
    its scores override."""
    asked = results.filter("name_ambiguous").select("record_id", "name", "m_name")
    return override_scores(results, materialize(asked.mapInPandas(judge, "record_id bigint, score double"), "judged"), buckets)


ADDRESS = ["address", "city", "state", "zip"]


def validate_addresses(df: DataFrame, validator) -> DataFrame:
    """``df`` with its addresses as an outside service writes them. The service (pandas batches of address, city, state,
    zip in; the same and new_address, new_city, new_state, new_zip out) sees each different address once."""
    distinct = df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ADDRESS)).distinct()
    told = distinct.mapInPandas(validator, ", ".join(f"{c} string" for c in [*ADDRESS, *(f"new_{c}" for c in ADDRESS)]))
    told = materialize(told, "validated")
    keys = [F.coalesce(df[c], F.lit("")) == told[c] for c in ADDRESS]
    out = df.join(told, keys, "left").select(*(F.coalesce(told[f"new_{c}"], df[c]).alias(c) if c in ADDRESS else df[c] for c in df.columns))
    return out

"""Queries for the scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import labels as L
from ..functions import master as M
from ..functions import records as R
from ..functions import text as T
from ..functions import values as V
from ..session import materialize
from . import oracle as O
from .people import CTE, source
from .registry import query

c = F.col


def scalar(name: str, column, sql: str | None, out: str = "value"):
    """One query over the derived records: record_id and one computed column."""
    query(name, f"{CTE} SELECT record_id, {sql} AS {out} FROM ba" if sql else None)(
        lambda spark, d: source(spark, d).select("record_id", column().alias(out))
    )


scalar("f01_safe_str", lambda: T.safe(F.concat(F.lit("  "), c("name"), F.lit("\t "))), O.safe("'  ' || name || chr(9) || ' '"))
scalar("f02_normalize_string", lambda: T.normalize_string(F.concat(F.lit(" "), c("name"), F.lit("  X "))), O.squeeze(f"lower({O.safe("' ' || name || '  X '")})"))
scalar("f03_normalize_address", lambda: R.normalize_address(c("address")), O.squeeze(O.sub(O.chain(O.squeeze(f"lower({O.safe('address')})"), V.PIPELINE_ADDRESS_RULES), r"[^\w\s\-]", "")))
scalar("f04_normalize_phone", lambda: R.normalize_phone(c("phone")), O.digits("phone"))
scalar("f05_normalize_zip", lambda: R.normalize_zip(c("zip")), f"substr({O.digits('zip')}, 1, 5)")
_SUFFIX = lambda x: f"coalesce({O.table(f"replace(lower({O.safe(x)}), '.', '')", V.GENERATIONS)}, replace(lower({O.safe(x)}), '.', ''))"
scalar("f06_normalize_suffix", lambda: R.normalize_suffix(F.element_at(F.split("name", " "), -1)), _SUFFIX("string_split(name, ' ')[-1]"))
_BARE = lambda x: f"regexp_replace(lower({x}), '[.,]', '', 'g')"
_TITLED = f"""SELECT record_id, name, l, len(l) AS n, {O.inside(_BARE("coalesce(l[1], '')"), V.TITLES)} AS t1,
  len(l) > 1 AND {O.inside(_BARE("coalesce(l[-1], '')"), V.TITLES)} AS t2 FROM (SELECT record_id, {O.safe('name')} AS name, {O.words('name')} AS l FROM ba)"""
_SPLIT = f"""SELECT record_id, name, CASE WHEN t1 THEN array_to_string(l[2:], ' ') WHEN t2 THEN array_to_string(l[1:n - 1], ' ') ELSE name END AS rest,
  CASE WHEN t1 THEN l[1] WHEN t2 THEN l[-1] ELSE '' END AS title FROM ({_TITLED})"""
query("f07_remove_title", f"{CTE} SELECT record_id, rest, title FROM ({_SPLIT})")(
    lambda spark, d: source(spark, d).select("record_id", R.remove_title(c("name")).alias("t")).select("record_id", "t.rest", "t.title")
)
_ANY = lambda x, marks: "(" + " OR ".join(f"contains({x}, {O.q(m)})" for m in marks) + ")"
_TYPE = lambda x: f"CASE WHEN {_ANY(f'lower({x})', V.TRUST_MARKS)} THEN 'trust' WHEN {_ANY(f'lower({x})', V.DEPARTMENT_MARKS)} THEN 'department' WHEN {_ANY(f'lower({x})', V.BUSINESS_MARKS)} THEN 'business' ELSE 'individual' END"
scalar("f08_entity_type", lambda: R.entity_type(c("name")), _TYPE("name"))


def _dept(x: str) -> str:
    out = f"lower({x})"
    for mark in reversed(V.DEPARTMENT_MARKS):
        at = f"list_position(list_transform({O.words(f'lower({x})')}, lambda t: contains(t, {O.q(mark)})), true)"
        out = f"CASE WHEN coalesce({at}, 0) = 1 THEN {O.q(mark)} WHEN coalesce({at}, 0) > 1 THEN ({O.words(f'lower({x})')})[{at} - 1] ELSE {out} END"
    return out


query("f09_department_name", f"{CTE} SELECT record_id, {_dept('name')} AS value FROM ba WHERE {_TYPE('name')} = 'department'")(
    lambda spark, d: source(spark, d).filter(R.entity_type(c("name")) == "department").select("record_id", R.department_name(c("name")).alias("value"))
)


def _trust_name(x: str) -> str:
    out = f"lower({x})"
    for mark in V.TRUST_MARKS:
        out = f"trim(replace({out}, {O.q(mark)}, ''))"
    return out


scalar("f10_trust_name", lambda: R.trust_name(c("name")), _trust_name("name"))
_FULL = lambda x: f"array_to_string(list_transform({O.words(f'lower({O.safe(x)})')}, lambda t: coalesce({O.table("regexp_replace(t, '[^\\w]', '', 'g')", V.PIPELINE_NICKNAMES)}, t)), ' ')"
scalar("f11_full_names", lambda: R.with_full_names(c("name")), _FULL("name"))
_FORMS = sorted(set(V.GENERATIONS.values()))
_PARSED = f"""SELECT record_id, title, coalesce(p[1], '') AS first,
  CASE WHEN n < 3 THEN '' WHEN n = 3 THEN CASE WHEN s THEN '' ELSE p[2] END ELSE array_to_string(p[2:n - CASE WHEN s THEN 2 ELSE 1 END], ' ') END AS middle,
  CASE WHEN n < 2 THEN '' WHEN s THEN p[-2] ELSE p[-1] END AS last, CASE WHEN s THEN p[-1] ELSE '' END AS suffix
  FROM (SELECT record_id, title, p, len(p) AS n, (len(p) = 3 AND {O.inside(_SUFFIX("coalesce(p[-1], '')"), _FORMS)})
    OR (len(p) >= 4 AND {O.inside(_BARE("coalesce(p[-1], '')"), sorted({*V.GENERATIONS, *_FORMS}))}) AS s FROM (SELECT record_id, title, {O.words('rest')} AS p FROM ({_SPLIT})))"""
query("f12_parse_name", f"{CTE} {_PARSED}")(
    lambda spark, d: source(spark, d).select("record_id", R.parse_name(c("name")).alias("p")).select("record_id", "p.title", "p.first", "p.middle", "p.last", "p.suffix")
)
scalar("f13_normalize_name_master", lambda: M.normalize_name(c("name")), O.master_name("name"))
scalar("f15_normalize_city", lambda: M.normalize_city(c("city")), O.squeeze(O.sub(O.sub(f"upper({O.safe('city')})", r"[^A-Z0-9\s]", " "), r"\bFT\b", "FORT")))
_ZIP = lambda x: f"CASE WHEN length({O.digits(x)}) >= 4 THEN lpad(substr({O.digits(x)}, 1, 5), 5, '0') ELSE {O.digits(x)} END"
scalar("f16_normalize_zip_master", lambda: M.normalize_zip(c("zip")), _ZIP("zip"))
scalar("f17_compact_alnum", lambda: T.compact_alnum(c("name")), O.sub("upper(coalesce(name, ''))", "[^A-Z0-9]", ""))
_CANON = lambda t: f"coalesce({O.table(t, V.NICKNAMES)}, {O.table(t, V.NUMBER_WORDS)}, {O.table(t, V.STATES)}, {t})"
scalar("f18_canonical_tokens", lambda: F.array_join(F.transform(T.tokens(F.upper("name")), M.canonical_token), " "), f"array_to_string(list_transform({O.words('upper(name)')}, lambda t: {_CANON('t')}), ' ')")


def _address(x: str) -> str:
    """Without the one rule that needs lookahead, which the derived records never meet."""
    a = f"upper({O.safe(x)})"
    a = O.sub(a, r"\b(?:DATED|DTD)\s+", "")
    a = O.squeeze(O.sub(O.squeeze(O.sub(a, V.WORD_DATES, " ")), V.NUMBER_DATES, " "))
    a = O.sub(a, r"\b(\d+)-(\d+(?:ST|ND|RD|TH)\b)", r"\1 \2")
    a = O.chain(a, [r for r in V.PO_BOX_RULES if "(?!" not in r[0]] + V.COUNTY_ROADS + [(rf"\b{w}\b", r) for w, r in V.STREET_WORDS])
    a = O.sub(O.sub(a, V.NUMBER_SIGN, r"APT \1"), r"[.,\-]", "")
    return a


_LEAD = f"""SELECT record_id, a, regexp_extract(a, '^(.*?)\\b\\d+\\s+[A-Z]', 1) AS lead,
  regexp_matches(a, '\\b\\d+\\s+[A-Z]') AND NOT regexp_matches(a, '^\\s*\\d') AND NOT contains(a, 'PO BOX') AS has FROM (SELECT record_id, {_address('address')} AS a FROM ba)"""
_ADDR = f"""SELECT record_id, {O.squeeze(f"CASE WHEN has AND NOT {O.inside(f"coalesce(({O.words('lead')})[-1], '')", V.ADDRESS_STARTS)} THEN substr(a, length(lead) + 1) ELSE a END")} AS value FROM ({_LEAD})"""
query("f14_normalize_address_master", f"{CTE} {_ADDR}")(lambda spark, d: source(spark, d).select("record_id", M.normalize_address(c("address")).alias("value")))


def over_address(name: str, column, sql: str):
    query(name, f"{CTE}, n AS ({_ADDR}) SELECT record_id, {sql} AS value FROM n")(
        lambda spark, d: source(spark, d).select("record_id", M.normalize_address(c("address")).alias("a")).select("record_id", column(c("a")).alias("value"))
    )


over_address("f19_house_number", M.house_number, r"regexp_extract(value, '^\s*(\d+)\b', 1)")
_BOX = r"upper(regexp_extract(value, '\bPO\s*BOX\s*([A-Z0-9]+)\b', 1))"
over_address("f20_po_box_number", M.po_box_number, f"CASE WHEN regexp_matches(value, '\\bPO\\s*BOX\\b') THEN coalesce({O.table(_BOX, V.NUMBER_WORDS)}, {_BOX}) ELSE '' END")
_CORE = O.sub(O.sub(O.sub("value", r"^\s*\d+\s+", ""), r"\b(APT|STE|UNIT|BLDG|FL|RM)\b\s*\w+", " "), r"[^A-Z0-9\s]", " ")
over_address("f21_street_core", M.street_core, f"array_to_string(list_filter({O.words(_CORE)}, lambda t: NOT {O.inside('t', V.STREET_TYPES + V.DIRECTIONS + V.UNITS)}), ' ')")
over_address("f22_address_numbers", lambda a: F.array_join(M.address_numbers(a), ","), f"array_to_string(list_sort(list_distinct(regexp_extract_all({O.sub('value', V.ANY_DATES, ' ')}, '\\d{{2,}}'))), ',')")


def _named(p: str) -> str:
    return f"trim({O.sub(O.sub(f'trim(regexp_extract(upper({O.safe('address')}), {O.q(p)}, 1))', ',+$', ''), V.ROLES, '')})"


scalar("f23_names_in_address", lambda: F.array_join(M.names_in_address(c("address")), "|"), f"array_to_string(list_filter([{_named(V.CARE_OF)}, {_named(V.ATTENTION)}], lambda n: length(n) >= 3), '|')")
scalar("f25_strip_control", lambda: T.strip_control(F.concat(c("name"), F.lit("\x07\x9f!"))), "name || '!'")
scalar("f26_scrub_newlines", lambda: T.scrub_newlines(F.concat(c("name"), F.lit("\r\n\n x"))), O.squeeze(O.sub("name || chr(13) || chr(10) || chr(10) || ' x'", r"[\r\n]+", " ")))
_FLIP = f"""SELECT record_id, s, CASE WHEN contains(s, ',') AND NOT ({O.inside("replace(upper(b), '.', '')", V.FLIP_SUFFIXES)} OR {_ANY('upper(a)', V.COMPANY_MARKS)} OR regexp_matches(a, '^\\d') OR length(b) <= 1)
  THEN b || ' ' || a ELSE s END AS value FROM (SELECT record_id, s, trim(regexp_extract(s, '^([^,]*)', 1)) AS a, trim(regexp_extract(s, '^[^,]*,(.*)$', 1)) AS b FROM (SELECT record_id, {O.squeeze('name')} AS s FROM ba))"""
query("f27_flip_last_first", f"{CTE} SELECT record_id, value FROM ({_FLIP})")(lambda spark, d: source(spark, d).select("record_id", K.flip_last_first(c("name")).alias("value")))
MATCH_KEY = lambda x: O.squeeze(O.chain(O.sub(f"upper(coalesce({x}, ''))", r"[^A-Z0-9\s]", ""), [(rf"\b{s}\b", "") for s in V.KEY_SUFFIXES] + [(rf"\b{a}\b", f) for a, f in V.KEY_ABBREVIATIONS]))
query("f28_match_key", f"{CTE} SELECT record_id, {MATCH_KEY('value')} AS value FROM ({_FLIP})")(
    lambda spark, d: source(spark, d).select("record_id", K.match_key(K.flip_last_first(c("name"))).alias("value"))
)
scalar("f29_email", lambda: R.email(c("email")), "CASE WHEN contains(email, '@') THEN lower(trim(email)) ELSE '' END")
scalar("f30_state", lambda: R.state(c("state")), "upper(trim(state))")
scalar("f31_phone_prefix", lambda: R.phone_prefix(c("phone")), f"CASE WHEN length({O.digits('phone')}) >= 6 THEN substr({O.digits('phone')}, 1, 6) END")
_TOKENS = O.words(O.sub(f"lower({O.safe('name')})", "[.,]", ""))
NAME_TOKEN = f"coalesce((list_filter({_TOKENS}, lambda t: length(t) >= 3 AND NOT {O.inside('t', V.SKIP_WORDS)}))[1], ({_TOKENS})[1], '')"
scalar("f32_name_token", lambda: R.name_token(c("name")), NAME_TOKEN)
_D = O.digits("ssn")
SSN_MASTER = lambda x: f"CASE WHEN length({O.digits(x)}) < 4 OR {O.digits(x)} LIKE '000%' OR {O.digits(x)} LIKE '666%' OR {O.inside(O.digits(x), V.BAD_SSNS)} THEN '' ELSE {O.digits(x)} END"
scalar("f33_clean_ssn_master", lambda: M.clean_ssn(c("ssn")), SSN_MASTER("ssn"))
scalar("f34_mask_ssn_master", lambda: M.mask_ssn(c("ssn")), f"CASE WHEN length({_D}) <= 4 THEN {_D} ELSE repeat('*', length({_D}) - 4) || right({_D}, 4) END")
SSN = f"CASE WHEN length({_D}) <> 9 OR {O.inside(_D, V.BAD_SSNS)} OR {_D} LIKE '000%' OR {_D} LIKE '666%' OR {_D} LIKE '9%' THEN '' ELSE {_D} END"
scalar("f35_clean_ssn", lambda: R.clean_ssn(c("ssn")), SSN)
SALT = "unit-salt"
scalar("f36_ssn_token", lambda: R.token_of(R.clean_ssn(c("ssn")), SALT), f"CASE WHEN {SSN} = '' THEN '' ELSE sha256({SSN} || '|{SALT}') END")
scalar("f36_ein_token", lambda: R.token_of(R.clean_ein(c("ein")), SALT), f"CASE WHEN length({O.digits('ein')}) <> 9 THEN '' ELSE sha256({O.digits('ein')} || '|{SALT}') END")
scalar("f37_mask_ssn", lambda: R.mask_ssn(c("ssn")), f"CASE WHEN {SSN} = '' THEN '' ELSE 'XXX-XX-' || right({SSN}, 4) END")
scalar("f40_word_dates", lambda: F.regexp_extract(F.upper("address"), V.WORD_DATES, 0), f"regexp_extract(upper(address), {O.q(V.WORD_DATES)}, 0)")
scalar("p08_quality_gate", lambda: M.quality_gate(*(c(x) for x in ("name", "address", "city", "state", "zip"))), f"""CASE WHEN trim(name) = '' THEN 'EMPTY_NAME' WHEN trim(address) = '' THEN 'EMPTY_ADDRESS'
  WHEN trim(city) = '' THEN 'EMPTY_CITY' WHEN trim(state) = '' THEN 'EMPTY_STATE' WHEN trim(zip) = '' THEN 'EMPTY_ZIP'
  WHEN regexp_matches(upper(trim(address)), {O.q(V.UNKNOWN_ADDRESS)}) THEN 'UNKNOWN_ADDRESS' WHEN regexp_matches(upper(trim(city)), {O.q(V.UNKNOWN_TEXT)}) THEN 'UNKNOWN_CITY'
  WHEN regexp_matches(upper(trim(name)), {O.q(V.UNKNOWN_TEXT)}) THEN 'UNKNOWN_NAME' END""")  # fmt: skip
_RULE = " ".join(f"WHEN ns BETWEEN {a} AND {b} AND ad BETWEEN {e} AND {f} THEN '{n}'" for n, a, b, e, f in V.BUCKETS)
query("p09_bucket_classify", f"{CTE} SELECT record_id, CASE {_RULE} ELSE '{V.NEEDS_REVIEW}' END AS bucket FROM (SELECT record_id, (record_id % 3) * 50 AS ns, ((record_id // 3) % 3) * 50 AS ad FROM ba)")(
    lambda spark, d: source(spark, d).select("record_id", M.classify((c("record_id") % 3) * 50, (F.floor(c("record_id") / 3) % 3) * 50).alias("bucket"))
)
scalar("p10_trust_flag", lambda: M.is_trust(c("name"), c("address")), f"regexp_matches(name, {O.q(M.trust_pattern())}) OR regexp_matches(address, {O.q(M.trust_pattern())})")
_HITS = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(upper(name), {O.q(rf'\b{k}\b')}) THEN {O.q(k)} END" for k in V.REVIEW_KEYWORDS) + "], lambda k: k IS NOT NULL)"
scalar("p11_review_keywords", lambda: F.array_join(K.review_keywords(c("name")), ","), f"array_to_string({_HITS}, ',')")
_REASON = f"coalesce({O.table('upper(trim(k))', V.REVIEW_REASONS)}, 'Contains keyword \"' || k || '\" which requires human review')"
scalar("p12_review_reason", lambda: K.review_reason(K.review_keywords(c("name"))), f"array_to_string(list_transform({_HITS}, lambda k: {_REASON}), ' | ')")
scalar("p19_score_changed", lambda: M.score_changed(c("record_id") % 37, c("record_id") % 23), "abs(record_id % 37 - record_id % 23) >= 10")
scalar("m07_round5", lambda: M.round5((c("record_id") % 101).cast("double")).cast("int"), "cast(round_even((record_id % 101) / 5.0, 0) * 5 AS INTEGER)")
scalar("m20_completeness", lambda: R.completeness(V.COMPLETENESS_FIELDS), " + ".join(f"(trim({f}) <> '')::INT" for f in V.COMPLETENESS_FIELDS))
query("f38_tokenize_pii", f"{CTE} SELECT record_id, CASE WHEN {SSN} = '' THEN '' ELSE sha256({SSN} || '|{SALT}') END AS ssn_token, CASE WHEN {SSN} = '' THEN '' ELSE 'XXX-XX-' || right({SSN}, 4) END AS ssn_masked FROM ba")(
    lambda spark, d: source(spark, d).select("record_id", R.token_of(R.clean_ssn(c("ssn")), SALT).alias("ssn_token"), R.mask_ssn(c("ssn")).alias("ssn_masked"))
)
_RAW_BOX = lambda x: f"regexp_extract({x}, {O.q('(?i)' + L.BOX)})"
_BESIDE = f"trim(trim({O.squeeze(f"regexp_replace(CASE WHEN {_RAW_BOX('raw')} <> '' THEN raw ELSE value END, {O.q('(?i)' + L.BOX)}, '')")}, '{L.EDGE}'))"
_BEFORE = f"rtrim(trim(CASE WHEN house <> '' AND strpos(raw, house) > 1 THEN substr(raw, 1, strpos(raw, house) - 1) ELSE '' END), '{L.EDGE}')"
#: Every part of these records fits one line.
query("f24_address_label", rf"""{CTE}, n AS ({_ADDR}), x AS (SELECT record_id, value, upper(trim(address)) AS raw, regexp_extract(value, '^\d+') AS house FROM n JOIN ba USING (record_id)),
  y AS (SELECT *, {_BEFORE} AS before, regexp_extract(value, {O.q(rf'^(.*?{L.UNIT})\s+\S.*$')}, 1) AS street, regexp_extract(value, {O.q(rf'^.*?{L.UNIT}\s+(\S.*)$')}, 1) AS tail FROM x)
  SELECT record_id, CASE WHEN {_RAW_BOX('value')} <> '' THEN concat_ws(chr(10), {_RAW_BOX('value')}, nullif({_BESIDE}, ''))
    ELSE concat_ws(chr(10), nullif(coalesce(nullif(street, ''), value), ''), nullif(tail, ''), nullif(CASE WHEN contains(value, before) THEN '' ELSE before END, '')) END AS value FROM y""")(
    lambda spark, d: materialize(source(spark, d).select("record_id", "address", M.normalize_address(c("address")).alias("n")), "addresses").select("record_id", L.address_label(c("address"), c("n")).alias("value"))
)

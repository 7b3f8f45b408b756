"""Comparison of names and addresses for the source-to-master matcher."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import master as M
from . import values as V
from .similarity import jaro_winkler, score_distinct, similarity
from .text import compact_alnum

_STRIP = {*V.BUSINESS_SUFFIXES, *V.BUSINESS_DESCRIPTORS, *V.INDUSTRY_TERMS, "AND", "THE"}


def _canonical(t: str) -> str:
    for table in (V.NICKNAMES, V.NUMBER_WORDS, V.STATES):
        if t in table:
            return table[t]
    return t


def _is_initial(a: str, b: str) -> bool:
    return len(a) == 1 and len(b) > 1 and b[0] == a


def token_overlap(a: list[str], b: list[str]) -> float:
    """Share of the shorter list that finds a partner of its own: equal, initial, or (both over four letters) alike
    with a Jaro-Winkler above 0.88; tried in this order for each token."""
    if not a or not b:
        return 0.0
    short, long = (b, a) if len(a) > len(b) else (a, b)
    left = list(enumerate(long))
    hits = 0
    for t in short:
        pick = next((x for x in left if x[1] == t), None)
        pick = pick or next((x for x in left if _is_initial(t, x[1]) or _is_initial(x[1], t)), None)
        if not pick and len(t) > 4:
            rated = [(jaro_winkler(t, x[1]), -x[0], x) for x in left if len(x[1]) > 4]
            best = max(rated, default=None)
            pick = best[2] if best and best[0] > 0.88 else None
        if pick:
            left.remove(pick)
            hits += 1
    return hits / len(short)


def _spells(short: list[str], long: list[str]) -> bool:
    return len(short) == 1 and len(short[0]) > 1 and len(long) >= 2 and short[0] == "".join(w[0] for w in long)


def name_score(a: str, b: str) -> tuple[float, str]:
    """Score and the rule that gave it, for two normalized names."""
    if not a or not b:
        return 0.0, "empty_input"
    if a == b:
        return 1.0, "exact_post_norm"
    raw = [[t for t in n.split() if t not in V.NAME_SUFFIXES] for n in (a, b)]
    if not all(raw):
        raw = [a.split(), b.split()]
    if _spells(*raw) or _spells(*raw[::-1]):
        return 0.95, "acronym"
    kept = [[_canonical(t) for t in ts if t not in _STRIP] for ts in raw]
    if not all(kept):
        kept = [[_canonical(t) for t in ts] for ts in raw]
    x, y = kept
    cx, cy = " ".join(x), " ".join(y)
    if cx == cy:
        return 1.0, "exact_post_strip"
    pairs = len(x) >= 2 and len(y) >= 2
    if pairs and x[-1] == y[-1] and (_is_initial(x[0], y[0]) or _is_initial(y[0], x[0])):
        return 0.95, "initial"
    compact = jaro_winkler(cx.replace(" ", ""), cy.replace(" ", ""))
    score = best = max(jaro_winkler(cx, cy), jaro_winkler(" ".join(sorted(x)), " ".join(sorted(y))), compact)
    if pairs:
        overlap = token_overlap(x, y)
        opens = x[0] == y[0] or _is_initial(x[0], y[0]) or _is_initial(y[0], x[0]) or (min(len(x[0]), len(y[0])) > 1 and jaro_winkler(x[0], y[0]) >= 0.85)
        if opens and x[-1] == y[-1]:
            overlap = max(overlap, 0.9)
        score = best * (0.3 + 0.7 * overlap)
    if compact >= 0.95:
        score = max(score, compact)
    return score, "scored"


@F.pandas_udf(T.StructType([T.StructField("name_score", T.DoubleType()), T.StructField("rule", T.StringType())]))
def name_compare(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Of two normalized names; a match is a score of 0.85 or more."""
    return pd.DataFrame([name_score(x or "", y or "") for x, y in zip(a, b, strict=True)], columns=["name_score", "rule"])


@F.pandas_udf(T.DoubleType())
def closeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """The better similarity of two strings, as they are and without spaces and signs."""
    flat = lambda s: "".join(ch for ch in s if ch.isascii() and ch.isalnum())
    return pd.Series([max(similarity(x or "", y or ""), similarity(flat(x or ""), flat(y or ""))) for x, y in zip(a, b, strict=True)])


def address_features(df: DataFrame, address: str, city: str, zip_: str, prefix: str) -> DataFrame:
    """Everything that the comparison needs of one side, computed once a record and not once a pair."""
    return address_texts(df, address, prefix).withColumns({f"{prefix}_city": M.normalize_city(F.col(city)), f"{prefix}_zip": M.normalize_zip(F.col(zip_))})


def address_texts(df: DataFrame, address: str, prefix: str) -> DataFrame:
    """The features that the address line alone gives."""
    p = lambda n: f"{prefix}_{n}"
    df = df.withColumn(p("addr"), M.normalize_address(F.col(address)))
    a = F.col(p("addr"))
    core = M.street_core(a)
    return df.withColumns({
        p("unknown"): a.rlike(V.UNKNOWN_ADDRESS), p("is_box"): M.is_po_box(a), p("box"): M.po_box_number(a), p("num"): M.house_number(a),
        p("core"): core, p("tail"): F.regexp_replace(a, r"^\s*\d+\s+", ""), p("nums"): M.address_numbers(a),
    })


def meeting_key(prefix: str) -> Column:
    """What the addresses of two rows must share for a rule to weigh them: the box number, the house number, or having
    neither. Null for rows that no rule weighs; all pairs that differ in it score 0."""
    col = lambda n: F.col(f"{prefix}_{n}")
    street = F.when(col("num") != "", F.concat(F.lit("street "), col("num"))).otherwise("neither")
    return F.when(~col("unknown") & (col("addr") != ""), F.when(~col("is_box"), street).when(col("box") != "", F.concat(F.lit("box "), col("box"))))


def compare_addresses(pairs: DataFrame, s: str = "s", m: str = "m") -> DataFrame:
    """Adds same_address, address_score and address_reason to pairs that carry both sides' ``address_features``.

    The rule that decides a pair needs no similarity, so it comes first, as a column. String similarities run in Python
    only for pairs whose rule weighs them, once for each distinct pair of strings; all others score 0."""
    col = lambda side, n: F.col(f"{side}_{n}")
    either = lambda n, value: (col(s, n) == value) | (col(m, n) == value)
    both = lambda n, value: (col(s, n) == value) & (col(m, n) == value)
    rules = [
        (col(s, "unknown") | col(m, "unknown"), "UNKNOWN_ADDRESS"),
        (both("addr", ""), "BOTH_EMPTY"),
        (either("addr", ""), "ONE_EMPTY"),
        (col(s, "is_box") != col(m, "is_box"), "POBOX_VS_STREET"),
        (col(s, "is_box") & either("box", ""), "POBOX_MISSING_NUM"),
        (col(s, "is_box") & (col(s, "box") != col(m, "box")), "POBOX_NUM_MISMATCH"),
        (col(s, "is_box"), "POBOX_MATCH"),
        (both("num", ""), "NON_STANDARD"),
        (either("num", ""), "MISSING_HOUSE_NUMBER"),
        (col(s, "num") != col(m, "num"), "HOUSE_NUM_MISMATCH"),
    ]
    rule: Column = F.lit("STREET")
    for when, name in reversed(rules):
        rule = F.when(when, name).otherwise(rule)
    is_ = lambda name: F.col("address_reason") == name
    # What a rule weighs: whole addresses, streets (what follows the house number where neither has one), or cities.
    text = lambda side: F.when(is_("NON_STANDARD"), col(side, "addr")).when(is_("POBOX_MATCH"), col(side, "city")).otherwise(
        F.when(both("core", ""), col(side, "tail")).otherwise(col(side, "core"))
    )
    pairs = materialize(pairs.withColumn("address_reason", rule).withColumns({"__s": text(s), "__m": text(m)}), "addresses")
    weighed = F.col("address_reason").isin("STREET", "NON_STANDARD", "POBOX_MATCH")
    df = base = pairs.filter(weighed)
    for left, right, out in ((f"{s}_city", f"{m}_city", "__c"), ("__s", "__m", "__t")):
        df = score_distinct(df, left, right, closeness, out, base)
    no_city = either("city", "")
    city, alike = F.when(no_city, F.lit(0.9)).otherwise(F.col("__c")), F.col("__t")
    z1, z2 = col(s, "zip"), col(m, "zip")
    zip_same, zip_differs = (z1 != "") & (z1 == z2), (z1 != "") & (z2 != "") & (z1 != z2)
    n1, n2 = col(s, "nums"), col(m, "nums")
    some = (F.size(n1) > 0) & (F.size(n2) > 0)
    apart, equal = some & ~F.arrays_overlap(n1, n2), some & (n1 == n2)
    lift = lambda score: F.when(zip_same & (score >= 0.85), F.least(F.lit(1.0), score + 0.05)).otherwise(score)
    box = F.least(F.lit(1.0), 0.92 * city + F.when(zip_same, 0.05).otherwise(0.0))
    free = lift(alike * (0.6 + 0.4 * city))
    free = F.when(apart, F.greatest(F.lit(0.0), free - 0.10)).otherwise(free)
    free = F.when(zip_differs, F.greatest(F.lit(0.0), free - 0.20)).otherwise(free)
    free = F.when(equal & zip_same, F.least(F.lit(1.0), free + 0.50)).otherwise(free)
    zip_ok = ~zip_differs | (city >= 0.92)
    street = lift(alike * (0.6 + 0.4 * city))
    street = F.when(zip_ok, street).otherwise(street * 0.75)
    same_box = (box >= 0.90) & (city >= 0.85)
    same_free = ((alike >= 0.90) & (city >= 0.85) & ~apart) | (equal & zip_same & (city >= 0.85))
    same_street = (alike >= 0.90) & zip_ok & ((city >= 0.85) | no_city)
    df = df.withColumns({
        "same_address": F.when(is_("POBOX_MATCH"), same_box).when(is_("NON_STANDARD"), same_free).otherwise(same_street),
        "address_score": F.when(is_("POBOX_MATCH"), box).when(is_("NON_STANDARD"), free).otherwise(street),
    })
    others = pairs.filter(~weighed).withColumns({"same_address": F.lit(False), "address_score": F.lit(0.0)})
    return df.drop("__c", "__t", "__s", "__m").unionByName(others.drop("__s", "__m"))


def three_way(same: Column, score: Column) -> Column:
    """The verdict on the address of a record whose identifier is known."""
    return F.when(same, "EXISTING ADDRESS").when(score >= 0.75, "LIKELY SAME ADDRESS").otherwise("NEW ADDRESS")

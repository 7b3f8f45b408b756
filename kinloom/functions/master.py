"""Normalizers and gates of the source-to-master matcher, as column expressions. Blank and null are the empty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .text import bind, blank, chain, digits, lookup, safe, squeeze, tokens

NAME_CHAIN = [(rf"(?i)\b{p}\b", r) for p, r in V.NAME_RULES]


def normalize_name(c: Column, trust: Column | bool = False) -> Column:
    """Upper case, whole-word replacements, roman numerals split off, runs of single letters joined. In trust mode
    only upper case and single spaces. (OLIVER becomes OL IVER: the numeral rule works inside words of capitals.)"""
    s = safe(c)
    n = F.regexp_replace(F.regexp_replace(s, "[/&]", " "), r"[^A-Za-z0-9\s]", "")
    n = F.regexp_replace(chain(n, NAME_CHAIN), V.ROMAN_SPLIT, "$1 $2")
    n = squeeze(F.upper(n))
    n = F.regexp_replace(n, r"(?<=\b[A-Z])\s(?=[A-Z]\b)", "")
    plain = squeeze(F.upper(s))
    return F.when(F.lit(trust) if isinstance(trust, bool) else trust, plain).otherwise(n)


def _numbered_box(a: Column) -> Column:
    """An address that is just a box becomes a PO box; box numbers in words become digits."""
    box = F.regexp_extract(a, V.BARE_BOX, 1)
    return F.when(box != "", F.concat(F.lit("PO BOX "), F.coalesce(lookup(box, V.NUMBER_WORDS), box))).otherwise(a)


def _digit_box(a: Column) -> Column:
    word = F.regexp_extract(a, V.WORD_BOX, 1)
    return F.when(word != "", F.replace(a, F.concat(F.lit("PO BOX "), word), F.concat(F.lit("PO BOX "), lookup(word, V.NUMBER_WORDS)))).otherwise(a)


def _without_lead(a: Column) -> Column:
    """What stands before the first "number word" goes, unless its last word starts an address."""
    has_lead = a.rlike(V.NUMBER_THEN_WORD) & ~a.rlike(r"^\s*\d") & ~a.contains("PO BOX")

    def cut(lead: Column) -> Column:
        last = F.coalesce(F.try_element_at(tokens(lead), F.lit(-1)), F.lit(""))
        return F.when(last.isin(V.ADDRESS_STARTS), a).otherwise(F.substring(a, F.length(lead) + 1, F.length(a)))

    return F.when(has_lead, bind(F.regexp_extract(a, f"^(.*?){V.NUMBER_THEN_WORD}", 1), cut)).otherwise(a)


def normalize_address(c: Column, trust: Column | bool = False) -> Column:
    """Every step that looks at its text more than once is bound, so the chain before it runs once."""
    plain = squeeze(F.upper(safe(c)))
    a = F.regexp_replace(F.upper(safe(c)), V.DATED, "")
    a = squeeze(F.regexp_replace(a, V.WORD_DATES, " "))
    a = squeeze(F.regexp_replace(a, V.NUMBER_DATES, " "))
    a = bind(F.regexp_replace(a, V.HYPHENED_ORDINAL, "$1 $2"), _numbered_box)
    a = bind(chain(a, V.PO_BOX_RULES), _digit_box)
    a = chain(chain(a, V.COUNTY_ROADS), [(rf"\b{w}\b", r) for w, r in V.STREET_WORDS])
    a = F.regexp_replace(F.regexp_replace(a, V.NUMBER_SIGN, "APT $1"), r"[.,\-]", "")
    a = squeeze(bind(a, _without_lead))
    return F.when(plain == "", "").otherwise(F.when(F.lit(trust) if isinstance(trust, bool) else trust, plain).otherwise(a))


def normalize_city(c: Column) -> Column:
    s = F.regexp_replace(F.upper(safe(c)), r"[^A-Z0-9\s]", " ")
    return squeeze(F.regexp_replace(s, r"\bFT\b", "FORT"))


def normalize_zip(c: Column) -> Column:
    d = digits(c)
    return F.when(F.length(d) >= 4, F.lpad(F.substring(d, 1, 5), 5, "0")).otherwise(d)


def canonical_token(t: Column) -> Column:
    return F.coalesce(lookup(t, V.NICKNAMES), lookup(t, V.NUMBER_WORDS), lookup(t, V.STATES), t)


def house_number(address: Column) -> Column:
    return F.regexp_extract(address, r"^\s*(\d+)\b", 1)


def is_po_box(address: Column) -> Column:
    return address.rlike(r"(?i)\bPO\s*BOX\b")


def po_box_number(address: Column) -> Column:
    n = F.upper(F.regexp_extract(address, r"\bPO\s*BOX\s*([A-Z0-9]+)\b", 1))
    return F.when(is_po_box(address), F.coalesce(lookup(n, V.NUMBER_WORDS), n)).otherwise("")


def street_core(address: Column) -> Column:
    """The street's own words: without number, unit, type and direction."""
    s = F.regexp_replace(F.upper(F.coalesce(address, F.lit(""))), r"^\s*\d+\s+", "")
    s = F.regexp_replace(s, r"\b(APT|STE|UNIT|BLDG|FL|RM)\b\s*\w+", " ")
    s = F.regexp_replace(s, r"[^A-Z0-9\s]", " ")
    drop = V.STREET_TYPES + V.DIRECTIONS + V.UNITS
    return F.array_join(F.filter(tokens(s), lambda t: ~t.isin(drop)), " ")


def address_numbers(address: Column) -> Column:
    """Sorted distinct numbers of two or more digits, dates left out."""
    clean = F.regexp_replace(F.coalesce(address, F.lit("")), V.ANY_DATES, " ")
    return F.array_sort(F.array_distinct(F.regexp_extract_all(clean, F.lit(r"(\d{2,})"), F.lit(1))))


def names_in_address(address: Column) -> Column:
    """Names behind C/O and ATTN, at least three characters long."""
    text = F.upper(safe(address))

    def named(pattern: str) -> Column:
        found = F.regexp_replace(F.trim(F.regexp_extract(text, pattern, 1)), r",+$", "")
        return F.trim(F.regexp_replace(found, V.ROLES, ""))

    return F.filter(F.array(named(V.CARE_OF), named(V.ATTENTION)), lambda n: F.length(n) >= 3)


def clean_ssn(c: Column) -> Column:
    d = digits(c)
    bad = (F.length(d) < 4) | d.startswith("000") | d.startswith("666") | d.isin(V.BAD_SSNS)
    return F.when(bad, "").otherwise(d)


def mask_ssn(c: Column) -> Column:
    d = digits(c)
    return F.when(F.length(d) <= 4, d).otherwise(F.concat(F.repeat(F.lit("*"), F.length(d) - 4), F.right(d, F.lit(4))))


def quality_gate(name: Column, address: Column, city: Column, state: Column, zip_: Column, prefix: str = "") -> Column:
    """The first reason for a review, or null. ``prefix`` marks the master side's reasons."""
    reason = F.lit(None).cast("string")
    checks = [(blank(c), f"{prefix}EMPTY_{n}") for c, n in ((name, "NAME"), (address, "ADDRESS"), (city, "CITY"), (state, "STATE"), (zip_, "ZIP"))]
    checks.append((F.upper(safe(address)).rlike(V.UNKNOWN_ADDRESS), f"{prefix}UNKNOWN_ADDRESS"))
    checks.append((F.upper(safe(city)).rlike(V.UNKNOWN_TEXT), f"{prefix}UNKNOWN_CITY"))
    checks.append((F.upper(safe(name)).rlike(V.UNKNOWN_TEXT), f"{prefix}UNKNOWN_NAME"))
    for bad, what in reversed(checks):
        reason = F.when(bad, what).otherwise(reason)
    return reason


def classify(name_score: Column, address_score: Column, rules=V.BUCKETS) -> Column:
    """The first bucket whose closed ranges hold both scores."""
    out = F.lit(V.NEEDS_REVIEW)
    for bucket, n0, n1, a0, a1 in reversed(rules):
        out = F.when(name_score.between(n0, n1) & address_score.between(a0, a1), bucket).otherwise(out)
    return out


def trust_pattern(keywords=V.TRUST_KEYWORDS) -> str:
    return r"(?i)\b(" + "|".join(sorted(keywords, key=lambda k: (-len(k), k))) + r")\b"


def is_trust(name: Column, address: Column, keywords=V.TRUST_KEYWORDS) -> Column:
    p = trust_pattern(keywords)
    return F.coalesce(name, F.lit("")).rlike(p) | F.coalesce(address, F.lit("")).rlike(p)


def round5(c: Column) -> Column:
    return F.bround(c / 5) * 5


def ambiguous_name(name_score: Column, ssn_match: Column, low: float = 15.0, high: float = 70.0) -> Column:
    return (ssn_match > 0) & name_score.between(low, high)


def ambiguous_address(score: Column, zip1: Column, zip2: Column, numbers1: Column, numbers2: Column, low: float = 15.0, high: float = 65.0) -> Column:
    """In the band, or zero although zips and (some) numbers agree."""
    same = (zip1 != "") & (zip1 == zip2) & (F.size(numbers1) > 0) & (numbers1 == numbers2)
    return score.between(low, high) | ((score == 0) & same)


def normalization_detail(raw: Column, trust: bool = False) -> Column:
    """What the name normalizer changed, joined with semicolons."""
    s = safe(raw)
    cleaned = F.regexp_replace(F.regexp_replace(s, "[/&]", " "), r"[^A-Za-z0-9\s]", "")
    notes = [F.when(cleaned != s, F.concat(F.lit("[clean] "), F.trim(s), F.lit("→"), F.trim(cleaned)))]
    now = cleaned
    for pattern, replacement in NAME_CHAIN:
        after = F.regexp_replace(now, pattern, replacement)
        notes.append(F.when(after != now, F.concat(F.regexp_extract(now, pattern, 0), F.lit("→"), F.lit(replacement))))
        now = after
    return F.when(s == "", "EMPTY_INPUT").otherwise(F.array_join(F.array_compact(F.array(*notes)), "; "))




def audit_detail(source: Column, master: Column) -> Column:
    """What was changed on either side, in one line; empty if nothing was."""
    said = lambda who, c: F.when(c != "", F.concat(F.lit(f"{who}: "), c))
    return F.concat_ws(" | ", said("source", source), said("dec", master))


def boost_detail(detail: Column, source: Column, score: Column) -> Column:
    """The rule of a match, and behind it the boost, if there was one."""
    boost = F.when(source.isNotNull(), F.concat(F.lit("BOOST("), source, F.lit("): "), F.format_string("%.3f", score)))
    return F.concat_ws("; ", F.when(detail != "", detail), boost)


def score_changed(old: Column, new: Column) -> Column:
    """Whether a judge's score is ten or more away from the computed one."""
    return F.coalesce(F.abs(new - old) >= 10, F.lit(False))

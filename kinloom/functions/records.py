"""Normalizers, parsers and gates of the record pipeline, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .text import bind, chain, digits, lookup, normalize_string, safe, squeeze, tokens


def normalize_address(c: Column) -> Column:
    """Lower case, abbreviations, no punctuation but hyphens (letters of any script stay)."""
    return squeeze(F.regexp_replace(chain(normalize_string(c), V.PIPELINE_ADDRESS_RULES), r"(?U)[^\w\s\-]", ""))


def normalize_phone(c: Column) -> Column:
    return digits(c)


def normalize_zip(c: Column) -> Column:
    return F.substring(digits(c), 1, 5)


def normalize_suffix(c: Column) -> Column:
    s = F.replace(F.lower(safe(c)), F.lit("."), F.lit(""))
    return F.coalesce(lookup(s, V.GENERATIONS), s)


def _bare(t: Column) -> Column:
    return F.regexp_replace(F.lower(t), "[.,]", "")


def remove_title(c: Column) -> Column:
    """Struct (rest, title): a title as the first word, else as the last."""
    s = safe(c)
    words = tokens(s)
    n = F.size(words)
    first, last = F.coalesce(F.try_element_at(words, F.lit(1)), F.lit("")), F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit(""))
    at_first = _bare(first).isin(V.TITLES)
    at_last = (n > 1) & _bare(last).isin(V.TITLES)
    rest = F.when(at_first, F.array_join(F.slice(words, 2, F.greatest(n, F.lit(1))), " ")).when(at_last, F.array_join(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), " ")).otherwise(s)
    return F.struct(rest.alias("rest"), F.when(at_first, first).when(at_last, last).otherwise("").alias("title"))


def entity_type(c: Column, whole_words: bool = False) -> Column:
    """trust, department, business or individual, by the first list with a mark inside the name. Marks count inside
    words too (``hr`` in Christopher); ``whole_words`` stops that."""
    s = F.lower(F.coalesce(c, F.lit("")))

    def holds(marks: list[str]) -> Column:
        if whole_words:
            return s.rlike(r"(?:^|\W)(?:" + "|".join(m.replace(".", r"\.") for m in marks) + r")(?:\W|$)")
        return reduce(lambda a, b: a | b, (s.contains(m) for m in marks))

    return F.when(holds(V.TRUST_MARKS), "trust").when(holds(V.DEPARTMENT_MARKS), "department").when(holds(V.BUSINESS_MARKS), "business").otherwise("individual")


def department_name(c: Column) -> Column:
    """The word before the first one that holds the first mark found in the name (the mark itself at the start). A mark
    of several words stands in no word, so the next mark is tried."""
    s = F.lower(F.coalesce(c, F.lit("")))
    words = tokens(s)
    marks = F.filter(F.array(*map(F.lit, V.DEPARTMENT_MARKS)), lambda m: F.exists(words, lambda t: t.contains(m)))
    mark = F.try_element_at(marks, F.lit(1))
    at = F.array_position(F.transform(words, lambda t: t.contains(mark)), True).cast("int")
    return F.when(mark.isNull(), s).when(at == 1, mark).otherwise(F.try_element_at(words, at - 1))


def trust_name(c: Column) -> Column:
    s = F.lower(F.coalesce(c, F.lit("")))
    for mark in V.TRUST_MARKS:
        s = F.trim(F.replace(s, F.lit(mark), F.lit("")))
    return s


def may_match(type1: Column, type2: Column, name1: Column, name2: Column) -> Column:
    """Entity gate: equal types, and for departments the same department."""
    return (type1 == type2) & ((type1 != "department") | (department_name(name1) == department_name(name2)))


def suffixes_clash(suffix1: Column, suffix2: Column) -> Column:
    return (suffix1 != "") & (suffix2 != "") & (suffix1 != suffix2)


def with_full_names(c: Column) -> Column:
    """Lower case; words that are nicknames (punctuation aside) become the full name."""
    full = lambda t: F.coalesce(lookup(F.regexp_replace(t, r"(?U)[^\w]", ""), V.PIPELINE_NICKNAMES), t)
    return F.array_join(F.transform(tokens(normalize_string(c)), full), " ")


def parse_name(c: Column) -> Column:
    """Struct (first, middle, last, suffix, title)."""
    return bind(remove_title(c), lambda split: bind(tokens(split["rest"]), lambda words: _parsed(words, split["title"])))


def _parsed(words: Column, title: Column) -> Column:
    n = F.size(words)
    at = lambda k: F.coalesce(F.try_element_at(words, F.lit(k)), F.lit(""))
    forms = sorted(set(V.GENERATIONS.values()))
    last = at(-1)
    ends3 = normalize_suffix(last).isin(forms)
    ends4 = _bare(last).isin(sorted({*V.GENERATIONS, *forms}))
    suffix = ((n == 3) & ends3) | ((n >= 4) & ends4)
    middle = F.when(n < 3, "").when(n == 3, F.when(suffix, "").otherwise(at(2))).otherwise(
        F.array_join(F.slice(words, 2, F.greatest(n - F.when(suffix, 3).otherwise(2), F.lit(0))), " ")
    )
    return F.struct(
        at(1).alias("first"), middle.alias("middle"), F.when(n < 2, "").when(suffix, at(-2)).otherwise(last).alias("last"),
        F.when(suffix, last).otherwise("").alias("suffix"), title.alias("title"),
    )


def email(c: Column) -> Column:
    s = F.lower(safe(c))
    return F.when(s.contains("@"), s).otherwise("")


def state(c: Column) -> Column:
    return F.upper(safe(c))


def phone_prefix(c: Column) -> Column:
    d = digits(c)
    return F.when(F.length(d) >= 6, F.substring(d, 1, 6))


def name_token(c: Column) -> Column:
    """The first word of three letters or more that is not skipped, else the first word."""
    words = tokens(F.regexp_replace(F.lower(safe(c)), "[.,]", ""))
    good = F.filter(words, lambda t: (F.length(t) >= 3) & ~t.isin(V.SKIP_WORDS))
    return F.coalesce(F.try_element_at(good, F.lit(1)), F.try_element_at(words, F.lit(1)), F.lit(""))


def clean_ssn(c: Column) -> Column:
    d = digits(c)
    bad = (F.length(d) != 9) | d.rlike(r"^(\d)\1{8}$") | d.startswith("000") | d.startswith("666") | d.startswith("9")
    return F.when(bad, "").otherwise(d)


def token_of(clean: Column, salt: str) -> Column:
    """Hex SHA-256 of ``digits|salt``; empty for the empty number. The salt has no default."""
    return F.when(clean == "", "").otherwise(F.sha2(F.concat_ws("|", clean, F.lit(salt)), 256))


def clean_ein(c: Column) -> Column:
    d = digits(c)
    return F.when(F.length(d) == 9, d).otherwise("")


def mask_ssn(c: Column) -> Column:
    d = clean_ssn(c)
    return F.when(d == "", "").otherwise(F.concat(F.lit("XXX-XX-"), F.right(d, F.lit(4))))


def completeness(fields: list[str]) -> Column:
    """How many of the fields are filled."""
    return reduce(lambda a, b: a + b, ((safe(F.col(f)) != "").cast("int") for f in fields))

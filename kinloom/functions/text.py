"""Column helpers that all engines share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe(c: Column) -> Column:
    """Null is the empty text; outer white space goes."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"^\s+|\s+$", "")


def blank(c: Column) -> Column:
    return safe(c) == ""


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalize_string(c: Column, lower: bool = True, collapse: bool = True) -> Column:
    out = safe(c)
    out = F.lower(out) if lower else out
    return squeeze(out) if collapse else out


def chain(c: Column, rules: Iterable[tuple[str, str]]) -> Column:
    """Replaces all occurrences of each pattern, in order."""
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[^0-9]", "")


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x1f\x7f-\x9f]", "")


def scrub_newlines(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]+", " "), r"\s+", " "))


def compact_alnum(c: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z0-9]", "")


def lookup(c: Column, table: dict[str, str]) -> Column:
    """The table's value, or null."""
    keys = F.array(*(F.lit(k) for k in table))
    values = F.array(*(F.lit(v) for v in table.values()))
    return F.try_element_at(F.map_from_arrays(keys, values), c)


def tokens(c: Column) -> Column:
    """Words between white space; none of the empty text."""
    return F.filter(F.split(squeeze(c), " "), lambda t: t != "")


def bind(c: Column, f) -> Column:
    """``f(c)`` with ``c`` computed once, however often ``f`` refers to it. Spark takes no Python function over such an
    expression in one projection: store the column first, as the matchers do."""
    return F.element_at(F.transform(F.array(c), lambda x: f(x)), 1)

"""Name parsing, match keys and review flags of the name dedup with human review."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .text import chain, scrub_newlines, squeeze


def flip_last_first(c: Column, keep_numbers: bool = False) -> Column:
    """``Last, First`` as ``First Last``; company names, legal suffixes and names that start with a digit stay.
    ``keep_numbers`` also leaves names whose first part is all digits."""
    s = scrub_newlines(c)
    parts = F.split(s, ",", 2)
    first, second = F.trim(F.element_at(parts, 1)), F.trim(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")))
    legal = F.replace(F.upper(second), F.lit("."), F.lit("")).isin(V.FLIP_SUFFIXES)
    company = reduce(lambda a, b: a | b, (F.upper(first).contains(m) for m in V.COMPANY_MARKS))
    stays = legal | company | first.rlike(r"^\d") | (F.length(second) <= 1)
    if keep_numbers:
        stays = stays | first.rlike(r"^\d+$")
    return F.when(s.contains(",") & ~stays, F.concat_ws(" ", second, first)).otherwise(s)


def match_key(c: Column, abbreviations=V.KEY_ABBREVIATIONS) -> Column:
    s = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"[^A-Z0-9\s]", "")
    s = chain(s, [(rf"\b{x}\b", "") for x in V.KEY_SUFFIXES])
    return squeeze(chain(s, [(rf"\b{a}\b", full) for a, full in abbreviations]))


def review_keywords(c: Column, keywords=V.REVIEW_KEYWORDS) -> Column:
    """The keywords that stand in the name as words, in list order. ``TR `` needs a word behind it."""
    s = F.upper(F.coalesce(c, F.lit("")))
    return F.array_compact(F.array(*(F.when(s.rlike(rf"\b{k.upper()}\b"), F.lit(k)) for k in keywords)))


def review_reason(hits: Column) -> Column:
    reasons = F.map_from_arrays(F.array(*map(F.lit, V.REVIEW_REASONS)), F.array(*map(F.lit, V.REVIEW_REASONS.values())))

    def reason(k: Column) -> Column:
        other = F.concat(F.lit('Contains keyword "'), k, F.lit('" which requires human review'))
        return F.coalesce(F.try_element_at(reasons, F.upper(F.trim(k))), other)

    return F.array_join(F.transform(hits, reason), " | ")

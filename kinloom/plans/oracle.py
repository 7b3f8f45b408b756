"""DuckDB expressions for the oracles. DuckDB's patterns are RE2, without lookaround; replacements need the flag g."""

from __future__ import annotations

from ..functions import values as V


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to)}, '{flags}')"


def chain(x: str, rules, flags: str = "g") -> str:
    for p, r in rules:
        x = sub(x, p, r, flags)
    return x


def safe(x: str) -> str:
    return sub(f"coalesce({x}, '')", r"^\s+|\s+$", "")


def squeeze(x: str) -> str:
    return f"trim({sub(x, r'\s+', ' ')})"


def digits(x: str) -> str:
    return sub(f"coalesce({x}, '')", "[^0-9]", "")


def words(x: str) -> str:
    return f"list_filter(string_split({squeeze(x)}, ' '), lambda t: t <> '')"


def inside(x: str, items) -> str:
    return f"({x} IN ({', '.join(map(q, items))}))"


def table(x: str, items: dict) -> str:
    return f"(CASE {x} {' '.join(f'WHEN {q(k)} THEN {q(v)}' for k, v in items.items())} END)"


def singles_joined(x: str) -> str:
    """Runs of single letters joined, over a list of words."""
    one = "regexp_full_match(l[{}], '[A-Z]')"
    gap = f"CASE WHEN i = 1 OR ({one.format('i')} AND {one.format('i - 1')}) THEN '' ELSE ' ' END"
    return f"(SELECT array_to_string(list_transform(range(1, len(l) + 1), lambda i: {gap} || l[i]), '') FROM (SELECT {words(x)} AS l))"


def master_name(x: str) -> str:
    s = safe(x)
    n = sub(sub(s, "[/&]", " "), r"[^A-Za-z0-9\s]", "")
    n = chain(n, [(rf"\b{p}\b", r) for p, r in V.NAME_RULES], "gi")
    n = f"upper({sub(n, V.ROMAN_SPLIT, r'\1 \2')})"
    return singles_joined(n)


def sorted_words(x: str) -> str:
    """A text as the token-sort ratio reads it: lower case, words of letters and digits in order."""
    return f"array_to_string(list_sort({words(sub(f'lower({x})', '[^a-z0-9]+', ' '))}), ' ')"


def ratios(source: str, name: str) -> str:
    """Common table expressions ``name(a, b, ratio)``: the Indel ratio in percent of every distinct pair (a, b) of the
    table ``source``, by the textbook recurrence of the longest common subsequence, one row of the matrix a step."""
    cand = "list_transform(range(1, len(row) + 1), lambda j: CASE WHEN j = 1 THEN 0 WHEN substr(b, (j - 1)::BIGINT, 1) = substr(a, (i + 1)::BIGINT, 1) THEN row[j - 1] + 1 ELSE row[j] END)"
    return f"""{name}_p AS MATERIALIZED (SELECT DISTINCT a, b FROM {source}),
  {name}_s AS (SELECT a, b, 0::BIGINT AS i, list_transform(range(0, length(b) + 1), lambda x: 0::BIGINT) AS row FROM {name}_p WHERE a <> b
    UNION ALL SELECT a, b, i + 1, list_transform(range(1, len(cand) + 1), lambda j: list_max(cand[1:j])) FROM (SELECT a, b, i, {cand}::BIGINT[] AS cand FROM {name}_s WHERE i < length(a))),
  {name} AS MATERIALIZED (SELECT a, b, CASE WHEN a = '' OR b = '' THEN 0 ELSE round_even(200 * row[len(row)] / (length(a) + length(b))::DOUBLE, 0) END::INT AS ratio FROM {name}_s WHERE i = length(a)
    UNION ALL SELECT a, b, CASE WHEN a = '' THEN 0 ELSE 100 END FROM {name}_p WHERE a = b)"""


def jaro(source: str, name: str) -> str:
    """Common table expressions ``name(a, b, jaro, winkler)`` for every distinct pair (a, b) of the table ``source``: the
    Jaro similarity by its definition, one character of ``a`` a step, and with the common prefix of up to four. A matched
    character of ``b`` becomes chr(1) in ``rest``."""
    near = "range(greatest(1, i + 1 - reach), least(length(b), i + 1 + reach) + 1)"
    spot = f"list_min(list_filter({near}, lambda j: substr(rest, j::BIGINT, 1) = substr(a, (i + 1)::BIGINT, 1)))"
    met = "list_filter(range(1, length(b) + 1), lambda j: substr(rest, j::BIGINT, 1) = chr(1))"
    return f"""{name}_p AS MATERIALIZED (SELECT DISTINCT a, b FROM {source}),
  {name}_s AS (SELECT a, b, 0::BIGINT AS i, b AS rest, '' AS met, greatest(0, greatest(length(a), length(b)) // 2 - 1)::BIGINT AS reach FROM {name}_p WHERE a <> b AND a <> '' AND b <> ''
    UNION ALL SELECT a, b, i + 1, CASE WHEN spot IS NULL THEN rest ELSE substr(rest, 1, spot - 1) || chr(1) || substr(rest, spot + 1) END, CASE WHEN spot IS NULL THEN met ELSE met || substr(a, i + 1, 1) END, reach
      FROM (SELECT *, {spot}::BIGINT AS spot FROM {name}_s WHERE i < length(a))),
  {name}_m AS (SELECT a, b, met, length(met) AS m, {met} AS spots FROM {name}_s WHERE i = length(a)),
  {name}_j AS (SELECT a, b, CASE WHEN m = 0 THEN 0.0::DOUBLE ELSE (m / length(a)::DOUBLE + m / length(b)::DOUBLE
      + (m - len(list_filter(range(1, m + 1), lambda k: substr(met, k::BIGINT, 1) <> substr(b, spots[k]::BIGINT, 1))) / 2::DOUBLE) / m) / 3.0::DOUBLE END AS jaro FROM {name}_m
    UNION ALL SELECT a, b, CASE WHEN a = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM {name}_p WHERE a = b OR a = '' OR b = ''),
  {name} AS MATERIALIZED (SELECT a, b, jaro, CASE WHEN a = '' OR b = '' THEN 0.0::DOUBLE ELSE jaro + 0.1::DOUBLE * (1 - jaro)
      * len(list_filter(range(1, least(4, length(a), length(b)) + 1), lambda k: substr(a, 1, k::BIGINT) = substr(b, 1, k::BIGINT))) END AS winkler FROM {name}_j)"""

"""URL filter: rules first, and for the rest gradient-boosted trees on lexical features, all as column expressions.

The trees learn from the URLs that a rule judges. Their features are lengths, depth, digit ratio, entropy, parameter
counts and suffix statistics: the block rates of the host's last label and last two labels, of the path's first segment
and of its last one's ending. Features are computed once and stored. Fitting takes ``max_train`` labelled rows at most,
those with the smallest hash of their url among the odd ones, so a rerun takes the same ones. The block rates, smoothed,
are counted over all other labelled rows: no row's own verdict is in a rate that it is fitted with. The driver fits the
trees, and the model is a sum of CASE expressions, judged inside whole-stage codegen.

Null urls, or urls without ``://``: host and path are empty, and the method judges them like any other. Repeated urls
are judged alike. Without any labelled row, every URL that no rule fits is allowed. An empty table gives no rows. Other
columns are not touched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path prefix); a rule is written as host followed by path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
MAX_RULES = 1000
FEATURES = ["url_length", "host_length", "path_length", "depth", "labels", "digits", "digit_ratio", "hyphens", "parameters", "query_length", "entropy", *(f"{k}_rate" for k in ("tld", "domain", "segment", "ending"))]
#: Texts whose block rates are features.
STATISTICS = ["tld", "domain", "segment", "ending"]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no ``://``."""
    get = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(get(1), UPPER, LOWER), get(2)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits. Of equally long rules the first."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules go into a plan")
    text = verdict = None
    for what, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, h + p) if text is None else text.when(fits, h + p)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def entropy(c: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for the empty text."""
    n = F.length(c).cast("double")
    share = lambda ch: (n - F.length(F.replace(c, ch, F.lit("")))) / n
    chars = F.array_distinct(F.filter(F.split(c, ""), lambda x: x != ""))
    return F.when(n > 0, F.aggregate(chars, F.lit(0.0), lambda a, ch: a - share(ch) * F.log2(share(ch)))).otherwise(0.0)


def with_features(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule, fixed (the rule's verdict), the texts of STATISTICS and the features but for their
    rates."""
    host, path = parts(F.col("url"))
    df = pages.select("page_id", F.coalesce(F.col("url"), F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    text, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    digits = F.length(F.regexp_replace("url", "[^0-9]", ""))
    query = F.regexp_extract("url", r"(?s)\?([^#]*)", 1)
    count = lambda c, ch: F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))
    n = F.length("url")
    return df.select(
        "*", text.alias("rule"), verdict.alias("fixed"), F.substring_index("host", ".", -1).alias("tld"),
        F.substring_index("host", ".", -2).alias("domain"), F.regexp_extract("path", r"(?s)^/*([^/]*)", 1).alias("segment"), F.regexp_extract("path", r"(?s)\.([A-Za-z0-9]{1,8})$", 1).alias("ending"),
        n.cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"), F.length("path").cast("double").alias("path_length"),
        count(F.col("path"), "/").cast("double").alias("depth"), count(F.col("host"), ".").cast("double").alias("labels"),
        digits.cast("double").alias("digits"), F.when(n > 0, digits / n).otherwise(0.0).alias("digit_ratio"),
        count(F.col("host"), "-").cast("double").alias("hyphens"),
        F.when(query != "", count(query, "&") + 1).otherwise(0).cast("double").alias("parameters"), F.length(query).cast("double").alias("query_length"),
        entropy(F.col("url")).alias("entropy"),
    )


def to_fit(df: DataFrame, max_train: int) -> Column:
    """Whether a row is one of the ``max_train`` labelled rows that the trees are fitted on."""
    o = F.xxhash64("url")
    odd = F.col("fixed").isNotNull() & (F.pmod(o, F.lit(2)) == 1)
    last = df.filter(odd).select(o.alias("o")).orderBy("o").limit(max_train).agg(F.max("o")).first()[0]
    return F.lit(False) if last is None else odd & (o <= last)


def with_rates(df: DataFrame, fitted: Column, prior: float = 20.0) -> DataFrame:
    """Adds the smoothed block rate of each statistic over all labelled rows that are not ``fitted``. The tables of counts
    join by shuffle or, where Spark finds them small, by broadcast."""
    counted = df.filter(F.col("fixed").isNotNull() & ~fitted)
    for k in STATISTICS:
        rates = counted.groupBy(k).agg(((F.count_if(F.col("fixed") == "block") + prior / 2) / (F.count(F.lit(1)) + prior)).alias(f"{k}_rate"))
        df = df.join(rates, k, "left").withColumn(f"{k}_rate", F.coalesce(f"{k}_rate", F.lit(0.5)))
    return df


@dataclass
class Node:
    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


@dataclass
class Trees:
    """Boosted trees for the log odds of ``block``."""

    base: float = -20.0
    rate: float = 0.3
    trees: list[Node] = field(default_factory=list)

    def column(self, names=FEATURES) -> Column:
        def of(t: Node) -> Column:
            return F.lit(t.value) if t.low is None else F.when(F.col(names[t.feature]) <= t.cut, of(t.low)).otherwise(of(t.high))

        total = F.lit(self.base)
        for t in self.trees:
            total = total + of(t)
        return total


def fit(rows: list[tuple[list[float], int]], n_trees: int = 20, depth: int = 3, rate: float = 0.3, bins: int = 16, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss on histograms of at most ``bins`` quantile bins a feature."""
    if not rows:
        return Trees()
    share = (sum(y for _, y in rows) + 0.5) / (len(rows) + 1)
    model = Trees(math.log(share / (1 - share)), rate)
    n_features = len(rows[0][0])
    cuts = []
    for f in range(n_features):
        values = sorted(x[f] for x, _ in rows)
        cuts.append(sorted({values[len(values) * k // bins] for k in range(1, bins)} - {values[-1]}))
    places = [tuple(sum(v > c for c in cuts[f]) for f, v in enumerate(x)) for x, _ in rows]
    tally: dict[tuple, list[int]] = {}
    for p, (_, y) in zip(places, rows, strict=True):
        t = tally.setdefault(p, [0, 0])
        t[0] += 1
        t[1] += y
    points = [(p, n, y, [model.base]) for p, (n, y) in sorted(tally.items())]

    def grow(of: list, left: int) -> Node:
        sums = [(n * (q := 1 / (1 + math.exp(-s[0]))) - y, n * q * (1 - q)) for _, n, y, s in of]
        g, h = sum(a for a, _ in sums), sum(b for _, b in sums)
        best = (1e-6, -1, 0)
        if left:
            for f in range(n_features):
                hist = [[0.0, 0.0] for _ in range(len(cuts[f]) + 1)]
                for (p, *_), (a, b) in zip(of, sums, strict=True):
                    hist[p[f]][0] += a
                    hist[p[f]][1] += b
                gl = hl = 0.0
                for k in range(len(cuts[f])):
                    gl, hl = gl + hist[k][0], hl + hist[k][1]
                    if hl > 0 and h - hl > 0:
                        gain = gl * gl / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g * g / (h + ridge)
                        if gain > best[0]:
                            best = (gain, f, k)
        if best[1] < 0:
            value = -rate * g / (h + ridge)
            for x in of:
                x[3][0] += value
            return Node(value)
        _, f, k = best
        low, high = [x for x in of if x[0][f] <= k], [x for x in of if x[0][f] > k]
        return Node(0.0, f, cuts[f][k], grow(low, left - 1), grow(high, left - 1))

    for _ in range(n_trees):
        model.trees.append(grow(points, depth))
    return model


def train(rated: DataFrame, fitted: Column, max_train: int = 4096, **how) -> Trees:
    """Fits on the ``fitted`` rows, ``max_train`` at most where urls repeat."""
    picked = rated.filter(fitted).select(*FEATURES, (F.col("fixed") == "block").cast("int").alias("y"), F.xxhash64("url").alias("o"), "url")
    rows = picked.orderBy("o", "url").limit(max_train).drop("url", "o").collect()
    return fit([(list(r)[:-1], r[-1]) for r in rows], **how)


def judge(pages: DataFrame, rules=RULES, max_train: int = 4096) -> DataFrame:
    """page_id, host, path, rule, verdict and block_score (the trees' probability of ``block``)."""
    featured = materialize(with_features(pages, rules), "features")
    fitted = to_fit(featured, max_train)
    rated = with_rates(featured, fitted)
    margin = train(rated, fitted, max_train).column()
    scored = rated.withColumn("block_score", 1 / (1 + F.exp(-margin)))
    verdict = F.coalesce("fixed", F.when(F.col("block_score") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")

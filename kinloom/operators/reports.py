"""Statistics over records, results and clusters, each as one small table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank


def record_stats(df: DataFrame) -> DataFrame:
    """One row: records, in clusters, clusters, singletons, unique entities and the share of duplicates."""
    dup, n = F.count_if(F.col("cluster_id") != -1), F.count(F.lit(1))
    clusters = F.countDistinct(F.when(F.col("cluster_id") != -1, F.col("cluster_id")))
    return df.agg(n.alias("total"), dup.alias("in_clusters"), clusters.alias("clusters"), (n - dup).alias("singletons"), (n - dup + clusters).alias("unique_entities"), F.round(100.0 * dup / n, 1).alias("duplicate_pct"))


def fill_rates(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, filled, empty and pct (one decimal)."""
    filled = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(~blank(F.col(f))).alias(f) for f in fields))
    rows = filled.select("n", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("filled")) for f in fields))).alias("x"))
    return rows.select("x.field", "x.filled", (F.col("n") - F.col("x.filled")).alias("empty"), F.round(F.col("x.filled") * 100.0 / F.col("n"), 1).alias("pct"))


def recommendation_stats(results: DataFrame) -> DataFrame:
    return results.groupBy("recommendation").agg(F.count(F.lit(1)).alias("n"))


def score_bands(results: DataFrame, column: str) -> DataFrame:
    """Rows by band of a score in steps of five."""
    s = F.col(column)
    band = F.when(s == 100, "100").when(s >= 90, "90-95").when(s >= 80, "80-85").when(s >= 70, "70-75").otherwise("<70")
    return results.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


def match_summary(results: DataFrame) -> DataFrame:
    """One row over the matcher's results."""
    n = F.count(F.lit(1))
    return results.agg(
        n.alias("total"), F.countDistinct("ssn_masked").alias("distinct_ssn"), F.sum("is_trust").alias("trusts"), F.round(100.0 * F.sum("is_trust") / n, 1).alias("trust_pct"),
        F.count_if(F.col("match_count") > 1).alias("multi_match"), F.max("match_count").alias("max_matches"), F.count("name_boost_source").alias("boosted"),
    )


def top_states(df: DataFrame, n: int = 10) -> DataFrame:
    return df.filter(~blank(F.col("state"))).groupBy("state").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "state").limit(n)


def group_report(df: DataFrame) -> DataFrame:
    """Each cluster with its size, its names in id order, and the largest and mean score. A row holds its cluster's names:
    the report is for clusters that a person can read. Scores are added in id order too: a sum of doubles depends on its
    order, and where the mean lies between two decimals the rounding shows it."""
    rows = F.array_sort(F.collect_list(F.struct("record_id", "name", "similarity_score")))
    total = F.aggregate(F.col("rows"), F.lit(0.0), lambda a, x: a + F.coalesce(x["similarity_score"].cast("double"), F.lit(0.0)))
    out = df.filter("cluster_id <> -1").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), rows.alias("rows"), F.round(F.max("similarity_score") * 100, 1).alias("max_score"), F.count("similarity_score").alias("scored"))
    mean = F.when(F.col("scored") > 0, total / F.col("scored"))
    return out.select("cluster_id", "n", F.array_join(F.transform("rows", lambda x: x["name"]), ",").alias("names"), "max_score", F.round(mean * 100, 1).alias("avg_score"))


def size_histogram(df: DataFrame) -> DataFrame:
    """How many clusters have each size."""
    sizes = df.filter("cluster_id <> -1").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("clusters"))


def savings(n_rows: Column, n_pairs: Column) -> Column:
    """Share of all pairs that blocking spares, in percent with one decimal."""
    every = n_rows * (n_rows - 1) / 2
    return F.round(100 * (1 - n_pairs / every), 1)


def summary(results: DataFrame, buckets: list[str], sources: list[str]) -> DataFrame:
    """(section, metric, value) over the matcher's results, from one aggregate: totals, recommendations, boosts, trusts,
    multiple matches and the distribution of name scores among matched rows."""
    n, hit, trust, s = F.count(F.lit(1)), F.col("ssn_match") == 100, F.col("is_trust") == 1, F.col("name_score")
    count = F.count_if
    cells = [
        ("OVERALL", "records", n), ("OVERALL", "distinct identifiers", F.countDistinct(F.when(F.col("ssn_masked") != "", F.col("ssn_masked")))), ("OVERALL", "matched", count(hit)), ("OVERALL", "not matched", count(~hit)),
        *(("BY RECOMMENDATION", b, count(F.col("recommendation") == b)) for b in buckets),
        ("NAME BOOST", "boosted", count(hit & F.col("name_boost_source").isNotNull())), *(("NAME BOOST", b, count(hit & (F.col("name_boost_source") == b))) for b in sources),
        ("TRUST", "trusts", count(trust)), ("TRUST", "matched trusts", count(trust & hit)), ("TRUST", "unmatched trusts", count(trust & ~hit)), ("TRUST", "percent of records", F.round(100.0 * count(trust) / F.greatest(n, F.lit(1)), 1)),
        ("DUPLICATE RISK", "multiple matches", count(hit & (F.col("match_count") > 1))), ("DUPLICATE RISK", "possible address matches", count(F.col("possible_address_matches") > 0)),
        ("DUPLICATE RISK", "mean matches", F.round(F.avg(F.when(hit, F.col("match_count"))), 1)), ("DUPLICATE RISK", "most matches", F.max(F.when(hit, F.col("match_count")))),
        *(("NAME SCORES", b, count(hit & w)) for b, w in (("100", s == 100), ("90-95", s.between(90, 95)), ("80-85", s.between(80, 85)), ("70-75", s.between(70, 75)), ("<70", s < 70))),
    ]
    row = results.agg(*(v.cast("double").alias(f"v{k}") for k, (_, _, v) in enumerate(cells)))
    out = F.array(*(F.struct(F.lit(a).alias("section"), F.lit(b).alias("metric"), F.col(f"v{k}").alias("value")) for k, (a, b, _) in enumerate(cells)))
    return row.select(F.explode(out).alias("x")).select("x.*")


def text_report(rows: DataFrame) -> str:
    """A summary's rows as lines of text, section by section; a summary has a fixed number of rows."""
    lines, now = [], None
    for r in rows.collect():
        if r.section != now:
            now = r.section
            lines += ["", now, "-" * len(now)]
        lines.append(f"{r.metric:<36}{'' if r.value is None else f'{r.value:g}':>12}")
    return "\n".join(lines).strip() + "\n"

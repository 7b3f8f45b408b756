"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Every document draws an exponential key ``-ln(u) / weight`` (u from a hash of its id, weight from its quality label).
Within its source, documents stand by key, and prefix sums of their sizes run up to the source's target: whole epochs
first (everything once, or twice, ...), then the documents with the smallest keys. The document on the target's edge
gives only as many words as are left, so a source's taken words are its target rounded down.

A source may hold a third of all rows, so no window runs over a source: keys are cut into ranges that the key's
distribution function (a mixture, by how many documents have each weight) makes about equal. A source has its share of
``8 * partitions`` ranges, and more where a range would exceed ``range_rows``; sizes are summed by range, ranges are
prefix-summed (a window over a few numbers), and only rows of one range are sorted together.

Targets: sources stand by code point, null last, and take the weights in turn. A source cannot be taken more than
``max_epochs`` times; what it leaves is shared by weight among the rest. This is water-filling, solved in closed form
over the table of sources (one row each).

Null text: size 0, taken 0. Null source: a source of its own. A row without an id draws its key from its text, rows
with one id share a key; size breaks ties, and rows that tie in both are alike. A document without a label or with a
null quality has weight 1. An empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions

WEIGHTS = (1, 2, 3)
#: Weight of a document by its quality label; no label: 1.
QUALITY = {1: 2.0, 0: 0.5}


def size_of(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1).cast("long")


def uniform(key: Column, seed: str) -> Column:
    """In (0, 1), from 52 bits of an md5: the same in every engine that has md5."""
    digest = F.md5(F.concat(F.lit(seed), key).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = 3) -> DataFrame:
    """source, n_docs, source_size, target from one row (source, n_docs, source_size) for each source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*(F.lit(float(w)) for w in weights))[(F.row_number().over(by_name) - 1) % len(weights)]
    rows = sizes.withColumn("w", turn).withColumn("most", F.col("source_size") * max_epochs)
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before, after = filled.rowsBetween(Window.unboundedPreceding, -1), filled.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("all", F.sum("source_size").over(everything))
    level = (F.col("all") - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("w").over(after)
    rows = rows.withColumn("level", F.when(level <= F.col("most") / F.col("w"), level))
    rows = rows.withColumn("level", F.max("level").over(everything))  # the first source that is not full has the largest
    target = F.least(F.col("most").cast("double"), F.col("level") * F.col("w"))
    return rows.select(*sizes.columns, F.coalesce(target, F.col("most").cast("double")).alias("target"))


def mix(docs: DataFrame, labels: DataFrame | None = None, seed: str = "mix", weights=WEIGHTS, max_epochs: int = 3, range_rows: int = 1_000_000) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every row of ``docs``."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), uniform(name, seed).alias("u"))
    weight = F.lit(1.0)
    if labels is not None:
        graded = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        rows = rows.join(graded, "doc_id", "left")
        weight = F.coalesce(*(F.when(F.col("quality") == k, v) for k, v in QUALITY.items()), F.lit(1.0))
    rows = materialize(rows.select("doc_id", "source", "size", (-F.log("u") / weight).alias("key"), weight.alias("weight")), "keyed")
    known = sorted({1.0, *QUALITY.values()})
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"), F.array(*(F.count_if(F.col("weight") == w) for w in known)).alias("having"))
    plan = targets(counts, weights, max_epochs)
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.floor("target").cast("long") - F.col("epochs") * F.col("source_size"))
    share = F.col("n_docs") / F.sum("n_docs").over(Window.partitionBy())
    plan = plan.withColumn("ranges", F.greatest(F.ceil(8 * partitions(docs.sparkSession) * share), F.ceil(F.col("n_docs") / range_rows)))
    # The distribution function grows with the key, so its ranges are ranges of keys; they need not be quite equal.
    above = sum((F.col("having")[k] * F.exp(-w * F.col("key")) for k, w in enumerate(known)), F.lit(0.0))
    part = F.greatest(F.lit(0), F.least(F.floor((1 - above / F.col("n_docs")) * F.col("ranges")), F.col("ranges") - 1))
    rows = rows.join(plan, rows.source.eqNullSafe(plan.source)).drop(plan.source).withColumn("part", part)
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("ahead"))
    rows = rows.join(sums, rows.source.eqNullSafe(sums.s) & (rows.part == sums.p)).drop("s", "p")
    within = Window.partitionBy("source", "part").orderBy("key", F.col("doc_id"), "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0))
    part_taken = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - ahead))
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part_taken).cast("long").alias("taken"))


SQL = r"""
WITH sized AS (
  SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, l.quality, coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, ''))) AS name
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY 1) l USING (doc_id)
), keyed AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5('mix' || name), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
      / CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS key
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM keyed GROUP BY source
), poured AS (
  SELECT *, source_size * 3 AS most,
    (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(w) OVER (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), planned AS (
  SELECT source, source_size, coalesce(least(most::DOUBLE, (max(level) FILTER (level <= most / w) OVER ()) * w), most::DOUBLE) AS target FROM poured
), ordered AS (
  SELECT k.doc_id, k.size, p.source_size, p.target,
    CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size)::BIGINT ELSE 0 END AS epochs,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM keyed k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - ahead)))::BIGINT AS taken
FROM ordered
"""

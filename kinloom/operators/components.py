"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round over (a, b), a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.filter("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    out = small.select("b", "m").union(least.select(F.col("a").alias("b"), "m"))
    return out.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def connected_components(edges: DataFrame, a: str = "id_a", b: str = "id_b", max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id that is reachable, for every id that an edge with two different ends holds.

    Every round is written to the shared folder, so lineage stays short; the driver sees only a count and a checksum.
    Nulls and loops are ignored, repeated and reversed edges count once."""
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = edges.filter(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    now = materialize(now, "edges")
    seen = None
    for k in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select("b", F.col("b").alias("component")).distinct())
        seen = mark
        before, now = now, materialize(_stars(now), f"stars{k}")
        discard(before)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

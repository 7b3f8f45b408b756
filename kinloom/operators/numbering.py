"""Consecutive numbers for the rows of a large table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def numbered(df: DataFrame, *order: str | Column, name: str = "number") -> DataFrame:
    """Adds ``name``: 0, 1, 2 and so on in the given order. Rows are dealt to ranges of the order and stored with their
    range, ranges are counted and summed up (one row each), and only the rows of one range are sorted together. Rows
    that tie get their numbers in any order; an empty table stays empty."""
    ranges = materialize(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select("__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__ahead"))
    within = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - 1
    return ranges.join(F.broadcast(ahead), "__range").withColumn(name, F.col("__ahead") + within).drop("__range", "__ahead")

"""Rows that cannot have a duplicate, and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import numbered


def split_unique(df: DataFrame, key: Column) -> DataFrame:
    """Adds key_count and needs_dedup: whether another row has the key. Rows without a key need it too. The count is
    an aggregate that joins back, so no window holds the rows of a frequent key."""
    keyed = df.withColumn("__k", F.when(key != "", key))
    counts = keyed.filter("__k is not null").groupBy("__k").agg(F.count(F.lit(1)).alias("key_count"))
    out = keyed.join(counts, "__k", "left").withColumn("key_count", F.coalesce("key_count", F.lit(0))).drop("__k")
    return out.withColumn("needs_dedup", F.col("key_count") != 1)


def batches(df: DataFrame, size: int, order: str = "record_id") -> DataFrame:
    """Adds batch_id: contiguous slices of ``size`` rows by id."""
    return numbered(df, order, name="__n").withColumn("batch_id", F.floor(F.col("__n") / size).cast("int")).drop("__n")

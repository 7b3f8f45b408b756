"""Merge history as append-only tables: operations, record versions and relationships. What is undone follows from the
operations; nothing is updated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import numbered

DDL = [
    "CREATE TABLE IF NOT EXISTS ba_merge_operations (operation_id BIGINT, operation_timestamp TIMESTAMP, operation_type STRING, user_id STRING, cluster_id BIGINT, record_count BIGINT, golden_record_id BIGINT, undoes BIGINT, notes STRING) USING parquet",
    "CREATE TABLE IF NOT EXISTS ba_record_versions (operation_id BIGINT, record_id BIGINT, version_timestamp TIMESTAMP, version_type STRING, record_data STRING) USING parquet",
    "CREATE TABLE IF NOT EXISTS ba_merge_relationships (operation_id BIGINT, source_record_id BIGINT, target_record_id BIGINT, similarity_score DOUBLE) USING parquet",
]


def record_merges(clustered: DataFrame, golden: DataFrame, user: str, at: Column, first_id: int = 0, kind: str = "auto_merge") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(operations, versions, relationships) of merging each cluster. Ids are ``first_id`` plus the rank of the
    cluster; ranks come from a table of one row for each cluster."""
    rows = clustered.filter("cluster_id <> -1")
    target = golden.filter("cluster_id <> -1").select("cluster_id", F.col("record_id").alias("golden_record_id"))
    ops = rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("record_count")).join(target, "cluster_id")
    ops = numbered(ops, "cluster_id", name="place").withColumn("operation_id", F.col("place") + 1 + first_id)
    ops = ops.select("operation_id", at.cast("timestamp").alias("operation_timestamp"), F.lit(kind).alias("operation_type"), F.lit(user).alias("user_id"), "cluster_id", "record_count", "golden_record_id", F.lit(None).cast("long").alias("undoes"), F.lit(None).cast("string").alias("notes"))
    key = ops.select("cluster_id", "operation_id", "golden_record_id", "operation_timestamp")
    snap = lambda df, what: df.join(key, "cluster_id").select("operation_id", "record_id", F.col("operation_timestamp").alias("version_timestamp"), F.lit(what).alias("version_type"), F.to_json(F.struct(*(F.col(c) for c in df.columns)), {"ignoreNullFields": "false"}).alias("record_data"))
    versions = snap(rows, "before_merge").unionByName(snap(golden.filter("cluster_id <> -1"), "golden"))
    links = rows.join(key, "cluster_id").select("operation_id", F.col("record_id").alias("source_record_id"), F.col("golden_record_id").alias("target_record_id"), F.col("similarity_score").cast("double").alias("similarity_score"))
    return ops, versions, links


def with_state(ops: DataFrame) -> DataFrame:
    """Operations with is_undone and undone_by_operation_id."""
    undo = ops.filter("undoes is not null").groupBy("undoes").agg(F.min("operation_id").alias("undone_by_operation_id"))
    out = ops.join(undo.withColumnRenamed("undoes", "operation_id"), "operation_id", "left")
    return out.withColumn("is_undone", F.col("undone_by_operation_id").isNotNull())


def undo(ops: DataFrame, versions: DataFrame, which: Column, user: str, at: Column, schema: str) -> tuple[DataFrame, DataFrame]:
    """(undo operations to append, restored records): for the merges that ``which`` picks and nobody undid. A record in
    several of them comes back as its earliest snapshot."""
    hit = with_state(ops).filter((F.col("operation_type") != "undo") & ~F.col("is_undone") & which)
    last = ops.agg(F.max("operation_id").alias("m"))
    made = numbered(hit, F.desc("operation_id"), name="place").crossJoin(F.broadcast(last)).select(
        (F.col("m") + F.col("place") + 1).alias("operation_id"), at.cast("timestamp").alias("operation_timestamp"), F.lit("undo").alias("operation_type"), F.lit(user).alias("user_id"),
        "cluster_id", "record_count", "golden_record_id", F.col("operation_id").alias("undoes"), F.lit(None).cast("string").alias("notes"),
    )
    old = versions.filter("version_type = 'before_merge'").join(hit.select("operation_id"), "operation_id")
    first = old.groupBy("record_id").agg(F.min_by("record_data", "operation_id").alias("record_data"))
    return made, first.select(F.from_json("record_data", schema).alias("r")).select("r.*")


def rollback(ops: DataFrame, versions: DataFrame, moment: Column, user: str, at: Column, schema: str) -> tuple[DataFrame, DataFrame]:
    """Undoes all merges after ``moment``."""
    return undo(ops, versions, F.col("operation_timestamp") > moment, user, at, schema)


def history(ops: DataFrame, links: DataFrame, record_id: int | None = None, cluster_id: int | None = None, limit: int = 100) -> DataFrame:
    """The latest operations, of one record or cluster or of all."""
    out = with_state(ops)
    if record_id is not None:
        mine = links.filter((F.col("source_record_id") == record_id) | (F.col("target_record_id") == record_id)).select("operation_id").distinct()
        out = out.join(mine, "operation_id")
    if cluster_id is not None:
        out = out.filter(F.col("cluster_id") == cluster_id)
    return out.orderBy(F.desc("operation_timestamp"), F.desc("operation_id")).limit(limit)


def audit_trail(ops: DataFrame, links: DataFrame, start: Column | None = None, end: Column | None = None, user: str | None = None) -> DataFrame:
    """Operations in a span of time with the number of different records each affected."""
    out = with_state(ops)
    for cond in (start is not None and F.col("operation_timestamp") >= start, end is not None and F.col("operation_timestamp") <= end, user is not None and F.col("user_id") == user):
        out = out if cond is False else out.filter(cond)
    n = links.groupBy("operation_id").agg(F.countDistinct("source_record_id").alias("affected_records"))
    return out.join(n, "operation_id", "left").withColumn("affected_records", F.coalesce("affected_records", F.lit(0)))


def compare_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """record_id, field, old and new of fields that differ between two sets of versions of the same records."""
    fields = lambda df, n: df.select("record_id", F.explode(F.from_json("record_data", "map<string,string>")).alias("field", n))
    both = fields(old, "old_value").join(fields(new, "new_value"), ["record_id", "field"], "full")
    return both.filter(~F.col("old_value").eqNullSafe(F.col("new_value")))

"""Clusters to golden records. Order always ends in record_id, so every result is determined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.records import completeness
from ..functions.text import blank, digits
from ..session import materialize
from .components import connected_components
from .numbering import numbered


def assign_clusters(df: DataFrame, scored: DataFrame, dense: bool = False) -> DataFrame:
    """cluster_id (smallest record_id of the component, -1 for singletons) and similarity_score (best pair's)."""
    scored = materialize(scored, "scored")
    found = connected_components(scored).withColumnRenamed("id", "record_id").withColumnRenamed("component", "cluster_id")
    if dense:
        places = numbered(found.select("cluster_id").distinct(), "cluster_id", name="place")
        found = found.join(places, "cluster_id").select("record_id", F.col("place").cast("long").alias("cluster_id"))
    best = best_score(scored)
    out = df.join(found, "record_id", "left").join(best, "record_id", "left")
    return out.withColumns({"cluster_id": F.coalesce("cluster_id", F.lit(-1).cast("long")), "similarity_score": F.coalesce("similarity_score", F.lit(0.0))})


def best_score(scored: DataFrame) -> DataFrame:
    """record_id and the largest score of its pairs."""
    ends = scored.select(F.explode(F.array("id_a", "id_b")).alias("record_id"), F.col("score").cast("double").alias("score"))
    return ends.groupBy("record_id").agg(F.max("score").alias("similarity_score"))


def best_reason(scored: DataFrame, column: str) -> DataFrame:
    """record_id and ``column`` of its best pair; of ties the pair with the smallest ids."""
    ends = scored.select(F.explode(F.array("id_a", "id_b")).alias("record_id"), "score", "id_a", "id_b", column)
    first = F.min_by(column, F.struct(-F.col("score"), "id_a", "id_b"))
    return ends.groupBy("record_id").agg(first.alias(column))


def rank_in_cluster(order: list[Column], cluster: str = "cluster_id") -> Column:
    return F.row_number().over(Window.partitionBy(cluster).orderBy(*order, "record_id"))


def _group(cluster: str) -> Column:
    """The cluster, and a group of its own for each singleton."""
    return F.when(F.col(cluster) == -1, -F.col("record_id") - 2).otherwise(F.col(cluster))


def most_complete(df: DataFrame, fields=V.COMPLETENESS_FIELDS, cluster: str = "cluster_id", fill: bool = True) -> DataFrame:
    """One row a cluster: the record with the most filled fields. With ``fill``, its blanks come from the first record
    that has a value, and a plain zip becomes the first ZIP+4 with the same five digits. Singletons pass."""
    done = df.withColumn("__c", completeness(fields)).withColumn("__g", _group(cluster))
    done = done.withColumn("__r", rank_in_cluster([F.desc("__c")], "__g"))
    if not fill:
        return done.filter("__r = 1").drop("__c", "__g", "__r")
    text = [c for c, t in df.dtypes if t == "string"]
    filled = lambda c: F.when(~blank(F.col(c)), F.col("record_id"))
    first = done.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"), *(F.min_by(c, filled(c)).alias(f"__f_{c}") for c in text))
    out = done.filter("__r = 1").join(first, "__g").withColumns({c: F.when(blank(F.col(c)), F.coalesce(f"__f_{c}", F.col(c))).otherwise(F.col(c)) for c in text})
    if "zip" in text:  # a plain zip meets the cluster's first longer one with its five digits
        five = F.substring(digits(F.col("zip")), 1, 5)
        longer = df.withColumn("__g", _group(cluster)).filter(F.col("zip").contains("-")).groupBy("__g", five.alias("__b")).agg(F.min_by(F.trim("zip"), "record_id").alias("__l"))
        out = out.withColumn("__b", five).join(longer, ["__g", "__b"], "left")
        out = out.withColumn("zip", F.when(~F.col("zip").contains("-") & (F.col("__b") != ""), F.coalesce("__l", F.col("zip"))).otherwise(F.col("zip")))
    return out.select(*df.columns)


def most_recent(df: DataFrame, column: str = "updated_date", cluster: str = "cluster_id") -> DataFrame:
    return df.withColumn("__r", rank_in_cluster([F.desc_nulls_last(column)], cluster)).filter("__r = 1").drop("__r")


def first_record(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return df.withColumn("__r", rank_in_cluster([], cluster)).filter("__r = 1").drop("__r")


def best_values(df: DataFrame, fields: list[str], cluster: str = "cluster_id") -> DataFrame:
    """The most frequent filled value of each field, the smallest of ties; empty where none is filled."""
    pick = lambda f: F.coalesce(F.mode(F.when(~blank(F.col(f)), F.col(f)), True), F.lit(""))
    return df.groupBy(cluster).agg(*(pick(f).alias(f) for f in fields))


def merge_all(df: DataFrame, strategy: str = "most_complete", **how) -> tuple[DataFrame, DataFrame]:
    """(golden, all locations): one record a cluster beside the singletons, and every record of every cluster."""
    pick = {"most_complete": most_complete, "most_recent": most_recent, "first": first_record}[strategy]
    clustered = df.filter("cluster_id <> -1")
    golden = pick(clustered, **how).unionByName(df.filter("cluster_id = -1"), allowMissingColumns=True)
    return golden, clustered


def merge_audit(df: DataFrame, strategy: str) -> DataFrame:
    ids = F.array_sort(F.collect_list("record_id"))
    return df.filter("cluster_id <> -1").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("source_record_count"), ids.alias("source_record_ids")).withColumn("merge_strategy", F.lit(strategy))


def cluster_stats(df: DataFrame, fields=V.COMPLETENESS_FIELDS) -> DataFrame:
    done = df.filter("cluster_id <> -1").withColumn("__c", completeness(fields))
    has = lambda f: F.bool_or(F.col(f).isNotNull()).alias(f"has_{f}")
    return done.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"), F.avg("__c").alias("avg_completeness"), F.max("__c").alias("max_completeness"), has("phone"), has("email"), has("address"))


def merge_summary(df: DataFrame) -> DataFrame:
    """First name, up to five different names, and the count of each cluster of two or more."""
    names = df.filter("cluster_id <> -1").groupBy("cluster_id", "name").agg(F.min("record_id").alias("f"), F.count(F.lit(1)).alias("n"))
    names = names.withColumn("r", F.row_number().over(Window.partitionBy("cluster_id").orderBy("f")))
    five = F.transform(F.array_sort(F.collect_list(F.when(F.col("r") <= 5, F.struct("r", "name")))), lambda x: x["name"])
    out = names.groupBy("cluster_id").agg(F.min_by("name", "f").alias("first_name"), F.array_join(five, " | ").alias("all_names"), F.sum("n").alias("record_count"))
    return out.filter("record_count > 1")


def cluster_records(df: DataFrame, cluster_id) -> DataFrame:
    """The records of one cluster, or of those in a table of cluster ids."""
    return df.join(cluster_id, "cluster_id", "left_semi") if isinstance(cluster_id, DataFrame) else df.filter(F.col("cluster_id") == cluster_id)


def similarity_to_first(df: DataFrame, scored: DataFrame) -> DataFrame:
    """Each member's score against its cluster's first member; 100 for that one, null where they were not scored."""
    first = F.min("record_id").over(Window.partitionBy("cluster_id"))
    rows = df.filter("cluster_id <> -1").select("record_id", "cluster_id", first.alias("first_id"))
    s = scored.select("id_a", "id_b", F.col("score").alias("s"))
    got = rows.join(s, (F.least("record_id", "first_id") == F.col("id_a")) & (F.greatest("record_id", "first_id") == F.col("id_b")), "left")
    return got.select("record_id", "cluster_id", "first_id", F.when(F.col("record_id") == F.col("first_id"), 100.0).otherwise(F.col("s").cast("double")).alias("similarity"))


def exact_names(df: DataFrame, fields=V.COMPLETENESS_FIELDS) -> DataFrame:
    """One record for each upper-cased name: the most complete one. Blank names are one name like any other."""
    keyed = df.withColumn("__k", F.upper(F.trim("name"))).withColumn("__c", completeness(fields))
    return keyed.withColumn("__r", rank_in_cluster([F.desc("__c")], "__k")).filter("__r = 1").drop("__k", "__c", "__r")

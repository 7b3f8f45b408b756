"""Writing records: tables, archives, files. No sink changes rows in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import drop_working_columns

MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def write_table(df: DataFrame, name: str, if_exists: str = "append") -> bool:
    """Writes unless ``df`` is empty; appending to a missing table makes it. Whether anything was written."""
    if if_exists not in MODES:
        raise ValueError(f"if_exists is one of {', '.join(MODES)}")
    if df.isEmpty():
        return False
    df.write.mode(MODES[if_exists]).saveAsTable(name)
    return True


def truncate(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def drop(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def add_columns(spark: SparkSession, name: str, columns: dict[str, str]) -> list[str]:
    """Adds the columns that the table lacks; returns their names."""
    have = {c.lower() for c in spark.table(name).columns}
    new = {c: t for c, t in columns.items() if c.lower() not in have}
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{c} {t}' for c, t in new.items())})")
    return list(new)


def archive_and_replace(df: DataFrame, name: str, archive: str, run_id: str) -> None:
    """Appends what the table holds to the archive, then replaces it with ``df`` and its run id."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        spark.table(name).write.mode("append").option("mergeSchema", True).saveAsTable(archive)
    df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").saveAsTable(name)


def export_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts with headers; working columns go, arrays are joined."""
    df = drop_working_columns(df)
    flat = [F.array_join(F.transform(c, lambda x: x.cast("string")), ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_all(golden: DataFrame, clustered: DataFrame, audit: DataFrame, folder: str) -> dict[str, str]:
    """Golden records, the duplicate report by cluster, and the audit, each in a folder of its own."""
    paths = {k: f"{folder}/{k}" for k in ("golden", "duplicates", "audit")}
    export_csv(golden, paths["golden"])
    export_csv(clustered.orderBy("cluster_id", "record_id"), paths["duplicates"])
    export_csv(audit, paths["audit"])
    return paths


def grouped_review(df: DataFrame) -> DataFrame:
    """The review file's rows: each cluster's records together, singletons marked as such."""
    kind = F.when(F.col("cluster_id") == -1, "Single record").otherwise("Potential duplicate group")
    return df.select(kind.alias("group_type"), "cluster_id", "record_id", "name", "city", "state", "similarity")


#: The order of each kind of output.
ORDERS = {"matches": ["recommendation", "record_id"], "golden": ["cluster_id", "state", "city", "record_id"], "review": ["needs_review", "cluster_id", "state", "city", "record_id"]}


def in_order(df: DataFrame, kind: str) -> DataFrame:
    return df.orderBy(*ORDERS[kind])

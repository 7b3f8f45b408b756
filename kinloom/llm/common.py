"""What the operators of this subpackage share: the shared work folder, materialised tables, row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, work_dir

__all__ = ["free_name", "materialize", "partitions", "table", "text_bytes", "tune", "work_dir"]

ARROW_ROWS = 256  # rows of an Arrow batch: with texts of up to 1 MB a batch stays far below an executor's memory


def tune(spark: SparkSession) -> None:
    """Bounds the rows of an Arrow batch for this session; texts are long, so bytes and not rows fill a batch. It is a
    bound and not a choice of speed: a session that already has a smaller one keeps it, and it may be raised again once
    the result has been read."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """A text as UTF-8 bytes, null as none."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(columns: list[str], wish: str) -> str:
    """A name for a working column that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    while wish in taken:
        wish += "_"
    return wish

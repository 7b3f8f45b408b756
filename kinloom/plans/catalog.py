"""All queries of the engine, by module."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import q_functions, q_more, q_operators  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name dedup end to end: parse, block, score, cluster."""
    return QUERIES["m15_name_dedup"](spark, sf_dir)

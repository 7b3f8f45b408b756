"""ZIP lookups from a small table; the first entry of a city counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank

# The built-in places (zip, city, state, county), in order.
PLACES = [
    ("62701", "Springfield", "IL", "Sangamon"), ("62702", "Springfield", "IL", "Sangamon"), ("60601", "Chicago", "IL", "Cook"), ("60602", "Chicago", "IL", "Cook"),
    ("77459", "Missouri City", "TX", "Fort Bend"), ("77489", "Missouri City", "TX", "Fort Bend"), ("77001", "Houston", "TX", "Harris"), ("75001", "Dallas", "TX", "Dallas"),
    ("90001", "Los Angeles", "CA", "Los Angeles"), ("94102", "San Francisco", "CA", "San Francisco"), ("10001", "New York", "NY", "New York"), ("10002", "New York", "NY", "New York"),
    ("30301", "Atlanta", "GA", "Fulton"), ("33101", "Miami", "FL", "Miami-Dade"), ("02101", "Boston", "MA", "Suffolk"), ("98101", "Seattle", "WA", "King"),
]


def places(spark: SparkSession, rows=PLACES) -> DataFrame:
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "ord int, zip string, city string, state string, county string")


def enrich(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Blank zips from city and state, blank cities and states from the zip, with where each came from."""
    by_city = dim.groupBy(F.lower(F.trim("city")).alias("__c"), F.upper(F.trim("state")).alias("__s")).agg(F.min_by("zip", "ord").alias("__z"))
    by_zip = dim.groupBy(F.col("zip").alias("__zip")).agg(F.min_by("city", "ord").alias("__zc"), F.min_by("state", "ord").alias("__zs"))
    x = df.join(by_city, (F.lower(F.trim("city")) == F.col("__c")) & (F.upper(F.trim("state")) == F.col("__s")), "left").join(by_zip, F.substring("zip", 1, 5) == F.col("__zip"), "left")
    out = {}
    for c, found in (("zip", "__z"), ("city", "__zc"), ("state", "__zs")):
        out[c] = F.when(blank(F.col(c)), F.coalesce(F.col(found), F.col(c))).otherwise(F.col(c))
        out[f"{c}_source"] = F.when(~blank(F.col(c)), "original").when(F.col(found).isNotNull(), "lookup").otherwise("missing")
    return x.withColumns(out).select(*df.columns, "zip_source", "city_source", "state_source")

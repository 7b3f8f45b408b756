"""What pairs of large blocks cost in disk: the files between stages, and the written table."""

from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinloom.operators import blocking
from kinloom.plans import q_operators
from kinloom.plans.catalog import QUERIES


def shuffled(spark):
    """Bytes of the shuffle files that are there."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(f.length() for f in map(files.apply, range(files.size())) if f.getName().startswith("shuffle_"))


def test_tiles_are_sent_packed(spark):
    """60,000 rows of one block meet as many tiles; a row is sent for each of them, as less than a byte or two."""
    df = spark.range(60_000).selectExpr("id * 7 + pmod(hash(id), 7) as record_id", "'a' as zip_normalized")
    pairs = blocking.by_zip(df)
    before = shuffled(spark)
    assert len(pairs.take(1)) == 1
    assert shuffled(spark) - before < 2_000_000


def test_written_name_token_pairs_are_small(spark, monkeypatch, tmp_path):
    """One token on 8000 rows: 31,996,000 pairs as a Parquet table."""
    rows = spark.range(8000).selectExpr("id * 7 + pmod(hash(id), 7) as record_id", "'Bill Smith' as name")
    monkeypatch.setattr(q_operators, "valid", lambda spark, d: rows)
    QUERIES["j09_name_token_pairs"](spark, "").write.parquet(out := str(tmp_path / "pairs"))
    written = spark.read.parquet(out)
    assert written.count() == 8000 * 7999 // 2
    assert written.filter("id_a >= id_b").isEmpty()
    assert sum(p.stat().st_size for p in Path(out).glob("*.parquet")) < 0.18 * 8000 * 7999 // 2


@pytest.mark.parametrize("tile", [1, 3, 700])
def test_ids_of_any_size(spark, monkeypatch, tile):
    """Negative ids, gaps of more than 16, 32 and 63 bits, tiles and runs of one row."""
    monkeypatch.setattr(blocking, "TILE", tile)
    monkeypatch.setattr(blocking, "RUN", 2, raising=False)
    ids = {"a": [-(2**63), -70_000, -1, 0, 1, 300, 70_000, 2**40, 2**63 - 1], "b": [5], "c": [*range(7, 40, 3)], "d": [2**62, 2**62 + 256]}
    df = spark.createDataFrame([(k, b) for b, x in ids.items() for k in x], "record_id bigint, zip_normalized string")
    got = blocking.by_zip(df).collect()
    assert sorted(map(tuple, got)) == sorted(p for x in ids.values() for p in combinations(x, 2))


def test_small_tiles_are_work_for_many_tasks(spark, monkeypatch):
    """Packed tiles are small enough for a broadcast; their pairs are made in many tasks all the same."""
    monkeypatch.setattr(blocking, "TILE", 256)
    df = spark.range(4000).selectExpr("id as record_id", "'a' as zip_normalized")
    pairs = blocking.by_zip(df)
    assert pairs.count() == 4000 * 3999 // 2
    assert pairs.groupBy(F.spark_partition_id()).count().count() >= 16


def test_large_state_is_dealt_evenly(spark, monkeypatch):
    """One state on 3200 rows in 100 tiles: the last rows meet all others in several tasks, not in one."""
    monkeypatch.setattr(blocking, "TILE", 32)
    rows = spark.range(3200).selectExpr("id as record_id", "'TX' as state")
    monkeypatch.setattr(q_operators, "valid", lambda spark, d: rows)
    pairs = QUERIES["j13_all_pairs_in_state"](spark, "")
    last = pairs.filter("id_b >= 3168").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in last) == 32 * 3168 + 32 * 31 // 2
    assert len(last) > 4

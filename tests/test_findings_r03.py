"""What the review of round 3 found, on tables small enough for a test."""

from itertools import combinations

import pyarrow as pa
import pytest

from kinloom.operators import blocking, scoring, tiles
from kinloom.plans import q_operators
from kinloom.plans.catalog import QUERIES


def test_pairs_leave_a_task_in_small_batches(monkeypatch):
    """400 rows of one block: 79,800 pairs of one tile, each once, in batches of 1000 and not in one."""
    monkeypatch.setattr(tiles, "BATCH", 1000, raising=False)
    rows = [[{"id": k, "by_ssn": "x", "f": f"n{k % 3}"} for k in range(400)]]
    packed = next(tiles._pack([pa.RecordBatch.from_pydict({"s": [0], "k": ["x"], "t": [0], "parts": [1], "rows": rows})])).column("tile")
    met = pa.RecordBatch.from_pydict({"s": [0], "same": [True], "left": packed, "right": packed})
    out = list(tiles._meet([met], ["by_ssn"], scoring.MeanScorer(0.0, ["f"]), False))
    assert max(b.num_rows for b in out) <= 1000
    pairs = [p for b in out for p in zip(b.column("id_a").to_pylist(), b.column("id_b").to_pylist(), strict=True)]
    assert len(pairs) == len({*pairs}) == 400 * 399 // 2


def from_python(spark):
    """Bytes that Python workers have returned to Spark in all queries so far."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    total, runs = 0.0, store.executionsList()
    for x in map(runs.apply, range(runs.size())):
        values = store.executionMetrics(x.executionId())
        for m in map(x.metrics().apply, range(x.metrics().size())):
            if m.name() == "data returned from Python workers" and values.contains(m.accumulatorId()):
                size, unit = values.apply(m.accumulatorId()).split("\n")[-1].split()[:2]
                total += float(size.replace(",", "")) * 1024 ** ["B", "KiB", "MiB", "GiB"].index(unit)
    return total


@pytest.mark.parametrize("name", ["j09_name_token_pairs", "j13_all_pairs_in_state"])
def test_pairs_are_made_behind_python(spark, monkeypatch, name):
    """5000 rows of one block, three tiles: 12,497,500 pairs, of which Python would send 200 MB one by one."""
    rows = spark.range(5000).selectExpr("id * 3 as record_id", "'Bill Smith' as name", "'TX' as state")
    monkeypatch.setattr(q_operators, "valid", lambda spark, d: rows)
    pairs, before = QUERIES[name](spark, ""), from_python(spark)
    got = pairs.selectExpr("count(*)", "count(distinct id_a * 20000 + id_b)", "count_if(id_a < id_b)", "max(id_b)").first()
    assert tuple(got) == (5000 * 4999 // 2,) * 3 + (4999 * 3,)
    assert 0 < from_python(spark) - before < 50_000_000


def test_runs_of_odd_sizes(spark, monkeypatch):
    """Tiles of 1, 5 and 32 rows over two blocks."""
    monkeypatch.setattr(q_operators, "valid", lambda spark, d: spark.range(47).selectExpr("id * 5 - 100 as record_id", "if(id % 4 = 0, 'TX', 'IL') as state"))
    ids = [k * 5 - 100 for k in range(47)]
    want = sorted([*combinations(ids[::4], 2), *combinations([x for k, x in enumerate(ids) if k % 4], 2)])
    for tile in (1, 5, 32):
        monkeypatch.setattr(blocking, "TILE", tile)
        assert sorted(map(tuple, QUERIES["j13_all_pairs_in_state"](spark, "").collect())) == want

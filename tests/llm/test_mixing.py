import math

from kinloom.llm import mixing

DOCS = "doc_id bigint, source string, text string, n_chars bigint"


def brute_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    """Shares everything by weight, cuts at the cap, and shares the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, left = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        if not open_:
            return {s: float(v) for s, v in full.items()}
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > most * sizes[s]]
        if not over:
            return full | {s: level * w[s] for s in open_}
        for s in over:
            full[s] = most * sizes[s]
            left -= full[s]


def check(spark, rows):
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, source, text, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = brute_targets(sizes)
    taken: dict = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        assert r.taken >= r.size * (math.floor(r.target / r.source_size) if r.source_size else 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) < 1.001
    assert math.isclose(sum(want.values()), sum(sizes.values()), rel_tol=1e-9)


def test_targets_and_takes(spark):
    rows = [(i, f"s{i % 7}", "word " * (1 + i * i % 50), None) for i in range(300)]
    check(spark, rows)
    check(spark, rows + [(1000 + i, "hot", "x y z", None) for i in range(900)] + [(5000, "tiny", "a", None), (5001, "bé", "a b", None)])


def test_nulls_ties_and_empty(spark):
    rows = [(None, None, None, None), (None, None, "a b", None), (1, "a", "", None), (2, "a", "x " * 9, None), (2, "a", "x " * 9, None), (3, None, "q", None)]
    check(spark, rows)
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert [r.taken for r in mixing.mix(spark.createDataFrame([(1, "a", None, 0)], DOCS)).collect()] == [0]


def test_ranges_do_not_change_the_result(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "w " * (i % 40), None) for i in range(2000)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 2000, 3)], "doc_id bigint, quality int")
    one = sorted(map(tuple, mixing.mix(docs, labels, range_rows=10**9).collect()))
    assert one == sorted(map(tuple, mixing.mix(docs, labels, range_rows=16).collect()))
    assert one == sorted(map(tuple, mixing.mix(docs.repartition(7), labels, range_rows=100).collect()))

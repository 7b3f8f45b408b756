"""What the review of round 2 found in queries that score pairs, on tables small enough for a test."""

import random
from itertools import product

import numpy as np
import pytest

from kinloom.functions import similarity as S
from kinloom.operators import blocking, match_master, scoring, survivorship, tiles
from kinloom.plans import pipeline
from kinloom.plans.catalog import QUERIES
from kinloom.plans.q_more import same_name
from kinloom.plans.q_operators import valid

from .test_findings_r02 import agrees_with_sql, people


@pytest.fixture
def stored(monkeypatch):
    """Name and rows of every table that the operators store."""
    out = []

    def spy(df, name):
        table = real(df, name)
        out.append((name, table.count()))
        return table

    real = scoring.materialize
    for module in (blocking, match_master, pipeline, scoring, survivorship, tiles):
        if hasattr(module, "materialize"):
            monkeypatch.setattr(module, "materialize", spy)
    return out


def test_ratios_of_many_pairs():
    rng = random.Random(5)
    texts = ["", "a", "é\U0001f600b", "x" * 64, "y" * 70 + "x", "xy" * 40, *("".join(rng.choices("abcd é", k=rng.randrange(70))) for _ in range(40))]
    x, y = (np.array(v) for v in zip(*product(range(len(texts)), repeat=2), strict=True))
    want = [S.indel_ratio(texts[i], texts[j]) for i, j in zip(x, y, strict=True)]
    assert S.indel_ratios(texts, texts, x, y).tolist() == want
    assert S.indel_ratios(texts, texts, x, y, S.sorted_words).tolist() == [S.token_sort_ratio(texts[i], texts[j]) for i, j in zip(x, y, strict=True)]


@pytest.mark.parametrize("name", ["m12_record_pairs", "m13_mean_pairs"])
def test_pairs_are_scored_without_being_stored(spark, tmp_path, monkeypatch, stored, name):
    """120 rows of one zip in tiles of about 16."""
    monkeypatch.setattr(tiles, "TILE", 16)
    assert agrees_with_sql(spark, people(spark, tmp_path, range(0, 97 * 120, 97)), name)
    assert max(n for _, n in stored) <= 120 * 5


@pytest.mark.parametrize("name", ["o01_record_pipeline", "m22_hybrid_pipeline"])
def test_pipelines_store_links_not_pairs(spark, tmp_path, monkeypatch, stored, name):
    """150 rows, most of them of one SSN."""
    monkeypatch.setattr(tiles, "TILE", 32)
    d = people(spark, tmp_path, range(0, 400 * 150, 400))
    assert any(r[1] != -1 for r in agrees_with_sql(spark, d, name))
    n = QUERIES["m12_record_pairs"](spark, d).count()
    assert 0 < max(k for what, k in stored if what == "scored") < n / 2


def test_links_say_what_all_scores_say():
    """Random grids of one task: the same components and best scores as all their pairs."""
    rng = np.random.default_rng(2)
    for share in (0.02, 0.3, 1.0):
        known, every = tiles.Links(), []
        for _ in range(12):
            a, b = (rng.choice(200, 15, replace=False) * 3 + k for k in (0, 1))
            score = rng.choice([0.8, 0.9, 1.0], (15, 15))
            limit = np.minimum(score + rng.choice([0, 0.05], (15, 15)), 1.0)
            passes = rng.random((15, 15)) < share
            every += [(a[i], b[j], score[i, j]) for i, j in np.argwhere(passes)]
            i, j = np.nonzero(passes & known.wants(a, b, limit, 1.0))
            known.add(a, b, i, j, score[i, j])
        got = [(r["id_a"], r["id_b"], r["score"]) for r in known.batch().to_pylist()]
        assert {*got} <= {(min(a, b), max(a, b), s) for a, b, s in every}
        assert share < 1 or len(got) < len(every) / 2
        assert summed(got) == summed(every)


def summed(pairs):
    root, best = {}, {}
    for a, b, s in pairs:
        for k in (a, b):
            root.setdefault(k, k)
            best[k] = max(best.get(k, 0), s)
    for a, b, _ in pairs:
        x, y = root[a], root[b]
        if x != y:
            root = {k: min(x, y) if r in (x, y) else r for k, r in root.items()}
    return root, best


def test_blocks_are_the_candidates(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tiles, "TILE", 64)
    v = scoring.materialize(valid(spark, people(spark, tmp_path, range(900))), "valid")
    for f in (lambda p: scoring.record_pairs(v, p, 0.5), lambda p: scoring.mean_pairs(v, p, ["name", "address", "city"], 0.6)):
        got, want = (sorted(map(tuple, f(p).collect())) for p in (tiles.Blocks(v, with_fallback=True), blocking.candidates(v, with_fallback=True)))
        assert got == want and len(got) > 100


def test_judge_of_names_is_asked_by_name(spark, tmp_path, stored):
    d = people(spark, tmp_path, range(700))
    agrees_with_sql(spark, d, "m26_judged_in_state")
    assert dict(stored)["asked"] < blocking.all_pairs_by_state(valid(spark, d)).count() / 3
    assert same_name.reads == ["name"]


def test_judge_that_minds_the_order(spark):
    """Its answers differ by which text comes first; a null text is a text."""

    def judge(batches):
        for x in batches:
            a, b = x.name_1.fillna("-"), x.name_2.fillna("-")
            yield x[["id_a", "id_b"]].assign(score=((a.map(ord) * 7 + b.map(ord) * 3) % 11) / 10, reasoning="")

    df = spark.range(60).selectExpr("id as record_id", "element_at(array('p', 'q', 'r', 's', 't', null, 'v'), int(id * id % 53 % 7) + 1) as name", "if(id % 10 < 7, 'TX', if(id % 10 = 9, '', 'IL')) as state", "'' as address", "'' as city", "'' as zip")
    cfg = {"judge": judge, "threshold": 0.85}
    want = sorted(map(tuple, pipeline.REGISTRY["judge_match"](df, cfg).select("record_id", "cluster_id", "similarity_score").collect()))
    judge.reads = ["name"]
    assert sorted(map(tuple, pipeline.REGISTRY["judge_match"](df, cfg).select("record_id", "cluster_id", "similarity_score").collect())) == want
    assert len({s for _, _, s in want}) > 2


def test_one_ssn_is_work_for_many_tasks(spark, monkeypatch):
    """300 x 200 rows of one SSN in parts of about 4096 pairs; one row without an SSN, one whose SSN the master lacks."""
    monkeypatch.setattr(match_master, "PART", 1 << 12)
    source = spark.range(302).selectExpr("id as record_id", "case id when 300 then '' when 301 then '423-45-6780' else '123-45-6789' end as ssn")
    master = spark.range(200).selectExpr("id as record_id", "'123 45 6789' as ssn")
    got = match_master.candidates(source, master).select("record_id", "m_record_id", "ssn_status", "match_count")
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=str) == sorted([(300, None, "NO_SSN", 0), (301, None, "SSN_NOT_FOUND", 0), *((a, b, "MATCHED", 200) for a in range(300) for b in range(200))], key=str)
    sizes = got.rdd.mapPartitions(lambda x: [sum(1 for _ in x)]).collect()
    assert max(sizes) < 30_000

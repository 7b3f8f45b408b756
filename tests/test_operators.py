import random

import pytest
from pyspark.sql import functions as F

from kinloom.functions import similarity as S
from kinloom.operators import blocking, geo, match_master, review, scoring, survivorship, validate
from kinloom.operators.components import connected_components
from kinloom.operators.numbering import numbered
from kinloom.plans.pipeline import Pipeline, format_duration
from kinloom.sources import readers, sinks
from kinloom.streaming.match import match_stream

FIELDS = "record_id bigint, name string, address string, city string, state string, zip string, phone string, email string, contact_person string, ssn string"
PEOPLE = [
    (1, "Bill Smith", "12 Main Street", "Houston", "TX", "77001", "713-555-0101", "b@x.com", "", "123-45-6789"),
    (2, "William Smith", "12 Main St", "Houston", "TX", "77001-1234", "713-555-0101", "", "", ""),
    (3, "William Smith Jr", "12 Main St", "Houston", "TX", "77001", "", "", "", ""),
    (4, "William Smith Sr", "12 Main St", "Houston", "TX", "77001", "", "", "", ""),
    (5, "Smith Family Trust", "12 Main St", "Houston", "TX", "77001", "", "", "", "123-45-6789"),
    (6, "Zoe Quill", "9 Elm Road", "Dallas", "TX", "75001", "", None, None, "123-45-6789"),
    (7, None, None, None, None, None, None, None, None, None),
]


def people(spark):
    return spark.createDataFrame(PEOPLE, FIELDS)


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1200)] + [(None, 3), (7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "id_a bigint, id_b bigint")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "id_a bigint, id_b bigint")).count() == 0


def test_numbers_follow_the_order(spark):
    rng = random.Random(9)
    values = [rng.choice([None, *range(500)]) for _ in range(900)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(5)
    for order, key in (([F.col("v").desc(), "id"], lambda r: (r.v is None, -(r.v or 0), r.id)), (["v", "id"], lambda r: (r.v is not None, r.v or 0, r.id))):
        got = sorted(numbered(df, *order).collect(), key=key)
        assert [r.number for r in got] == list(range(900))
    assert numbered(df.limit(0), "v").count() == 0


def test_dense_cluster_ids(spark):
    df = spark.createDataFrame([(k,) for k in (1, 5, 8, 20, 21, 30)], "record_id bigint")
    scored = spark.createDataFrame([(5, 20, 90.0), (8, 21, 95.0)], "id_a bigint, id_b bigint, score double")
    got = {r.record_id: r.cluster_id for r in survivorship.assign_clusters(df, scored, dense=True).collect()}
    assert got == {1: -1, 5: 0, 20: 0, 8: 1, 21: 1, 30: -1}


def test_record_scores(spark):
    v = validate.validate(people(spark), "salt")
    assert "ssn" not in v.columns
    got = {(r.id_a, r.id_b): r for r in scoring.record_pairs(v, blocking.candidates(v), 0.0).collect()}
    assert (3, 4) not in got  # Jr and Sr
    assert (1, 5) not in got  # a trust and a person, though the SSN agrees
    assert got[(1, 6)].match_method == "ssn_exact" and got[(1, 6)].score == 1.0
    # name .99, address 92 or more, city, state and zip equal, plus the bonus
    base = S.indel_ratio("12 main st", "12 main st") / 100
    assert got[(1, 2)].score == pytest.approx(min(1.0, 0.99 * 0.4 + base * 0.3 + 0.3 + 0.1))
    assert got[(2, 3)].score == pytest.approx(min(1.0, (S.token_sort_ratio("William Smith", "William Smith Jr") / 100) * 0.4 + 0.3 + 0.3 - 0.10 + 0.10))


def test_golden_record(spark):
    rows = people(spark).filter("record_id <= 3").withColumn("cluster_id", F.lit(1).cast("long"))
    g = survivorship.most_complete(rows).collect()
    assert len(g) == 1 and g[0].record_id == 1 and g[0].zip == "77001-1234"
    assert survivorship.best_values(rows, ["name", "zip"]).collect()[0].name == "Bill Smith"


def test_match_master(spark):
    source = people(spark)
    master = source.filter("record_id in (1, 6)").withColumn("record_id", F.col("record_id") + 100).withColumn("address", F.lit("12 Main St."))
    got = {r.record_id: r for r in match_master.match(source, master).collect()}
    assert len(got) == len(PEOPLE)
    assert got[1].master_id == 101 and got[1].recommendation == "EXISTING BA AND EXISTING ADDRESS" and got[1].match_count == 2
    assert got[2].ssn_status == "NO_SSN" and got[7].review_reason == "EMPTY_NAME"
    assert got[5].is_trust == 1
    judged = spark.createDataFrame([(6, 100.0)], "record_id bigint, score double")
    assert {r.record_id: r.name_score for r in match_master.override_scores(match_master.match(source, master), judged).collect()}[6] == 100.0


def test_stream_equals_batch(spark, tmp_path):
    df = people(spark).repartition(3)
    df.write.parquet(str(tmp_path / "in"))
    master = people(spark).filter("record_id = 1")
    out = str(tmp_path / "out")
    q = match_stream(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), master, lambda r, n: r.write.mode("overwrite").parquet(f"{out}/batch={n}"), str(tmp_path / "cp"))
    q.awaitTermination(240)
    got = spark.read.parquet(out).drop("batch")
    want = match_master.match(df, master)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Name,ZIP Code\nRené,02101\n".encode("latin-1"))
    df = readers.ingest(spark, "csv", path=str(tmp_path / "a.csv"), fields={"zip_code": "zip"})
    assert [tuple(r) for r in df.collect()] == [("René", "02101")]
    assert readers.file_type("x.XLSX") == "excel"
    with pytest.raises(ValueError):
        readers.file_type("x.bin")
    with pytest.raises(ValueError):
        sinks.write_table(df, "t", "upsert")
    assert not sinks.write_table(df.filter("false"), "t_none")
    assert sinks.write_table(df, "t_some") and sinks.add_columns(spark, "t_some", {"note": "STRING", "zip": "STRING"}) == ["note"]
    assert readers.row_count(spark, "t_some") == 1
    sinks.truncate(spark, "t_some")
    assert readers.row_count(spark, "t_some") == 0
    sinks.drop(spark, "t_some")
    assert not readers.table_exists(spark, "t_some")
    rows = spark.createDataFrame([("A", "5", "INT"), ("B", "true", "BOOL")], "CONFIG_KEY string, CONFIG_VALUE string, DATA_TYPE string")
    assert readers.load_config(rows, {}) == {"A": 5, "B": True}
    with pytest.raises(ValueError):
        validate.require_fields(df.drop("name"))


def test_pipeline_resumes(spark, tmp_path):
    p = Pipeline([{"stage": "validate", "config": {"salt": "s"}}, {"stage": "match"}, {"stage": "merge"}, {"stage": "output"}], str(tmp_path / "state"))
    first = p.run(people(spark)).count()
    assert p.run(people(spark), resume=True).count() == first
    strict = p.override("match", strategies=["ssn"], fallback=False)
    fresh = Pipeline(strict.steps).run(people(spark)).count()
    assert strict.run(people(spark), resume=True).count() == fresh != first
    assert p.run(people(spark).filter("record_id < 3"), resume=True).count() < first
    assert first < len(PEOPLE) and format_duration(3725) == "1h 2m"


def test_review_decisions(spark):
    df = people(spark).withColumn("name_parsed", F.col("name"))
    q = review.queue(df, F.lit("2025-01-01"))
    assert [r.id for r in q.collect()] == [5]
    d = spark.createDataFrame([(5, "approve", "ann", "2025-01-02", "ok", None)], "id bigint, action string, reviewed_by string, reviewed_date string, notes string, cluster_id bigint").withColumn("reviewed_date", F.to_timestamp("reviewed_date"))
    done = review.apply_decisions(q, d)
    assert done.collect()[0].review_status == "approved" and review.pending(done).count() == 0
    back = review.apply_decisions(done, d.withColumn("action", F.lit("reset")))
    row = back.collect()[0]
    assert row.review_status == "pending" and row.decision is None and row.review_notes == "ok [RESET]"
    assert review.bulk_approve(q, "Smith Family Trust", "bob", F.current_timestamp()).collect()[0].decision == "keep_separate"


def test_geo_and_location(spark):
    df = spark.createDataFrame([(1, "", "chicago", "il"), (2, "98101", "", "")], "record_id bigint, zip string, city string, state string")
    got = {r.record_id: r for r in geo.enrich(df, geo.places(spark)).collect()}
    assert got[1].zip == "60601" and got[1].zip_source == "lookup" and got[2].city == "Seattle" and got[2].state == "WA"

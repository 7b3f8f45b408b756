"""Labels, settings, judges, the merge facade and the summary."""

import pytest
from pyspark.sql import functions as F

from kinloom.functions import labels
from kinloom.functions import values as V
from kinloom.operators import facade, match_master, reports, survivorship
from kinloom.sources import settings, sinks


@pytest.mark.parametrize(
    ("raw", "normal", "lines"),
    [
        ("C/O Jane Doe, Agent 110 Main Street", "110 MAIN ST", ["110 MAIN ST", "C/O JANE DOE, AGENT"]),
        ("Attn: Ann, P.O. Box 12, Building 4", "PO BOX 12", ["PO BOX 12", "ATTN: ANN, BUILDING 4"]),
        ("12 Oak Suite 4 North Wing", "12 OAK STE 4 NORTH WING", ["12 OAK STE 4", "NORTH WING"]),
        ("12 Oak Suite 4", "12 OAK STE 4", ["12 OAK STE 4"]),
        (None, None, []),
        ("1 A", "1 " + "LONG " * 12, ["1 LONG LONG LONG LONG LONG LONG LONG LONG", "LONG LONG LONG LONG"]),
    ],
)
def test_labels(raw, normal, lines):
    assert labels.label(raw, normal).split("\n") == (lines or [""])


def test_settings():
    got = settings.from_env({"BATCH_SIZE": "7", "ENABLE_PARALLEL": "TRUE", "MATCH_FIELDS": "a,b", "FIELD_MAP": '{"x": "y"}', "LOG_LEVEL": ""})
    assert (got["BATCH_SIZE"], got["ENABLE_PARALLEL"], got["MATCH_FIELDS"], got["FIELD_MAP"], got["LOG_LEVEL"], got["SIMILARITY_THRESHOLD"]) == (7, True, ["a", "b"], {"x": "y"}, "INFO", 0.85)
    assert settings.masked("postgresql://ann:secret@host/db") == "postgresql://ann:****@host/db" and settings.masked("sqlite:///x.db") == "sqlite:///x.db"
    assert settings.snowflake_options({"SNOWFLAKE_USER": "ann", "SNOWFLAKE_ROLE": ""}) == {"sfUser": "ann", "authenticator": "externalbrowser"}


def test_merge_facade(spark):
    m = facade.Merges("ann")
    now = F.expr("TIMESTAMP '2025-01-01 00:00:00'")
    assert m.history() is None and not m.undo(1, now, "record_id bigint")["success"]
    rows = [(1, 1, "a", 0.9), (2, 1, "a", 0.9), (3, -1, "b", 0.0), (4, 4, "c", 0.8), (5, 4, "", 0.8)]
    df = spark.createDataFrame(rows, "record_id bigint, cluster_id bigint, name string, similarity_score double")
    assert sorted(r.record_id for r in m.merge(df, now, "first").collect()) == [1, 3, 4]
    assert m.history(cluster_id=4).count() == 1 and m.audit_trail().count() == 2
    back = m.undo(2, now, "record_id bigint, cluster_id bigint, name string, similarity_score double")
    assert sorted(r.record_id for r in back["restored"].collect()) == [4, 5]
    assert not m.undo(2, now, "record_id bigint")["success"]


def test_judges(spark):
    fields = "record_id bigint, name string, address string, city string, state string, zip string, contact_person string, ssn string"
    source = spark.createDataFrame([(1, "Zed Quill", "1 Main St", "Reno", "NV", "89501", "", "411223333"), (2, "Ann Lee", "2 Oak St", "Reno", "NV", "89501", "", "411223334")], fields)
    master = spark.createDataFrame([(7, "Bob Stone", "1 Main St", "Reno", "NV", "89501", "", "411223333"), (8, "Ann Lee", "2 Oak St", "Reno", "NV", "89501", "", "411223334")], fields)
    got = match_master.match(source, master)
    best = {r.record_id: r for r in got.collect()}
    assert best[2].name_score == 100 and not best[2].name_ambiguous and best[1].name_score < 70
    assert best[2].name_norm_detail == "" and best[2].name_match_detail == "exact_post_norm"

    def yes(batches):
        for x in batches:
            yield x[["record_id"]].assign(score=100.0)

    forced = got.withColumn("name_ambiguous", F.lit(True))
    assert {r.record_id: r.name_score for r in match_master.judge_names(forced, yes).collect()} == {1: 100.0, 2: 100.0}


def test_summary_and_text(spark):
    results = spark.createDataFrame([("x", 100.0, 95.0, 2, "DEC_CONTACT", 1, V.NEEDS_REVIEW, 1)], "ssn_masked string, ssn_match double, name_score double, match_count bigint, name_boost_source string, is_trust int, recommendation string, possible_address_matches bigint")
    text = reports.text_report(reports.summary(results, [V.NEEDS_REVIEW], ["DEC_CONTACT"]))
    assert text.startswith("OVERALL") and "DEC_CONTACT" in text
    assert reports.summary(results.limit(0), [V.NEEDS_REVIEW], []).filter("metric = 'records'").collect()[0].value == 0


def test_golden_fill_and_order(spark):
    rows = [(1, 1, "", "75001", "x"), (2, 1, "Ann", "", ""), (3, 1, "Bob", "75001-0002", ""), (4, -1, "", "75001", ""), (5, -1, "Cy", "", "")]
    df = spark.createDataFrame(rows, "record_id bigint, cluster_id bigint, name string, zip string, city string")
    got = {r.record_id: r for r in survivorship.most_complete(df, ["city"]).collect()}
    assert set(got) == {1, 4, 5} and (got[1].name, got[1].zip) == ("Ann", "75001-0002") and got[4].zip == "75001"
    assert [r.record_id for r in sinks.in_order(df.withColumn("state", F.lit("")), "golden").collect()] == [4, 5, 2, 3, 1]

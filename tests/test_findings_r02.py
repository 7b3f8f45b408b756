"""What the review of round 2 found, on tables small enough for a test."""

import duckdb
from pyspark.sql import functions as F

from kinloom.functions import compare
from kinloom.operators import blocking, match_master, reports, scoring, survivorship
from kinloom.plans.catalog import ORACLES, QUERIES


def people(spark, tmp_path, keys):
    d = str(tmp_path / "people")
    spark.createDataFrame([(k,) for k in keys], "c_custkey bigint").coalesce(1).write.parquet(f"{d}/customer.parquet")
    return d


def agrees_with_sql(spark, folder, name):
    got = QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{folder}/customer.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want)
    return rows


def test_group_report_adds_in_id_order(spark):
    """In id order the mean is 28.7, backwards 28.8."""
    scores = [0.1, 0.25, 0.05, 0.75]
    for order in (1, -1):
        df = spark.createDataFrame([(k, 1, f"n{k}", s) for k, s in enumerate(scores)][::order], "record_id bigint, cluster_id bigint, name string, similarity_score double").coalesce(1)
        assert [tuple(r) for r in reports.group_report(df).collect()] == [(1, 4, "n0,n1,n2,n3", 75.0, 28.7)]


def test_row_labels_beyond_four_places(spark, tmp_path):
    assert ("R1000") in {r[1] for r in agrees_with_sql(spark, people(spark, tmp_path, range(10_030)), "w08_row_labels")}


def test_large_block_is_work_for_many_tasks(spark):
    """A hot block of three tiles and a small one: every pair once, no task has all of them."""
    df = spark.range(2600).selectExpr("id * 3 as record_id", "if(id % 100 = 0, 'b', 'a') as zip_normalized", "id / 2 as similarity_score", "if(id = 7, null, id % 2) as cluster_id")
    pairs = blocking.by_zip(df)
    assert pairs.count() == pairs.distinct().count() == 2574 * 2573 // 2 + 26 * 25 // 2
    assert pairs.filter("id_a >= id_b or (id_a % 300 = 0) <> (id_b % 300 = 0)").isEmpty()
    assert pairs.groupBy(F.spark_partition_id()).count().count() > 1
    scored = scoring.cluster_pairs(df)
    assert scored.count() == 1300 * 1299 // 2 + 1299 * 1298 // 2
    assert scored.filter("score <> (id_a / 6 + id_b / 6) / 2").isEmpty()


def test_union_of_blocks_groups_no_pairs(spark, tmp_path, capsys):
    d = people(spark, tmp_path, range(500))
    agrees_with_sql(spark, d, "j11_block_union")
    QUERIES["j11_block_union"](spark, d).explain()
    assert "hashpartitioning(id_a" not in capsys.readouterr().out


def test_matcher_meets_only_deciding_pairs(spark):
    """One SSN on 120 rows of both sides: far fewer than 14,400 pairs, and each best row is that of all pairs."""
    line = "case when id % 9 = 0 then 'PO Box ' || (id % 4) when id % 11 = 0 then 'Old Mill Farm ' || chr(65 + id % 5) when id % 13 = 0 then '' else (100 + id % 40) || ' Oak St' || if(id % 7 = 0, ' Suite 4', '') end"
    rows = lambda n: spark.range(n, n + 120).selectExpr("id as record_id", "'Bill Smith' as name", f"{line} as address", "if(id % 3 = 0, 'Dallas', 'Houston') as city", "'TX' as state", "string(77001 + id % 2) as zip", "'' as contact_person", "'123-45-6789' as ssn")
    source, master = rows(0), rows(1000)
    s, m = match_master.features(source, "s"), match_master.features(master, "f")
    every = compare.compare_addresses(match_master.candidates(s, m).filter("ssn_status = 'MATCHED'"), "s", "m_f")
    assert every.count() == 14_400
    assert match_master.deciding(s, m).count() < 1_500
    want = {}
    for r in every.collect():
        want[r.record_id] = min(want.get(r.record_id, (1, 0, "")), (-r.address_score, r.m_record_id, r.address_reason))
    got = {r.record_id: (r.master_id, r.address_reason, r.match_count) for r in match_master.match(source, master).collect()}
    assert got == {k: (x, reason, 120) for k, (_, x, reason) in want.items()}
    assert len({x[2] for x in want.values()}) > 3


def test_name_links_grow_with_rows(spark):
    """600 rows of one zip and six names: links by classes, with the clusters and best scores of all 179,700 pairs."""
    names = "element_at(array('smith bill', 'smith bil', 'jones ann', 'jones anne', 'quill zoe', ''), int(id % 6) + 1)"
    df = spark.range(600).selectExpr("id as record_id", f"{names} as match_key", "'TX' as state", "if(id % 200 = 7, '', '77001') as zip_normalized", "'' as city_normalized", "if(id % 200 = 7, '', '7135550101') as phone_normalized")
    strategies = ["state", "zip", "city", "phone"]
    links = scoring.key_links(df, strategies)
    assert links.count() < 2_000
    pairs = blocking.candidates(df, strategies, with_fallback=True)
    got, want = (sorted(map(tuple, survivorship.assign_clusters(df.select("record_id"), x).collect())) for x in (links, scoring.key_pairs(df, pairs)))
    assert got == want
    assert len({c for _, c, _ in want}) > 3

"""The SQL of the dedup queries against the queries on a corpus with copies, shared passages, nulls and empty texts."""

import duckdb
import pytest

from kinloom.llm import queries

from .test_dedup import DOCS, corpus


def compare(spark, folder, name, tables):
    con = duckdb.connect()
    for table, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    got = queries.queries()[name](spark, str(folder))
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str)


def test_url_rules_and_sql_agree(spark, tmp_path):
    urls = ["http://x.EXAMPLE.org/es/1", "https://example.org/en/1?x", "https://a.b.com/de/", "http://notcom/fr/", "https://q.com", None, "no scheme", "a://b://c/d", "http://org/x", "http://é.com/fr/\nz#q"]
    compare(spark, tmp_path, "url_rules", {"pages": ([(k, u) for k, u in enumerate(urls)], "page_id bigint, url string")})


def test_licenses_and_sql_agree(spark, tmp_path):
    from kinloom.llm.licenses import TEMPLATES

    texts = [t[1][n:] + " some more words" for t in TEMPLATES for n in (0, 20, 90)] + ["all rights reserved CC BY and all rights reserved", "", None, "The GNU general public license"] + [TEMPLATES[3][1] + " x y z" * 200 + TEMPLATES[8][1]]
    compare(spark, tmp_path, "op7_licenses", {"documents": (list(enumerate(texts)), "doc_id bigint, text string")})


def test_mixing_and_sql_agree(spark, tmp_path):
    rows = [(k, f"s{k % 4}", "w " * (k % 30)) for k in range(400)] + [(None, None, "a b"), (None, "s1", "c d e"), (None, "s1", None), (7, "s1", "q")]
    compare(spark, tmp_path, "op4_mixing", {"documents": (rows, "doc_id bigint, source string, text string"), "labels": ([(k, k % 2) for k in range(0, 400, 3)], "doc_id bigint, quality int")})


@pytest.mark.parametrize("name", ["op8_suffix_dedup", "op9_substring_dedup", "op10_near_dedup"])
def test_query_and_sql_agree(spark, tmp_path, name):
    spark.createDataFrame(corpus(120, 31), DOCS).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.queries()[name](spark, str(tmp_path))
    columns = sorted(got.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str)

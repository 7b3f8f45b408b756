"""Goldens derived by hand from the rules, and kernels against plain definitions."""

import random

import pytest
from pyspark.sql import functions as F

from kinloom.functions import compare as C
from kinloom.functions import keys as K
from kinloom.functions import master as M
from kinloom.functions import records as R
from kinloom.functions import similarity as S
from kinloom.functions.labels import label


def over(spark, values, f):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.x for r in rows.select("k", f(F.col("v")).alias("x")).orderBy("k").collect()]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_and_ratio():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 90))) for _ in range(2))
        assert S.lcs_length(a, b) == lcs(a, b)
    assert S.indel_ratio("abcd", "abce") == 75
    assert S.indel_ratio("", "") == 0
    assert S.token_sort_ratio("Smith, John", "JOHN smith") == 100


def test_jaro_winkler():
    assert S.jaro("MARTHA", "MARHTA") == pytest.approx(0.944444, abs=1e-6)
    assert S.jaro_winkler("DIXON", "DICKSONX") == pytest.approx(0.813333, abs=1e-6)
    assert S.jaro("", "A") == 0 and S.jaro("A", "A") == 1
    # Below 0.7 the prefix counts as well.
    assert S.jaro_winkler("ABXXXX", "ABYYYY") > S.jaro("ABXXXX", "ABYYYY")


NAMES = [
    ("CHUCK", "CHARLES", 1.0), ("CSC", "CORPORATION SERVICE COMPANY", 0.95), ("MIKE SWAFFORD", "MICHAEL SWAFFORD", 1.0), ("J SMITH", "JOHN SMITH", 0.95),
    ("JOHN SMITH JR", "JOHN SMITH SR", 1.0), ("MARILYN CAVIN^^", "MARILYN CAVIN", 1.0), ("ANN/STAN LLC", "ANN STAN LLC", 1.0), ("", "X", 0.0),
    ("PDIII EXPLORATION LTD", "PD III EXPLORATION LTD", 0.911),
]


def test_name_compare(spark):
    flat = [n for a, b, _ in NAMES for n in (a, b)]
    normal = over(spark, flat, M.normalize_name)
    for k, (a, b, want) in enumerate(NAMES):
        got, _ = C.name_score(normal[2 * k], normal[2 * k + 1])
        assert got == pytest.approx(want, abs=2e-3), (a, b, got)
    assert C.name_score("RUSSELL V JOHNSON III", "JEC OPERATING LLC")[0] < 0.6


def test_master_normalizers(spark):
    assert over(spark, ["J V S L L C", "OLIVER & Co.", None, "Living  tr", "New York Life"], M.normalize_name) == ["JVS LLC", "OL IVER CO", "", "LIVING TRUST", "NEWYORK LIFE"]
    got = over(spark, ["P.O. BOX ONE", "box 1", "12 box springs rd", "370-17TH Street", "John Doe 12 Main Street", "Suite 5 Oak Road", "9 N Main St dated June 14, 2012", None, "HWY 12 W"], M.normalize_address)
    assert got == ["PO BOX 1", "PO BOX 1", "12 BOX SPRINGS RD", "370 17TH ST", "12 MAIN ST", "STE 5 OAK RD", "9 N MAIN ST", "", "HWY 12 W"]
    assert over(spark, ["2101", "02101-1234", "12", None], M.normalize_zip) == ["02101", "02101", "12", ""]
    assert over(spark, ["123-45-6789", "000-12-3456", "999999999", "12", None], M.clean_ssn) == ["123456789", "", "", "", ""]
    assert over(spark, ["123456789", "12"], M.mask_ssn) == ["*****6789", "12"]


def test_record_parsers(spark):
    rows = over(spark, ["Dr. John Smith", "John Smith Jr.", "J Smith V", "Ann Mary Lou Jones III", "Cher", "", None], R.parse_name)
    assert [(r.first, r.middle, r.last, r.suffix, r.title) for r in rows] == [
        ("John", "", "Smith", "", "Dr."), ("John", "", "Smith", "Jr.", ""), ("J", "", "Smith", "V", ""), ("Ann", "Mary Lou", "Jones", "III", ""),
        ("Cher", "", "", "", ""), ("", "", "", "", ""), ("", "", "", "", ""),
    ]
    assert over(spark, ["Smith Family Trust", "Memorial Hospital - Cardiology Dept", "ABC Medical Group LLC", "Christopher", "Ada"], R.entity_type) == ["trust", "department", "business", "department", "individual"]
    assert over(spark, ["123-45-6789", "123 45 6789", "999-99-9999", "111-11-1111", "", None], R.clean_ssn) == ["123456789", "123456789", "", "", "", ""]
    assert over(spark, ["Rue É. Main Street"], R.normalize_address) == ["rue é main st"]


def test_keys(spark):
    assert over(spark, ["Smith, John", "Acme, L.L.C.", "Oil Partners, Jane", "7 Eleven, Bob", "A, B"], K.flip_last_first) == ["John Smith", "Acme, L.L.C.", "Oil Partners, Jane", "7 Eleven, Bob", "A, B"]
    assert over(spark, ["Springfield Med. Assoc", "AMOCO PRODUCTION CO"], K.match_key) == ["SPRINGFIELD MEDICAL ASSOCIATES", "AMOCO PRODUCTION"]
    assert over(spark, ["Smith TR u/a", "Smith TR", "Trustee of x"], K.review_keywords) == [["TR "], [], ["TRUSTEE"]]


def test_labels():
    assert label("John Doe, 12 Main Street Suite 4 rear", "12 MAIN ST STE 4 REAR") == "12 MAIN ST STE 4\nREAR\nJOHN DOE"
    assert label("Attn Ann, P.O. Box 7", "PO BOX 7") == "PO BOX 7\nATTN ANN"
    assert label(None, "") == "" and max(map(len, label("", "1 " + "LONG " * 30).split("\n"))) <= 45

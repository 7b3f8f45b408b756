"""Records of people, companies and trusts derived from the driver's tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _pick(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values))
    return f"(CASE {expr} {whens} END)"


_FIRST = ["Bill", "William", "Tina", "Christina", "Mike", "Scott", "Dr. Jim"]
_FIRST_B = ["William", "Bill", "Christina", "Tina", "M", "Skott", "James"]
_LAST = ["Smith", "Smyth", "Johnson", "Oliver", "Vandermeer"]
_CITY = ["Houston", "Dallas", "Ft Worth", "Chicago", "Springfield", "Boston", "Seattle", "Atlanta", "unknown", ""]
_STATE = ["TX", "TX", "TX", "IL", "IL", "MA", "WA", "GA", "tx", ""]


def _person(table: str, key: str, first: list[str]) -> str:
    k = key
    base = f"{_pick(f'{k} % 7', first)} || ' ' || {_pick(f'{k} % 5', _LAST)}"
    name = f"""CASE WHEN {k} % 41 = 0 THEN ''
      WHEN {k} % 17 = 0 THEN {_pick(f'{k} % 5', _LAST)} || ' Family Trust'
      WHEN {k} % 19 = 0 THEN 'Memorial Hospital - ' || {_pick(f'{k} % 2', ['Cardiology', 'Billing'])} || ' Dept'
      WHEN {k} % 23 = 0 THEN {_pick(f'{k} % 5', _LAST)} || ' Oil & Gas, L L C'
      WHEN {k} % 29 = 0 THEN {_pick(f'{k} % 5', _LAST)} || ', ' || {_pick(f'{k} % 7', first)}
      WHEN {k} % 31 = 0 THEN 'Estate of ' || {base}
      WHEN {k} % 13 = 0 THEN {base} || {_pick(f'{k} % 3', [' Jr', ' Sr.', ' III'])}
      WHEN {k} % 37 = 0 THEN 'J V ' || {_pick(f'{k} % 5', _LAST)} || ' Company'
      ELSE {base} END"""
    address = f"""CASE WHEN {k} % 43 = 0 THEN '' WHEN {k} % 29 = 0 THEN {_pick(f'{k} % 3', ['P.O. Box ', 'PO BOX ', 'Post Office Box '])} || CAST({k} % 7 AS STRING)
      WHEN {k} % 47 = 0 THEN 'C/O Jane Doe, Agent ' || CAST(100 + {k} % 211 AS STRING) || ' Main Street'
      WHEN {k} % 53 = 0 THEN 'NO VALID ADDRESS'
      ELSE CAST(100 + {k} % 211 AS STRING) || {_pick(f'{k} % 4', [' Main St', ' Main Street', ' North Oak Avenue', ' County Road 7'])}
        || CASE WHEN {k} % 9 = 0 THEN ', Suite 4' WHEN {k} % 10 = 0 THEN ' dated June 14, 2012' ELSE '' END END"""
    zip_ = f"""CASE WHEN {k} % 37 = 0 THEN '' WHEN {k} % 13 = 0 THEN lpad(CAST(75000 + {k} % 97 AS STRING), 5, '0') || '-' || lpad(CAST({k} % 1000 AS STRING), 4, '0')
      WHEN {k} % 59 = 0 THEN '2101' ELSE lpad(CAST(75000 + {k} % 97 AS STRING), 5, '0') END"""
    phone = f"CASE WHEN {k} % 6 = 0 THEN '' ELSE '(' || lpad(CAST(200 + {k} % 90 AS STRING), 3, '0') || ') ' || lpad(CAST({k} % 11 AS STRING), 3, '5') || '-' || lpad(CAST({k} % 10000 AS STRING), 4, '0') END"
    ssn = f"CASE WHEN {k} % 11 = 0 THEN '' WHEN {k} % 13 = 0 THEN '000-12-3456' WHEN {k} % 61 = 0 THEN '999-99-9999' ELSE '4' || lpad(CAST({k} % 400 AS STRING), 8, '1') END"
    return f"""SELECT CAST({k} AS BIGINT) AS record_id, {name} AS name, {address} AS address,
      {_pick(f'{k} % 10', _CITY)} AS city, {_pick(f'{k} % 10', _STATE)} AS state, {zip_} AS zip, {phone} AS phone,
      CASE WHEN {k} % 5 = 0 THEN '' WHEN {k} % 14 = 0 THEN 'none' ELSE 'User' || CAST({k} AS STRING) || '@Example.com' END AS email,
      CASE WHEN {k} % 3 = 0 THEN 'Pat Lee' ELSE '' END AS contact_person,
      {ssn} AS ssn, CASE WHEN {k} % 4 = 0 THEN '12-' || lpad(CAST({k} AS STRING), 7, '3') ELSE '' END AS ein,
      DATE '2024-01-01' + CAST({k} % 365 AS INT) AS updated_date
      FROM {table}"""


#: Incoming records: one for each customer.
SOURCE = _person("customer", "c_custkey", _FIRST)
#: Reference records: one for each customer again, under other spellings and keys.
MASTER = _person("(SELECT c_custkey + 3 AS c_custkey FROM customer)", "c_custkey", _FIRST_B)
#: The same for DuckDB, whose name for STRING is VARCHAR.
CTE = "WITH ba AS (" + SOURCE.replace("AS STRING", "AS VARCHAR") + "), master AS (" + MASTER.replace("AS STRING", "AS VARCHAR") + ")"


def _table(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    return spark.sql(sql.replace("FROM customer", "FROM {customer}"), customer=customer)


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, SOURCE)


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, MASTER)

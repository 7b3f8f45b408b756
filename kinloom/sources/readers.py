"""Reading records. Every column is text: inference would turn the zip 02101 into 2101."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values as V
from ..functions.text import scrub_newlines
from ..operators.validate import normalize_headers, rename_fields

KINDS = {".csv": "csv", ".txt": "csv", ".tsv": "csv", ".xlsx": "excel", ".xls": "excel", ".xlsm": "excel", ".parquet": "parquet", ".json": "json"}


def file_type(path: str) -> str:
    kind = KINDS.get(PurePosixPath(path).suffix.lower())
    if not kind:
        raise ValueError(f"unknown file type: {path}")
    return kind


def read_csv(spark: SparkSession, path: str, encoding: str | None = None, columns: list[str] | None = None, sep: str = ",") -> DataFrame:
    """All-text columns. Without an encoding, UTF-8 is taken, and Latin-1 if decoding left a replacement character in
    any cell (Latin-1 decodes everything, so no third choice can be reached)."""
    reader = spark.read.option("header", True).option("sep", sep).option("multiLine", True).option("quote", '"').option("escape", '"').option("inferSchema", False)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    if encoding:
        return reader.option("encoding", encoding).csv(path)
    df = reader.option("encoding", "UTF-8").csv(path)
    broken = [F.col(f"`{c}`").contains("�") for c in df.columns]
    if broken:
        hit = broken[0]
        for b in broken[1:]:
            hit = hit | b
        if not df.filter(hit).isEmpty():
            return reader.option("encoding", "ISO-8859-1").csv(path)
    return df


def list_sheets(path: str) -> list[str]:
    import pandas as pd

    return list(pd.ExcelFile(path).sheet_names)


def read_excel(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """One sheet of a workbook that the driver can open, as text. A workbook fits into memory (2^20 rows at most)."""
    import pandas as pd

    frame = pd.read_excel(path, sheet_name=sheet, dtype=str).fillna("")
    return spark.createDataFrame(frame, T.StructType([T.StructField(str(c), T.StringType()) for c in frame.columns]))


def read_table(spark: SparkSession, name: str, limit: int | None = None, jdbc: dict[str, str] | None = None) -> DataFrame:
    df = spark.read.format("jdbc").options(**jdbc, dbtable=name).load() if jdbc else spark.table(name)
    return df if limit is None else df.limit(limit)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def row_count(spark: SparkSession, name: str) -> int:
    return spark.table(name).count()


def filled_upper(df: DataFrame) -> DataFrame:
    """Headers in upper case, nulls as empty text."""
    return df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c.upper()) for c in df.columns))


def ingest(spark: SparkSession, kind: str, path: str | None = None, table: str | None = None, sql: str | None = None, fields: dict[str, str] | None = None, headers: bool = True, **how) -> DataFrame:
    """csv, excel, parquet, database (``table``) or query (``sql``), with renamed fields and normalized headers."""
    if kind == "csv":
        df = read_csv(spark, path, **how)
    elif kind == "excel":
        df = read_excel(spark, path, **how)
    elif kind == "parquet":
        df = spark.read.parquet(path)
    elif kind == "database":
        df = read_table(spark, table, **how)
    elif kind == "query":
        df = spark.sql(sql)
    else:
        raise ValueError(f"unknown source type: {kind}")
    df = normalize_headers(df) if headers else df
    return rename_fields(df, fields or {})


def load_master_csv(df: DataFrame) -> DataFrame:
    """The master's rows with newlines scrubbed and the SSN as digits."""
    text = {c: scrub_newlines(F.col(c)) for c in ("hdrname", "addraddress", "addrcity", "addrcontact", "countryname") if c in df.columns}
    return df.withColumns(text | {"ssn": F.regexp_replace(F.coalesce("ssn", F.lit("")), "[^0-9]", "")})


#: Settings and their defaults: score ranges of the four buckets and of the outside judges.
DEFAULTS = {
    "USE_API_OVERRIDE": False, "API_SCORE_MIN": 15.0, "API_SCORE_MAX": 70.0, "API_BATCH_SIZE": 20, "GOOGLE_ADDR_SCORE_MIN": 15.0, "GOOGLE_ADDR_SCORE_MAX": 65.0,
    "NEW_BA_NEW_ADDR": (0, 0, 0, 0), "EXISTING_BA_NEW_ADDR": (100, 100, 0, 0), "EXISTING_BA_EXISTING_ADDR": (100, 100, 100, 100),
}
_CAST = {"BOOL": lambda v: str(v).strip().lower() in ("true", "1", "yes"), "INT": int, "FLOAT": float}


def load_config(rows: DataFrame | None, defaults: dict | None = None) -> dict:
    """Settings of a table (CONFIG_KEY, CONFIG_VALUE, DATA_TYPE), one row a setting, over the defaults."""
    out = dict(DEFAULTS if defaults is None else defaults)
    for r in rows.collect() if rows is not None else ():
        out[r.CONFIG_KEY] = _CAST.get((r.DATA_TYPE or "").upper(), str)(r.CONFIG_VALUE)
    return out


LOOKUPS = {
    "NICKNAME": V.NICKNAMES, "STATE_ABBREV": V.STATES, "BUSINESS_SUFFIX": set(V.BUSINESS_SUFFIXES), "BUSINESS_DESCRIPTOR": set(V.BUSINESS_DESCRIPTORS), "INDUSTRY_TERM": set(V.INDUSTRY_TERMS),
    "NAME_SUFFIX": set(V.NAME_SUFFIXES), "BAD_SSN": set(V.BAD_SSNS), "TRUST_KEYWORD": set(V.TRUST_KEYWORDS),
}


def load_lookups(rows: DataFrame | None) -> dict:
    """Tables of (LOOKUP_TYPE, LOOKUP_KEY, LOOKUP_VALUE) over the defaults; a type replaces its default as a whole, and
    one without any value is a set."""
    out = dict(LOOKUPS)
    if rows is not None:
        got: dict = {}
        for r in rows.collect():
            got.setdefault(r.LOOKUP_TYPE, {})[r.LOOKUP_KEY] = r.LOOKUP_VALUE
        out |= {k: set(v) if all(x is None for x in v.values()) else v for k, v in got.items()}
    return out


def lookup_sizes(rows: DataFrame) -> DataFrame:
    """Each type's entries and whether it is a set."""
    return rows.groupBy("LOOKUP_TYPE").agg(F.count(F.lit(1)).alias("n"), (F.count("LOOKUP_VALUE") == 0).alias("is_set"))

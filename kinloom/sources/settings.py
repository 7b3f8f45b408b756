"""Settings from the environment, connector options and connection strings."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping

# Names and defaults of the settings.
DEFAULTS: dict[str, object] = {
    "DB_TYPE": "sqlite", "DB_CONNECTION_STRING": "sqlite:///ba_dedup.db", "INPUT_TYPE": "csv", "INPUT_PATH": "input/sample_data.csv", "INPUT_TABLE": "business_associates_raw",
    "OUTPUT_TABLE": "business_associates_deduplicated", "OUTPUT_AUDIT_TABLE": "ba_dedup_audit", "SIMILARITY_THRESHOLD": 0.85, "MATCH_FIELDS": ["name", "address", "city", "state", "zip"],
    "MERGE_STRATEGY": "most_complete", "BATCH_SIZE": 1000, "LOG_LEVEL": "INFO", "FIELD_MAP": {}, "ENABLE_CACHING": True, "NORMALIZATION_CACHE_SIZE": 10000, "FUZZY_MATCH_CACHE_SIZE": 50000,
    "ENABLE_PARALLEL": False, "N_JOBS": -1, "ENABLE_CHUNKING": True, "CHUNK_SIZE": 10000, "MAX_MISSING_DATA_PAIRS": 50000, "ENABLE_QUERY_PROFILING": False, "SLOW_QUERY_THRESHOLD": 1.0,
}


def _typed(text: str, like: object) -> object:
    if isinstance(like, bool):
        return text.lower() == "true"
    if isinstance(like, list):
        return text.split(",")
    if isinstance(like, dict):
        return json.loads(text)
    return type(like)(text)


def from_env(env: Mapping[str, str] | None = None, defaults: Mapping[str, object] = DEFAULTS) -> dict[str, object]:
    """Every setting in the type of its default; what is not in the environment (or empty) keeps it."""
    env = os.environ if env is None else env
    return {k: _typed(env[k], v) if env.get(k) else v for k, v in defaults.items()}


def snowflake_options(env: Mapping[str, str]) -> dict[str, str]:
    """Options of the warehouse connector with single sign-on; empty ones are left out."""
    names = {"sfURL": "SNOWFLAKE_ACCOUNT", "sfUser": "SNOWFLAKE_USER", "sfWarehouse": "SNOWFLAKE_WAREHOUSE", "sfDatabase": "SNOWFLAKE_DATABASE", "sfSchema": "SNOWFLAKE_SCHEMA", "sfRole": "SNOWFLAKE_ROLE"}
    return {k: env[v] for k, v in names.items() if env.get(v)} | {"authenticator": "externalbrowser"}


def masked(dsn: str) -> str:
    """A connection string whose password may be logged."""
    return re.sub(r"(://[^:/@]+):[^@]*@", r"\1:****@", dsn)

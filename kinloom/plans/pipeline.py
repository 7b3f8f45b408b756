"""Pipelines of stages: DataFrame in, DataFrame out, each checked and, if asked, stored so that a run can resume."""

from __future__ import annotations

import hashlib
import json
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, scoring, survivorship, tiles, validate
from ..session import materialize

log = logging.getLogger("kinloom")
Stage = Callable[[DataFrame, dict], DataFrame]
#: Columns that a stage's result must have.
PROMISES = {"validate": ["address_normalized", "zip_normalized", "name_normalized"], **dict.fromkeys(("match", "hybrid_match", "judge_match"), ["cluster_id", "similarity_score"])}


def _validate(df: DataFrame, cfg: dict) -> DataFrame:
    return materialize(validate.validate(df, cfg["salt"], cfg.get("drop_invalid", False)), "valid")


def _match(df: DataFrame, cfg: dict) -> DataFrame:
    pairs = tiles.Blocks(df, cfg.get("strategies"), cfg.get("name_tokens", False), cfg.get("fallback", True), cfg.get("most", 50_000))
    return survivorship.assign_clusters(df, scoring.record_pairs(df, pairs, cfg.get("threshold", 0.85), cfg.get("weights"), True))


def _hybrid(df: DataFrame, cfg: dict) -> DataFrame:
    """Clusters at the low threshold; all pairs in a cluster, scored by the mean of both records' best scores, are
    certain or uncertain. Certain pairs link as they are; uncertain ones go to the judge, or stay out without one (unless
    asked in). Only the judge needs every pair; without it the links to each cluster's best record say the same."""
    high, low = cfg.get("high", 0.95), cfg.get("low", 0.75)
    pairs = tiles.Blocks(df, with_fallback=cfg.get("fallback", True), most=cfg.get("most", 50_000))
    found = survivorship.assign_clusters(df.select("record_id"), scoring.record_pairs(df, pairs, low, None, True))
    if judge := cfg.get("judge"):
        scored = materialize(scoring.hybrid_buckets(scoring.cluster_pairs(materialize(found, "fuzzy")), high, low), "in_clusters")
        told = scoring.judge_pairs(scored.filter("bucket = 'uncertain'"), judge, cfg.get("judge_threshold", 0.80)).select("id_a", "id_b", "score", F.lit("ai").alias("match_method"))
        links = scored.filter("bucket = 'certain'").select("id_a", "id_b", "score", "match_method").unionByName(told)
    else:
        links = scoring.cluster_links(found, low if cfg.get("include_uncertain") else high)
    return survivorship.assign_clusters(df, links)


def _judge(df: DataFrame, cfg: dict) -> DataFrame:
    """Every pair of a state goes to an outside judge; what it accepts is clustered. A judge that says which columns it reads
    (an attribute ``reads``) answers equal texts alike, so it is asked about each two texts once, not about each pair."""
    if reads := getattr(cfg["judge"], "reads", None):
        return survivorship.assign_clusters(df, scoring.judged_texts(df, "state", cfg["judge"], reads, cfg.get("threshold", 0.80)))
    pairs = materialize(scoring.pair_up(blocking.all_pairs_by_state(df), df, cfg.get("fields", ["name", "address", "city", "state", "zip"])), "asked")
    return survivorship.assign_clusters(df, scoring.judge_pairs(pairs, cfg["judge"], cfg.get("threshold", 0.80)).select("id_a", "id_b", "score"))


def _merge(df: DataFrame, cfg: dict) -> DataFrame:
    return survivorship.merge_all(df, cfg.get("strategy", "most_complete"))[0]


def _output(df: DataFrame, cfg: dict) -> DataFrame:
    return validate.drop_working_columns(df)


REGISTRY: dict[str, Stage] = {"validate": _validate, "match": _match, "hybrid_match": _hybrid, "judge_match": _judge, "merge": _merge, "output": _output}


def register(name: str, stage: Stage) -> None:
    REGISTRY[name] = stage


@dataclass
class Pipeline:
    """``steps``: dicts with a stage's name and config, as in a workflow file. With a ``state`` folder each result is
    stored under a key of the input, the stage, its config and all stages before it, and a later run with ``resume`` reads
    those stored results again that have the same key: after a change everything downstream is computed anew."""

    steps: list[dict]
    state: str | None = None
    seconds: dict[str, float] = field(default_factory=dict)

    def override(self, stage: str, **values) -> Pipeline:
        steps = [s | {"config": s.get("config", {}) | values} if s["stage"] == stage else s for s in self.steps]
        return Pipeline(steps, self.state)

    def _done(self, spark: SparkSession, path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    def _key(self, before: str, step: dict) -> str:
        name = lambda x: f"{getattr(x, '__module__', '')}.{getattr(x, '__qualname__', repr(x))}"
        return hashlib.sha256(json.dumps([before, step["stage"], step.get("config", {})], sort_keys=True, default=name).encode()).hexdigest()[:16]

    def run(self, df: DataFrame, resume: bool = False) -> DataFrame:
        spark = df.sparkSession
        key = fingerprint(df) if self.state else ""
        for k, step in enumerate(self.steps):
            name, began = step["stage"], time.time()
            key = self._key(key, step)
            path = f"{self.state}/{k}_{name}_{key}" if self.state else None
            if not (path and resume and self._done(spark, path)):
                out = REGISTRY[name](df, step.get("config", {}))
                if missing := [c for c in PROMISES.get(name, []) if c not in out.columns]:
                    raise ValueError(f"stage {name} lacks {', '.join(missing)}")
                if path:
                    out.write.mode("overwrite").parquet(path)
            df = spark.read.parquet(path) if path else out
            self.seconds[name] = time.time() - began
            log.info("stage %s took %s", name, format_duration(self.seconds[name]))
        return df


def fingerprint(df: DataFrame) -> str:
    """What tells two inputs apart: the schema, the number of rows and a sum over their hashes, in one pass."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*(F.col(f"`{c}`").cast("string") for c in df.columns)).cast("decimal(38,0)"))).first()
    return hashlib.sha256(f"{df.schema.simpleString()} {row[0]} {row[1]}".encode()).hexdigest()


def format_duration(seconds: float) -> str:
    if seconds < 60:
        return f"{seconds:.1f}s"
    minutes, s = divmod(int(seconds), 60)
    return f"{minutes}m {s}s" if minutes < 60 else f"{minutes // 60}h {minutes % 60}m"


def name_dedup(df: DataFrame, least: int = 85, review_least: int = 75, most: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """(auto, review): names without review keywords are clustered at ``least``, flagged ones at ``review_least``; each
    part over the candidates of every strategy whose columns it has, with the fallback for rows in no pair. Cluster ids
    are record ids, so the two never collide."""
    number = F.regexp_replace("phone", "[^0-9]", "")
    work = {"zip_normalized": F.substring(F.regexp_replace("zip", "[^0-9]", ""), 1, 5), "city_normalized": F.col("city"), "phone_normalized": number}
    keyed = materialize(scoring.with_match_keys(df).withColumns(work), "keys")
    flagged = F.size("review_keywords") > 0
    strategies = [s for s in blocking.STRATEGIES if s != "ssn" or "ssn_token" in df.columns]
    out = []
    for part, n in ((keyed.filter(~flagged), least), (keyed.filter(flagged), review_least)):
        out.append(survivorship.assign_clusters(part, scoring.key_links(part, strategies, n, most)).drop(*(c for c in work if c not in df.columns)))
    return out[0], out[1]

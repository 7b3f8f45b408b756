"""The human-review queue as a table: rows are never updated in place; decisions are a second table joined on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.text import blank

STATUS = {"approve": ("approved", "keep_separate"), "reject": ("rejected", "delete"), "merge": ("merged", "merge_with_cluster")}

QUEUE_DDL = """CREATE TABLE IF NOT EXISTS human_review_queue (id BIGINT, source_record_id BIGINT, name_original STRING, name_parsed STRING, address STRING, city STRING,
  state STRING, zip STRING, phone STRING, email STRING, contact_person STRING, review_keywords STRING, review_reason STRING, flagged_date TIMESTAMP, review_status STRING,
  reviewed_by STRING, reviewed_date TIMESTAMP, review_notes STRING, decision STRING, merge_with_cluster_id BIGINT, merge_with_record_id BIGINT, created_date TIMESTAMP, updated_date TIMESTAMP) USING parquet"""


def queue(df: DataFrame, flagged: Column) -> DataFrame:
    """Queue rows of the records whose name holds a review keyword; ids are the records' ids."""
    hits = K.review_keywords(F.col("name_parsed"))
    rows = df.withColumn("__h", hits).filter(F.size("__h") > 0)
    return rows.select(
        F.col("record_id").alias("id"), F.col("record_id").alias("source_record_id"), F.col("name").alias("name_original"), "name_parsed", "address", "city", "state", "zip", "phone", "email", "contact_person",
        F.array_join("__h", ",").alias("review_keywords"), K.review_reason(F.col("__h")).alias("review_reason"), flagged.cast("timestamp").alias("flagged_date"), F.lit("pending").alias("review_status"),
        *(F.lit(None).cast(t).alias(n) for n, t in (("reviewed_by", "string"), ("reviewed_date", "timestamp"), ("review_notes", "string"), ("decision", "string"), ("merge_with_cluster_id", "bigint"))),
    )


def pending(q: DataFrame) -> DataFrame:
    yes = lambda c: F.when(blank(F.col(c)), "No").otherwise("Yes")
    return q.filter("review_status = 'pending'").select("id", "name_parsed", "city", "state", "zip", "review_keywords", "review_reason", "flagged_date", yes("address").alias("has_address"), yes("phone").alias("has_phone"))


def by_keyword(q: DataFrame, keyword: str) -> DataFrame:
    return q.filter((F.col("review_status") == "pending") & F.col("review_keywords").contains(keyword))


def by_id(q: DataFrame, id_: int) -> DataFrame:
    return q.filter(F.col("id") == id_).limit(1)


def search(q: DataFrame, name: str | None = None, place: str | None = None) -> DataFrame:
    """Pending rows whose name, or city or state, holds the text (ASCII case aside)."""
    out = q.filter("review_status = 'pending'")
    if name is not None:
        out = out.filter(F.col("name_parsed").ilike(f"%{name}%"))
    if place is not None:
        out = out.filter(F.col("city").ilike(f"%{place}%") | (F.col("state") == place))
    return out


def without_contact(q: DataFrame) -> DataFrame:
    return q.filter((F.col("review_status") == "pending") & blank(F.col("address")) & blank(F.col("phone"))).select("id", "name_parsed", "review_keywords")


def page(q: DataFrame, size: int, offset: int) -> DataFrame:
    """The next pending rows, latest first, ids breaking ties."""
    return q.filter("review_status = 'pending'").orderBy(F.desc("flagged_date"), "id").offset(offset).limit(size)


def oldest(q: DataFrame, n: int = 50) -> DataFrame:
    return q.filter("review_status = 'pending'").orderBy("flagged_date", "id").limit(n).select("id", "name_parsed", "city", "state", "flagged_date")


def apply_decisions(q: DataFrame, decisions: DataFrame) -> DataFrame:
    """``decisions``: id, action (approve, reject, merge, reset), reviewed_by, reviewed_date, notes, cluster_id; the
    last one by date counts (of ties the largest action). Reset rows are pending again and keep their notes, marked."""
    d = decisions.groupBy("id").agg(F.max_by(F.struct("action", "reviewed_by", "reviewed_date", "notes", "cluster_id"), F.struct("reviewed_date", "action")).alias("d")).select("id", "d.*")
    d = d.select("id", *(F.col(c).alias(f"__{c}") for c in d.columns if c != "id"))
    x = q.join(d, "id", "left")
    act, reset = F.col("__action"), F.col("__action") == "reset"
    pick = lambda k, old: F.coalesce(*(F.when(act == a, v[k]) for a, v in STATUS.items()), F.when(reset, F.lit("pending") if k == 0 else F.lit(None)), F.when(~F.coalesce(reset, F.lit(False)), F.col(old)))
    keep = lambda new, old: F.when(act.isNull(), F.col(old)).when(reset, None).otherwise(F.col(new))
    notes = F.when(act.isNull(), F.col("review_notes")).when(reset, F.concat(F.coalesce("review_notes", F.lit("")), F.lit(" [RESET]"))).otherwise(F.col("__notes"))
    return x.withColumns({
        "review_status": pick(0, "review_status"), "decision": pick(1, "decision"), "reviewed_by": keep("__reviewed_by", "reviewed_by"), "reviewed_date": keep("__reviewed_date", "reviewed_date"),
        "review_notes": notes, "merge_with_cluster_id": F.when(act == "merge", F.col("__cluster_id")).when(act.isNull(), F.col("merge_with_cluster_id")),
    }).select(*q.columns)


def bulk_approve(q: DataFrame, name: str, reviewer: str, when: Column) -> DataFrame:
    """Approves all pending rows with one name."""
    rows = q.filter((F.col("review_status") == "pending") & (F.col("name_parsed") == name))
    note = F.lit("Bulk approved - similar name pattern")
    return apply_decisions(q, rows.select("id", F.lit("approve").alias("action"), F.lit(reviewer).alias("reviewed_by"), when.alias("reviewed_date"), note.alias("notes"), F.lit(None).cast("bigint").alias("cluster_id")))


def requeue(q: DataFrame, fresh: DataFrame) -> DataFrame:
    """A new run's rows in place of all pending ones; decided rows stay."""
    return q.filter("review_status <> 'pending'").unionByName(fresh)


def approved(q: DataFrame) -> DataFrame:
    return q.filter("review_status = 'approved'").select(F.col("name_parsed").alias("name"), "address", "city", "state", "zip", "phone", "email", "contact_person", "reviewed_by", "reviewed_date")


def purge(q: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Without rows that were decided more than ``days`` days ago."""
    old = F.col("review_status").isin("approved", "rejected", "merged") & (F.col("reviewed_date") < now - F.expr(f"INTERVAL {days} DAYS"))
    return q.filter(~F.coalesce(old, F.lit(False)))


def status_stats(q: DataFrame) -> DataFrame:
    total = q.agg(F.count(F.lit(1)).alias("t"))
    n = q.groupBy("review_status").agg(F.count(F.lit(1)).alias("n"))
    return n.crossJoin(F.broadcast(total)).select("review_status", "n", F.round(F.col("n") * 100.0 / F.col("t"), 1).cast("double").alias("percentage"))


def keyword_stats(q: DataFrame) -> DataFrame:
    """Pending rows by keyword text."""
    return q.filter("review_status = 'pending'").groupBy("review_keywords").agg(F.count(F.lit(1)).alias("pending_count"))


def keyword_breakdown(q: DataFrame, keywords: list[str]) -> DataFrame:
    """Pending rows whose keyword text holds each keyword (TRUST is in TRUSTEE, too)."""
    rows = q.filter("review_status = 'pending'").select(F.explode(F.array(*(F.when(F.col("review_keywords").contains(k), F.lit(k)) for k in keywords))).alias("keyword"))
    return rows.filter("keyword is not null").groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))


def reviewer_stats(q: DataFrame) -> DataFrame:
    return q.filter("review_status <> 'pending'").groupBy("reviewed_by").agg(F.count(F.lit(1)).alias("reviews_completed"), F.min("reviewed_date").alias("first_review"), F.max("reviewed_date").alias("last_review"))


def duplicates(q: DataFrame) -> DataFrame:
    """Names that several pending rows share, with their ids and places in id order."""
    row = F.array_sort(F.collect_list(F.struct("id", F.concat_ws(", ", "city", "state").alias("place"))))
    out = q.filter("review_status = 'pending'").groupBy("name_parsed").agg(F.count(F.lit(1)).alias("duplicate_count"), row.alias("r")).filter("duplicate_count > 1")
    return out.select("name_parsed", "duplicate_count", F.array_join(F.transform("r", lambda x: x["id"].cast("string")), ",").alias("review_ids"), F.array_join(F.transform("r", lambda x: x["place"]), ",").alias("locations"))


def counters(q: DataFrame) -> DataFrame:
    return q.agg(F.count(F.lit(1)).alias("total"), *(F.count_if(F.col("review_status") == s).alias(s) for s in ("pending", "approved", "rejected", "merged")))

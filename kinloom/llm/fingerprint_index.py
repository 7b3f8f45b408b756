"""Substring dedup against a log-structured index of window hashes.

The index holds the entries (see ``anchors``) of all documents so far in runs. A run is a bucketed table in the shared
folder: one row for each bucket of hash space with the bucket's entries sorted by hash, written once and never changed.
A manifest beside the runs, appended to with every change, says which runs are live and at which level, so a later
session opens the folder and goes on. A new batch becomes a run of its own and is merge-joined with the older runs bucket by
bucket: both sides are bucketed alike, so no run is ever shuffled again. As soon as ``fanout`` runs share a level they are
merged, again bucket by bucket, to one run of the next level, in which a (hash, context) keeps only its earliest
document; so a batch meets a number of runs that grows with the logarithm of the batches.

Batches must come in the documents' order: all ids of a batch above those of the batches before it. A batch answers with
asks for blocks. In them every hit is verified word by word: a stretch that repeats an earlier document's is held against
that document's words, and where only an anchor is shared, window by window.

A window is ``WINDOW`` consecutive words. Only a smaller id makes a word go; repeats inside a document stay. Null texts
have no words, texts with fewer words than a window lose nothing. Rows that share an id (or have none; those come
first) stand in the order of their texts and count as documents one after the other. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete, scratch
from . import anchors
from .blobs import by_bucket, pack, unpack
from .common import materialize

WINDOW, GRAM = 50, 14
UNIT = anchors.Unit("word", WINDOW, GRAM, False)
ROWS = "bucket int, blob binary"


class FingerprintIndex:
    """Runs by level under ``folder``. ``buckets`` (parts of hash space), ``files`` (files a run) and ``fanout`` are fixed
    when the index is made."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int, files: int, fanout: int = 4):
        self.spark, self.folder, self.buckets, self.files, self.fanout = spark, folder, buckets, files, fanout
        self.levels: list[list[str]] = [[]]
        self.version = 0
        self.unit = UNIT

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> FingerprintIndex:
        """The index as its newest manifest has it."""
        rows = spark.read.parquet(f"{folder}/manifest")
        rows = rows.join(rows.agg(F.max("version").alias("version")), "version").collect()
        out = cls(spark, folder, rows[0].buckets, rows[0].files, rows[0].fanout)
        out.version = rows[0].version
        for r in sorted(rows, key=lambda r: (r.level, r.place)):
            while len(out.levels) <= r.level:
                out.levels.append([])
            if r.run:
                out.levels[r.level].append(r.run)
        return out

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def _commit(self) -> None:
        self.version += 1
        rows = [(self.version, self.buckets, self.files, self.fanout, k, place, run) for k, level in enumerate(self.levels) for place, run in enumerate(level or [None])]
        schema = "version int, buckets int, files int, fanout int, level int, place int, run string"
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def _table(self, run: str) -> DataFrame:
        """A run as a bucketed table; a session that has not seen it learns it from its folder."""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {run} ({ROWS}) USING parquet CLUSTERED BY (bucket) SORTED BY (bucket) INTO {self.files} BUCKETS LOCATION '{self.folder}/{run}'")
        return self.spark.table(run)

    def _write(self, rows: DataFrame) -> str:
        run = f"run_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(self.files, "bucket").sortBy("bucket").option("path", f"{self.folder}/{run}").saveAsTable(run)
        return run

    def _drop(self, run: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run}")
        delete(self.spark, f"{self.folder}/{run}")

    def add(self, texts: DataFrame) -> DataFrame:
        """(bucket, blob) of a batch's asks, dealt by document; the batch's entries become a run."""
        batch = materialize(self._reduce(anchors.extract(texts, self.unit, self.buckets)), "batch")
        run = self._write(batch.filter("run").select("bucket", "blob"))
        asks = batch.filter("not run").select("bucket", "blob")
        if older := self.runs():
            met = None
            for old in older:
                one = self._met(run, old)
                met = one if met is None else met.unionByName(one)
            asks = asks.unionByName(materialize(met, "met"))
        self.levels[0].append(run)
        gone = self._compact()
        self._commit()
        for old in gone:
            self._drop(old)
        return asks

    def _reduce(self, rows: DataFrame) -> DataFrame:
        """(run, bucket, blob): the batch's own asks, and each bucket's entries as the run keeps them. Entries that
        repeat an earlier document's leave the task as soon as they are seen."""
        unit, buckets = self.unit, self.buckets

        def put(run: bool, rows: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([run] * rows.num_rows), *rows.columns], names=["run", "bucket", "blob"])

        def shrink(cols: list[np.ndarray]):
            kept, asks = anchors.resolve(cols, unit.within, mixed=False)
            return kept, put(False, anchors.by_document(asks, buckets)) if asks else None

        def finish(cols: list[np.ndarray], bucket: int) -> Iterator[pa.RecordBatch]:
            kept, asks = anchors.resolve(cols, unit.within)
            if asks:
                yield put(False, anchors.by_document(asks, buckets))
            yield pa.RecordBatch.from_arrays([pa.array([True]), pa.array([bucket], pa.int32()), pa.array([pack(kept)], pa.binary())], names=["run", "bucket", "blob"])

        dealt = rows.repartition(self.files, "bucket").sortWithinPartitions("bucket")
        return dealt.mapInArrow(lambda it: by_bucket(it, anchors.ENTRY, anchors.HELD, shrink, finish), f"run boolean, {ROWS}")

    def _met(self, run: str, old: str) -> DataFrame:
        """Asks for what a new run shares with an older one: a merge of two sorted columns in each bucket."""
        unit, buckets = self.unit, self.buckets

        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a, b in zip(batch.column(0), batch.column(1), strict=True):
                    new, known = unpack(a.as_py(), anchors.ENTRY), unpack(b.as_py(), anchors.ENTRY)
                    x = np.searchsorted(known[0], new[0], "right") > np.searchsorted(known[0], new[0], "left")
                    y = np.searchsorted(new[0], known[0], "right") > np.searchsorted(new[0], known[0], "left")
                    if not x.any():
                        continue
                    both = [np.r_[p[x], q[y]] for p, q in zip(new, known, strict=True)]
                    fresh = np.r_[np.ones(x.sum(), bool), np.zeros(y.sum(), bool)]
                    if asks := anchors.resolve(both, unit.within, fresh)[1]:
                        yield anchors.by_document(asks, buckets)

        a, b = self._table(run).alias("a"), self._table(old).alias("b")
        joined = a.hint("merge").join(b, F.col("a.bucket") == F.col("b.bucket")).select(F.col("a.blob").alias("new"), F.col("b.blob").alias("old"))
        return joined.mapInArrow(go, ROWS)

    def _compact(self) -> list[str]:
        """Merges full levels; the runs that are no longer live."""
        gone = []
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(self._merged(runs)))
            gone += runs
            level += 1
        return gone

    def _merged(self, runs: list[str]) -> DataFrame:
        """Runs side by side, one row a bucket, merged to one sorted column without a shuffle."""
        rows = self._table(runs[0]).withColumnRenamed("blob", "b0")
        for k, run in enumerate(runs[1:], 1):
            rows = rows.join(self._table(run).withColumnRenamed("blob", f"b{k}").hint("merge"), "bucket", "full")

        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in zip(*batch.columns, strict=True):
                    parts = [unpack(x.as_py(), anchors.ENTRY) for x in row[1:] if x.is_valid]
                    cols, _, kept, _ = anchors.classes([np.concatenate(c) for c in zip(*parts, strict=True)], False)
                    yield pa.RecordBatch.from_arrays([pa.array([row[0].as_py()], pa.int32()), pa.array([pack([c[kept] for c in cols])], pa.binary())], names=["bucket", "blob"])

        return rows.mapInArrow(go, ROWS)


def verify(batches: Iterator[pa.RecordBatch], chunk_bytes: int = 1 << 20) -> Iterator[tuple[int, int, int, int]]:
    """(key, idx, start, end): word ranges under a window that an earlier document holds too, from PIECE rows. A repeat is
    compared with its source's words; what does not agree as a whole, and mixed pieces, window by window."""

    def by_window(rows: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        rows = sorted({x[2:5] + (x[6],) for x in rows})
        for (key, idx, start, _), gone in zip(rows, again(rows), strict=True):
            for a, b in zip(*anchors.merge(gone, gone + WINDOW), strict=True):
                yield key, idx, start + int(a), start + int(b)

    def work(sources: list[tuple], rest: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        blocks: dict[int, tuple[list, list, list]] = {}
        for row in sources + rest:
            blocks.setdefault(row[0], ([], [], []))[(1, 0, 2)[row[1]]].append(row)
        for known, repeats, mixed in blocks.values():
            known.sort(key=lambda x: x[4])
            begins, words = [x[4] for x in known], [x[6].split(b" ") for x in known]
            for row in repeats:
                key, idx, start, first, piece = row[2:]
                n = piece.count(b" ") + 1
                at = bisect_right(begins, first) - 1
                if at >= 0 and b" ".join(words[at][first - begins[at] : first - begins[at] + n]) == piece:
                    yield key, idx, start, start + n
                else:
                    yield from (x for x in by_window([*known, row]) if x[:2] == (key, idx))
            yield from by_window(mixed)

    return anchors.in_blocks(batches, chunk_bytes, work)


def again(rows: list[tuple]) -> list[np.ndarray]:
    """Of rows (key, idx, start, piece) the windows, from the piece's start, whose words an earlier document among them
    holds too."""
    first: dict[bytes, tuple] = {}
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(rows)
    for k in sorted(range(len(rows)), key=lambda k: rows[k][:3]):
        words, doc = rows[k][3].split(b" "), rows[k][:2]
        windows = (b" ".join(words[i : i + WINDOW]) for i in range(len(words) - WINDOW + 1))
        out[k] = np.array([i for i, w in enumerate(windows) if first.setdefault(w, doc) != doc], np.int64)
    return out


def batches(texts: DataFrame, n: int) -> list[DataFrame]:
    """The rows in ``n`` batches of about as many rows, by ranges of the key."""
    bounds = sorted({int(x) for x in texts.approxQuantile("key", [k / n for k in range(1, n)], 0.01)}) if n > 1 else []
    edges = [None, *bounds, None]
    out = []
    for low, high in zip(edges, edges[1:], strict=False):
        rows = texts if low is None else texts.filter(F.col("key") >= low)
        out.append(rows if high is None else rows.filter(F.col("key") < high))
    return out


def cuts(texts: DataFrame, buckets: int, n_batches: int = 4, fanout: int = 3) -> DataFrame:
    """Ranges that go, dealt by document, of keyed rows, taken into a new index batch by batch."""
    spark = texts.sparkSession
    index = FingerprintIndex(spark, scratch(spark, "index"), buckets, buckets, fanout)
    asks = None
    for batch in batches(texts, n_batches):
        got = index.add(batch)
        asks = got if asks is None else asks.unionByName(got)
    return anchors.cut_rows(anchors.pieces(asks, texts, UNIT, buckets, again), verify, buckets)


def _digest(text: bytes, s: np.ndarray, e: np.ndarray) -> tuple:
    words = text.split()
    at, out = 0, []
    for a, b in zip(s.tolist(), e.tolist(), strict=True):
        out += words[at:a]
        at = b
    out += words[at:]
    return len(words), len(words) - len(out), hashlib.sha256(b" ".join(out)).hexdigest()


_digest.types = (pa.int64(), pa.int64(), pa.string())


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    texts = anchors.prepare(docs)
    buckets = anchors.bucket_count(texts)
    return anchors.apply_cuts(texts, cuts(texts, buckets), buckets, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string", _digest)

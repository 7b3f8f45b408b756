"""Order MinHash: fingerprints that are sensitive to edit distance.

The k-mers of a text (``K`` bytes of its UTF-8) are numbered by occurrence, so a repeated k-mer counts as often as it
occurs. Each of ``M`` hash functions picks the ``L`` numbered k-mers with the smallest values; these are put back in
text order and hashed as a tuple, which is one component. Two texts agree in a component with a probability that falls
with their edit distance, also when the same k-mers stand in another order.

A text shorter than K bytes is one k-mer, padded with zero bytes; the empty text (and null) has the fingerprint of no
k-mers. Equal texts have equal fingerprints.

``next_pairs`` deals rows to ranges of ids and lends every range the first row of the following one, so a row meets its
successor without a global window; within a range rows are sorted by Spark and read as a stream. Null ids stand first;
rows with equal ids stand by text. The last row's successor is the first one; a single row follows itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions, text_bytes, tune

K, M, L = 8, 32, 2
_draw = np.random.Generator(np.random.PCG64(20240607))
_FACTORS = (_draw.integers(0, 1 << 31, M, dtype=np.uint64) * 2 + 1).astype(np.uint32)
_OFFSETS = _draw.integers(0, 1 << 32, M, dtype=np.uint64).astype(np.uint32)
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _numbered(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the occurrence-numbered k-mers, and their places in the text. A k-mer is known by its full 64-bit
    hash, so it is numbered and hashed alike in texts of every length."""
    n = max(len(text) - K + 1, 1)
    h = np.ndarray((n,), np.uint64, buffer=text + b"\0" * (K - len(text)) if len(text) < K else text, strides=(1,)).copy()
    h ^= h >> np.uint64(31)
    h *= _P1
    h ^= h >> np.uint64(29)
    h *= _P2
    places = np.argsort(h)
    keys = h[places]
    fresh = np.ones(n, bool)
    np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
    index = np.arange(n)
    lead = np.maximum.accumulate(np.where(fresh, index, 0))
    if not fresh.all():  # equal k-mers are numbered as they come in the text
        member = np.flatnonzero(~fresh | np.r_[~fresh[1:], False])
        part = places[member]
        places[member] = part[np.lexsort((part, lead[member]))]
    number = (index - lead).astype(np.uint64)
    x = (keys + number * _P2) * _P1
    x ^= x >> np.uint64(32)
    x *= _P2
    return (x >> np.uint64(32)).astype(np.uint32), places


def fingerprint(text: bytes) -> np.ndarray:
    """M components of 32 bits."""
    if not text:
        return np.zeros(M, np.uint32)
    x, places = _numbered(text)
    buf = np.empty_like(x)
    out = np.empty((M, 2), np.uint64)
    top = np.uint32(0xFFFFFFFF)
    one = len(x) < L
    for k in range(M):
        np.multiply(x, _FACTORS[k], out=buf)
        np.add(buf, _OFFSETS[k], out=buf)
        i = int(buf.argmin())
        if one:
            out[k] = x[i], 0
            continue
        buf[i] = top
        j = int(buf.argmin())
        if places[i] > places[j]:
            i, j = j, i
        out[k] = x[i], x[j]
    t = (out[:, 0] * _P1 + out[:, 1]) * _P2
    t ^= t >> np.uint64(29)
    t *= _P1
    return (t >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edit(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bucket(key: Column, bounds: list[int], at: int = 0) -> Column:
    """The number of bounds that are at most ``key``, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(at)
    mid = len(bounds) // 2
    return F.when(key < bounds[mid], _bucket(key, bounds[:mid], at)).otherwise(_bucket(key, bounds[mid + 1 :], at + mid + 1))


def next_pairs(docs: DataFrame) -> DataFrame:
    """Rows (bucket, lent, key, doc_id, text), each range's rows together and in order, its lent rows last."""
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    keyed = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    n = 4 * partitions(spark)
    bounds = sorted({int(x) for x in docs.approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (4 * n))} if n > 1 else ())
    keyed = keyed.withColumn("bucket", _bucket(F.col("key"), bounds))
    firsts = sorted((r["bucket"], r["first"]) for r in keyed.groupBy("bucket").agg(F.min("key").alias("first")).collect())
    before = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}  # one entry for each range
    lender = F.col("key").isin(*before) if before else F.lit(False)
    previous = F.coalesce(*(F.when(F.col("key") == first, b) for first, b in before.items()), F.lit(-1)) if len(before) <= 32 else F.element_at(
        F.create_map(*(F.lit(v) for item in before.items() for v in item)), F.col("key")
    )
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("lent"))
    lent = F.struct(previous.cast("int").alias("bucket"), F.lit(1).alias("lent"))
    dealt = keyed.select(F.explode(F.when(lender, F.array(own, lent)).otherwise(F.array(own))).alias("to"), "key", "doc_id", "text")
    dealt = dealt.select("to.bucket", "to.lent", "key", "doc_id", "text")
    return dealt.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "lent", "key", "text")


OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and the likeness of both and of the successor's."""
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last = None  # (bucket, doc_id, text, fingerprint) of the row that waits for its successor

        def emit(following: bytes, fp: np.ndarray) -> None:
            _, doc_id, text, own = last
            s = text.decode("utf-8", "replace")
            changed = edit(s, following.decode("utf-8", "replace")).encode()
            changed_fp = fingerprint(changed)
            rows.append((doc_id, len(s), hashlib.sha256(changed).hexdigest(), own.astype(">u4").tobytes().hex(), changed_fp.astype(">u4").tobytes().hex(), likeness(own, changed_fp), likeness(own, fp)))

        def ship() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            rows.clear()
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = [x.split(" ")[0] for x in OUT.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for batch in batches:
            buckets, lents, ids = (batch.column(k).to_pylist() for k in (0, 1, 3))
            for b, lent, doc_id, cell in zip(buckets, lents, ids, batch.column(4), strict=True):
                text = cell.as_py()
                if lent:
                    if last and last[0] == b:  # the first of the lent rows follows the range's last row
                        emit(text, fingerprint(text))
                    last = None
                    continue
                fp = fingerprint(text)
                if last:
                    emit(text, fp)
                last = (b, doc_id, text, fp)
            if rows:
                yield ship()
        if last:
            raise ValueError("a range has no successor")

    return next_pairs(docs).select("bucket", "lent", "key", "doc_id", "text").mapInArrow(run, OUT)

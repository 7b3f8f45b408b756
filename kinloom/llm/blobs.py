"""Columns of numbers packed into binary cells: what goes through a shuffle as one row per batch and bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def pack(columns: list[np.ndarray]) -> bytes:
    return b"".join(c.tobytes() for c in columns)


def unpack(blob: bytes, kinds: list) -> list[np.ndarray]:
    n = len(blob) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for k in kinds:
        out.append(np.frombuffer(blob, k, n, at))
        at += n * np.dtype(k).itemsize
    return out


def deal(buckets: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch | None:
    """One row (bucket, blob) for each bucket that occurs."""
    if not len(buckets):
        return None
    order = np.argsort(buckets, kind="stable")
    sorted_buckets = buckets[order]
    columns = [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(sorted_buckets)) + 1
    starts, ends = np.r_[0, cuts], np.r_[cuts, len(order)]
    return pa.RecordBatch.from_arrays(
        [pa.array(sorted_buckets[starts].astype(np.int32)), pa.array([pack([c[s:e] for c in columns]) for s, e in zip(starts, ends, strict=True)], pa.binary())],
        names=["bucket", "blob"],
    )


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """An even bucket from 0 to n - 1 also where the hashes are all small, as minima are."""
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((h >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def by_bucket(batches: Iterator[pa.RecordBatch], kinds: list, limit: int, shrink: Callable, finish: Callable) -> Iterator[pa.RecordBatch]:
    """Streams rows (bucket, blob) that come with each bucket's rows together. ``shrink(columns)`` returns what must be
    kept and a batch to emit or None; it runs whenever a bucket's entries outgrow ``limit``. ``finish(columns, bucket)``
    yields batches at a bucket's end."""
    now, parts, size, floor = None, [], 0, limit

    def gather() -> list[np.ndarray]:
        return [np.concatenate([p[k] for p in parts]) for k in range(len(kinds))]

    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if bucket != now:
                if parts:
                    yield from finish(gather(), now)
                now, parts, size, floor = bucket, [], 0, limit
            parts.append(unpack(blob.as_py(), kinds))
            size += len(parts[-1][0])
            if size > floor:
                kept, out = shrink(gather())
                parts, size = [kept], len(kept[0])
                floor = max(limit, 2 * size)
                if out is not None:
                    yield out
    if parts:
        yield from finish(gather(), now)

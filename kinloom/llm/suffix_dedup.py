"""Suffix-array dedup: removes every byte under a ``WINDOW``-byte string that also starts earlier.

Anchors (see ``anchors``) choose which stretches of text meet in a block, and nothing else: every removal comes from the
block's suffix array. The stretches are laid end to end and their suffixes sorted in two stages (Itoh and Tanaka): only
suffixes smaller than their successors are sorted directly, by their first ``DEPTH`` bytes; all others are induced by one
scan of the buckets of first bytes. Adjacent suffixes with a common prefix of at least a window start equal strings, and
of each run of such suffixes the earliest place in the corpus stays.

An array of the whole corpus would move 100 bytes for every byte of text; a repeated stretch moves about once, and text
that repeats nowhere stays where it is.

Null text is empty. Texts shorter than a window lose nothing. Rows that share an id (or have none; those come first)
stand in the order of their texts. An empty table gives no rows; other columns are not touched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors

WINDOW, GRAM, DEPTH = 100, 32, 104
UNIT = anchors.Unit("byte", WINDOW, GRAM, True)


def _word(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place, as a number that sorts as they do."""
    view = np.ndarray((len(padded) - 7,), np.uint64, buffer=padded, strides=(1,))
    return view[at].byteswap()


def direct_sort(padded: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their first ``depth`` bytes; ties stand in any order."""
    view = np.ndarray((len(padded) - depth + 1,), f"S{depth}", buffer=padded, strides=(1,))
    return at[np.argsort(view[at])]


def suffix_array(text: bytes, wanted: np.ndarray | None = None, depth: int = DEPTH) -> np.ndarray:
    """Starts of the ``wanted`` suffixes (a mask; all without one) in the order of at least their first ``depth`` bytes,
    ties in any order. A suffix that is not wanted is left out unless a wanted one is induced from it."""
    n = len(text)
    t = np.frombuffer(text, np.uint8)
    padded = np.zeros(n + depth + 16, np.uint8)
    padded[:n] = t
    # A suffix is small if it is below its successor; equal bytes decide as their successor does; the last is not.
    rise = np.zeros(n, np.int8)
    rise[:-1] = np.sign(t[1:].astype(np.int16) - t[:-1])
    rise[-1] = -1
    source = np.where(rise != 0, np.arange(n), n - 1)
    source = np.minimum.accumulate(source[::-1])[::-1]
    small = rise[source] > 0
    if wanted is None:
        need = np.ones(n, bool)
    else:  # a wanted large suffix needs its successors up to the first small one
        near = np.minimum.accumulate(np.where(small, np.arange(n), n - 1)[::-1])[::-1]
        reach = np.maximum.accumulate(np.where(wanted, near, -1))
        need = np.arange(n) <= reach
    counts = np.bincount(t[need], minlength=256)
    end = np.cumsum(counts)
    begin = end - counts
    sa = np.empty(int(need.sum()), np.int64)
    direct = direct_sort(padded, np.flatnonzero(small & need), depth)
    n_small = np.bincount(t[direct], minlength=256)
    at = 0
    for c in np.flatnonzero(n_small):
        sa[end[c] - n_small[c] : end[c]] = direct[at : at + n_small[c]]
        at += n_small[c]
    fill = begin.copy()
    if need[-1]:
        sa[fill[t[-1]]] = n - 1
        fill[t[-1]] += 1
    large = need & ~small

    def induce(seen: np.ndarray) -> None:
        before = seen[seen > 0] - 1
        before = before[large[before]]
        if not len(before):
            return
        chars = t[before]
        order = np.argsort(chars, kind="stable")
        before, chars = before[order], chars[order]
        cuts = np.flatnonzero(np.diff(chars)) + 1
        for s, e in zip(np.r_[0, cuts], np.r_[cuts, len(chars)], strict=True):
            c = chars[s]
            sa[fill[c] : fill[c] + e - s] = before[s:e]
            fill[c] += e - s

    for c in np.flatnonzero(counts):
        done = begin[c]
        while done < fill[c]:
            upto = fill[c]
            induce(sa[done:upto].copy())
            done = upto
        induce(sa[end[c] - n_small[c] : end[c]])
    return sa


def common_prefixes(text: bytes, sa: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Equal leading bytes of each suffix in ``sa`` and the one before it, up to ``depth``; 0 for the first."""
    padded = np.zeros(len(text) + depth + 16, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    out = np.zeros(len(sa), np.int64)
    view = np.ndarray((len(text) + 1,), f"S{depth}", buffer=padded, strides=(1,))[sa]
    live = 1 + np.flatnonzero(view[1:] != view[:-1])
    out[1:] = depth
    for step in range(0, depth, 8):
        a, b = _word(padded, sa[live] + step), _word(padded, sa[live - 1] + step)
        x = a ^ b
        equal = x == 0
        diff = live[~equal]
        x = x[~equal]
        lead = np.zeros(len(x), np.int64)
        for k in range(1, 8):
            lead += x < np.uint64(1 << (64 - 8 * k))
        out[diff] = step + lead
        live = live[equal]
        if not len(live):
            break
    edge = len(text) - sa
    out[1:] = np.minimum(out[1:], np.minimum(edge[1:], edge[:-1]))
    return out


def repeats(pieces: list[bytes], places: np.ndarray | None = None, window: int = WINDOW) -> list[np.ndarray]:
    """For each piece the starts of its windows that also start at an earlier place. ``places`` numbers the pieces' first
    bytes in the corpus's order (a place may come twice); without it the pieces stand one after the other."""
    text = b"".join(pieces)
    sizes = np.array([len(x) for x in pieces], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    owner = np.repeat(np.arange(len(pieces)), sizes)
    starts = np.arange(len(text)) + window <= ends[owner]
    sa = suffix_array(text, starts) if starts.any() else np.zeros(0, np.int64)
    sa = sa[starts[sa]]
    if not len(sa):
        return [np.zeros(0, np.int64) for _ in pieces]
    place = sa if places is None else places[owner[sa]] + (sa - begins[owner[sa]])
    head = common_prefixes(text, sa) < window
    run = np.cumsum(head) - 1
    least = np.minimum.reduceat(place, np.flatnonzero(head))
    again = np.sort(sa[place > least[run]])
    cut = np.searchsorted(again, np.r_[0, ends])
    return [again[cut[k] : cut[k + 1]] - begins[k] for k in range(len(pieces))]


def compare(batches: Iterator[pa.RecordBatch], chunk_bytes: int = 1 << 20) -> Iterator[tuple[int, int, int, int]]:
    """(key, idx, start, end): ranges that go, from PIECE rows."""

    def work(sources: list[tuple], rest: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        rows = sorted({x[2:5] + (x[6],) for x in sources + rest}, key=lambda x: (x[:3], -len(x[3])))
        for (key, idx, start, _), gone in zip(rows, again(rows), strict=True):
            for a, b in zip(*anchors.merge(gone, gone + WINDOW), strict=True):
                yield key, idx, start + int(a), start + int(b)

    return anchors.in_blocks(batches, chunk_bytes, work)


def again(rows: list[tuple]) -> list[np.ndarray]:
    """Of rows (key, idx, start, piece) the windows, from the piece's start, that also start at an earlier place."""
    documents = {d: k for k, d in enumerate(sorted({x[:2] for x in rows}))}
    return repeats([x[3] for x in rows], np.array([(documents[x[:2]] << 32) + x[2] for x in rows], np.int64))


def cuts(texts: DataFrame, buckets: int) -> DataFrame:
    """Ranges that go, dealt by document, of keyed rows."""
    asks = anchors.read_buckets(anchors.extract(texts, UNIT, buckets), UNIT, buckets)
    return anchors.cut_rows(anchors.pieces(asks, texts, UNIT, buckets, again), compare, buckets)


def kept_bytes(text: bytes, s: np.ndarray, e: np.ndarray) -> bytes:
    at, out = 0, []
    for a, b in zip(s.tolist(), e.tolist(), strict=True):
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return b"".join(out)


def kept_text(text: bytes, s: np.ndarray, e: np.ndarray) -> str:
    """What is left as text: a character goes only if all its bytes do."""
    t = np.frombuffer(text, np.uint8)
    tail = lambda i: i < len(t) and 0x80 <= t[i] < 0xC0
    inner = []
    for a, b in zip(s.tolist(), e.tolist(), strict=True):
        while a < b and tail(a):
            a += 1
        if tail(b):
            b -= 1
            while b > a and tail(b):
                b -= 1
        if a < b:
            inner.append((a, b))
    x = np.array(inner, np.int64).reshape(-1, 2)
    return kept_bytes(text, x[:, 0], x[:, 1]).decode("utf-8", "replace")


def _digest(text: bytes, s: np.ndarray, e: np.ndarray) -> tuple:
    return len(text), int((e - s).sum()), len(s), hashlib.sha256(kept_bytes(text, s, e)).hexdigest()


_digest.types = (pa.int64(), pa.int64(), pa.int64(), pa.string())


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    texts = anchors.prepare(docs)
    buckets = anchors.bucket_count(texts)
    return anchors.apply_cuts(texts, cuts(texts, buckets), buckets, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", _digest)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of ``text``, and ``n_chars`` (if there) counted anew. A null text stays null."""
    others = [c for c in docs.columns if c != "text"]
    texts = anchors.prepare(docs, others)
    buckets = anchors.bucket_count(texts)
    cut = anchors.per_document(cuts(texts, buckets), anchors.CUT, "cut", buckets, whole=True)
    joined = texts.join(cut.hint("merge"), ["key", "idx"], "left").select("doc_id", "text", "cut", "missing", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [None if gone else kept_text(text.as_py(), *anchors.merged(blob.as_py())) for text, blob, gone in zip(*batch.columns[1:3], batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(4), pa.array(left, pa.string())], names=["row", "left"])

    # All columns of the texts go in, though not all are used: so both joins share one shuffle of the texts.
    rows = joined.mapInArrow(run, joined.select("row").schema.add("left", "string"))
    out = rows.select(*(F.col("left").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out

"""Bringing together all places of a corpus that may hold the same window, without shuffling every window.

A text is a row of symbols (bytes, or words). Each window of ``window`` symbols has one anchor: the leftmost of its
``gram``-symbol grams with the smallest hash. Equal windows have equal anchors at the same offset, so whoever compares
only windows that share an anchor misses none. Consecutive windows with the same anchor form one entry:

    h     hash of the anchor gram
    c     hash of the whole stretch that the entry's windows cover (the context) and of the anchor's place in it
    key   the document's id (null: the smallest number), idx its number among rows with that id
    p     the anchor's place;  l  places from the first window's start to p;  n  windows less one

Hashes only choose which texts meet in a block; what is removed is decided there by comparing the symbols themselves
(``suffix_dedup`` by a suffix array, ``fingerprint_index`` word by word). ``resolve`` reads the entries of a part of hash
space and asks for blocks:

    REPEAT  the entry's (h, c) also stands earlier, at the class's first entry A: its windows go to a block of A's text.
            Neighbouring entries with one A travel as one stretch, so a repeated passage moves about once.
    SOURCE  A's own windows go to that block. A class with m repeats has about sqrt(m) blocks, dealt by the repeats' ids,
            so a hot passage is compared by many tasks, each against a copy of A.
    MIXED   different contexts under one h may share some windows: the class's firsts meet in a block named by h.
    SPLIT   a block of more than ``MIXED_MOST`` of those is split by content: every window goes to the block of its own
            symbols' hash, so a gram that stands in very many neighbourhoods burdens no single task. Before they are
            sent, the task that holds their texts compares them with each other, and only windows that do not repeat
            there go on; the ranges that go are passed along as such (GONE).

Empty tables give no rows. Null texts are empty. A null id stands before all others; rows that share an id, or have
none, are numbered in the order of their texts, in ranges, so that no id's rows are gathered in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from .blobs import bucket_of, by_bucket, deal, pack, unpack
from .common import partitions, text_bytes, tune
from .hashing import P1, P2, mix, pair_hash, range_hashes, word_hashes

NO_ID = -(1 << 63)
#: An entry: h, c, key, idx, p, l, n.
ENTRY = [np.uint64, np.uint64, np.int64, np.int64, np.int32, np.uint8, np.uint8]
#: What is asked of a document: key, idx, kind, first window's start, windows less one, block, A's start, blocks of A.
ASK = [np.int64, np.int64, np.uint8, np.int32, np.uint8, np.uint64, np.int32, np.uint32]
#: A range of symbols that goes: key, idx, start, end.
CUT = [np.int64, np.int64, np.int32, np.int32]
REPEAT, SOURCE, MIXED, SPLIT, GONE = 0, 1, 2, 3, 4
MIXED_MOST = 1024
SEGMENT = 16  # a block holds A's windows that start in one stretch of 2^16 symbols
HELD = 2_000_000  # rows that a task gathers before it lets go what it can


class Unit(NamedTuple):
    """What a symbol is: ``byte`` or ``word``, how many make a window and a gram, and whether a repeat inside one
    document counts."""

    name: str
    window: int
    gram: int
    within: bool


def keyed(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """doc_id, key, idx and the text as bytes; with ``carry`` also those columns as a struct ``row``, and ``missing`` for
    a null text."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    more = [F.col("text").isNull().alias("missing"), F.struct(*(docs[c] for c in carry)).alias("row")] if carry else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), text_bytes().alias("text"), *more)
    again = rows.groupBy("key").count().filter(F.col("count") > 1).select("key")
    names = ["doc_id", "key", "idx", "text", *(["missing", "row"] if carry else [])]
    once = rows.withColumn("idx", F.lit(0).cast("long")).select(*names)
    if again.isEmpty():
        return once
    several = numbered(rows.join(again, "key", "left_semi"), "key", "text", name="idx").withColumn("idx", F.col("idx").cast("long"))
    return once.join(again, "key", "left_anti").select(*names).unionByName(several.select(*names))


def prepare(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    tune(docs.sparkSession)
    return keyed(docs, carry)


def bucket_count(rows: DataFrame, bytes_each: int = 64 << 20) -> int:
    """At least one bucket for each shuffle partition, and for each ``bytes_each`` of text."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(partitions(rows.sparkSession), -(-total // bytes_each))


def gram_hashes(text: bytes, unit: Unit) -> np.ndarray:
    """A hash of every gram; fewer symbols than a window give none."""
    k = unit.gram
    if unit.name == "byte":
        n = len(text)
        if n < unit.window:
            return np.zeros(0, np.uint64)
        out = None
        for at in range(0, k, 8):
            x = np.ndarray((n - k + 1,), np.uint64, buffer=text, offset=at, strides=(1,))
            out = mix(x if out is None else out + x)
        return out
    words = text.split()
    if len(words) < unit.window:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    starts = np.arange(len(words) - k + 1)
    return range_hashes(h, starts, starts + k)


def entries(text: bytes, unit: Unit) -> tuple[np.ndarray, ...]:
    """h, c, p, l and n of a text. Grams are ranked by the upper 32 bits of their hashes at every length of text, so
    equal windows have equal anchors wherever they stand; ties go to the leftmost."""
    g = gram_hashes(text, unit)
    if not len(g):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    span = unit.window - unit.gram + 1  # grams of a window
    low = (g >> np.uint64(32) << np.uint64(32)) | np.arange(len(g), dtype=np.uint64)
    have = 1
    while have < span:  # minima of `have` grams, doubled until they cover a window
        step = min(have, span - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(anchor)) + 1
    first, last = np.r_[0, cuts], np.r_[cuts, len(anchor)] - 1
    p = anchor[first]
    c = range_hashes(g, first, last + span) + mix((p - first).astype(np.uint64) + P2)
    return g[p], c, p, p - first, last - first


def extract(rows: DataFrame, unit: Unit, buckets: int) -> DataFrame:
    """(bucket, blob) of the entries of keyed rows, dealt by h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for key, idx, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                h, c, p, l, n = entries(text.as_py(), unit)
                if len(h):
                    parts.append((h, c, np.full(len(h), key, np.int64), np.full(len(h), idx, np.int64), p.astype(np.int32), l.astype(np.uint8), n.astype(np.uint8)))
            if parts:
                cols = [np.concatenate([x[k] for x in parts]) for k in range(len(ENTRY))]
                yield deal(bucket_of(cols[0], buckets), cols)

    return rows.select("key", "idx", "text").mapInArrow(run, "bucket int, blob binary")


def classes(cols: list[np.ndarray], within: bool):
    """The entries in order, and for each: whether it opens its (h, c), whether it stays in the class, and the place of
    the class's first. Without ``within`` all entries of the first one's document stay."""
    h, c, key, idx, p = cols[:5]
    order = np.lexsort((p, idx, key, c, h))
    cols = [x[order] for x in cols]
    h, c, key, idx = cols[:4]
    head = np.ones(len(h), bool)
    head[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    lead = np.maximum.accumulate(np.where(head, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
    kept = head if within else (key == key[lead]) & (idx == idx[lead])
    return cols, head, kept, lead


def _asks(kind: int, cols: list[np.ndarray], where: np.ndarray, block: np.ndarray, first=0, copies=1) -> list[np.ndarray]:
    _, _, key, idx, p, l, n = (c[where] for c in cols[:7])
    m = len(key)
    fill = lambda v, t: np.broadcast_to(np.asarray(v), m).astype(t)
    return [key, idx, fill(kind, np.uint8), (p - l).astype(np.int32), n, block, fill(first, np.int32), fill(copies, np.uint32)]


def blocks_of(m: np.ndarray) -> np.ndarray:
    """How many blocks share the m repeats of a class."""
    return np.ceil(m / (64 + 8 * np.sqrt(m))).astype(np.uint64)


def resolve(cols: list[np.ndarray], within: bool, fresh: np.ndarray | None = None, mixed: bool = True):
    """(entries that stay in their class, in order; asks). With ``fresh`` (a mask) only pairs that hold a fresh entry are
    asked for; ``mixed`` says whether different contexts are to meet as well."""
    if fresh is not None:
        cols = [*cols[:7], fresh]
    cols, head, kept, lead = classes(cols, within)
    new = cols[7] if fresh is not None else np.ones(len(head), bool)
    h, _, key, idx, p, l = cols[:6]
    out = []
    gone = ~kept & new
    if gone.any():
        a = lead[gone]
        number = np.cumsum(head) - 1
        m = blocks_of(np.bincount(number[gone], minlength=number[-1] + 1))[number[a]]
        start = (p - l)[a]
        base = pair_hash(pair_hash(key[a], idx[a]), (start >> SEGMENT).astype(np.uint64) * P2 + m)
        salt = pair_hash(key[gone], idx[gone]) % m
        out.append(_asks(REPEAT, cols, gone, mix(base + salt * P1), start))
        _, one = np.unique(a, return_index=True)
        out.append(_asks(SOURCE, cols, a[one], base[one], 0, m[one]))
    if mixed and len(h):
        group = np.cumsum(np.r_[True, h[1:] != h[:-1]]) - 1
        ask = kept & (np.bincount(group, weights=head)[group] > 1) & (np.bincount(group, weights=kept & new)[group] > 0)
        if ask.any():
            many = np.bincount(group, weights=kept)[group] > MIXED_MOST
            for kind, where in ((MIXED, ask & ~many), (SPLIT, ask & many)):
                if where.any():
                    out.append(_asks(kind, cols, where, h[where]))
    asks = [np.concatenate([x[k] for x in out]) for k in range(len(ASK))] if out else None
    return [x[kept] for x in cols[:7]], asks


def by_document(asks: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """(bucket, blob) of columns that begin with key and idx, dealt by document."""
    return deal(bucket_of(pair_hash(asks[0], asks[1]), buckets), asks)


def read_buckets(dealt: DataFrame, unit: Unit, buckets: int, limit: int = HELD) -> DataFrame:
    """(bucket, blob) of asks, dealt by document. Repeats leave a task as soon as they are seen."""

    def shrink(cols: list[np.ndarray]):
        kept, asks = resolve(cols, unit.within, mixed=False)
        return kept, by_document(asks, buckets) if asks else None

    def finish(cols: list[np.ndarray], _) -> Iterator[pa.RecordBatch]:
        if asks := resolve(cols, unit.within)[1]:
            yield by_document(asks, buckets)

    dealt = dealt.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda it: by_bucket(it, ENTRY, limit, shrink, finish), "bucket int, blob binary")


def per_document(dealt: DataFrame, kinds: list, name: str, buckets: int, whole: bool, limit: int = HELD) -> DataFrame:
    """(key, idx, ``name``): the packed columns of each document, from rows dealt by document. Unless they must come
    ``whole``, a task lets them go in parts."""

    def ship(cols: list[np.ndarray]) -> pa.RecordBatch:
        order = np.lexsort((cols[1], cols[0]))
        cols = [c[order] for c in cols]
        key, idx = cols[:2]
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (idx[1:] != idx[:-1])])
        ends = np.r_[starts[1:], len(key)]
        body = [pack([c[s:e] for c in cols[2:]]) for s, e in zip(starts, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(key[starts]), pa.array(idx[starts]), pa.array(body, pa.binary())], names=["key", "idx", name])

    def shrink(cols: list[np.ndarray]):
        return (cols, None) if whole else ([c[:0] for c in cols], ship(cols))

    def finish(cols: list[np.ndarray], _) -> Iterator[pa.RecordBatch]:
        if len(cols[0]):
            yield ship(cols)

    dealt = dealt.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda it: by_bucket(it, kinds, limit, shrink, finish), f"key bigint, idx bigint, {name} binary")


PIECE = "block bigint, role tinyint, key bigint, idx bigint, start int, first int, piece binary"


def stretches(kind: np.ndarray, s: np.ndarray, n: np.ndarray, block: np.ndarray, first: np.ndarray, copies: np.ndarray) -> Iterator[tuple]:
    """(role, block, start, windows, first) of what a document's asks come to: sources once for each of their blocks,
    and windows that follow each other merged where they go to the same block (and, for repeats, to the same place)."""
    for role in (REPEAT, SOURCE, MIXED):
        at = kind == role
        if not at.any():
            continue
        b, i, m, f = block[at], s[at].astype(np.int64), n[at].astype(np.int64), first[at].astype(np.int64)
        if role == SOURCE:
            times = copies[at].astype(np.int64)
            rank = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            b, i, m, f = mix(np.repeat(b, times) + rank.astype(np.uint64) * P1), np.repeat(i, times), np.repeat(m, times), np.repeat(i, times)
        shift = f - i if role == REPEAT else np.zeros(len(i), np.int64)
        order = np.lexsort((i, shift, b))
        b, i, m, f, shift = b[order], i[order], m[order], f[order], shift[order]
        reach = i + m + 1  # the start after the last window
        opens = np.r_[True, (b[1:] != b[:-1]) | (shift[1:] != shift[:-1]) | (i[1:] > reach[:-1])]
        heads = np.flatnonzero(opens)
        last = np.maximum.reduceat(reach, heads) - i[heads]
        yield from zip([role] * len(heads), b[heads].view(np.int64).tolist(), i[heads].tolist(), last.tolist(), f[heads].tolist(), strict=True)


def pieces(asks: DataFrame, texts: DataFrame, unit: Unit, buckets: int, again, chunk_bytes: int = 1 << 20) -> DataFrame:
    """PIECE rows, the rows of one block together and its sources first. A piece is the symbols that its windows cover;
    words are joined by one space. ``again(rows)`` says for rows (key, idx, start, piece) which windows, counted from the
    piece's start, repeat an earlier one of them."""
    asked = per_document(asks, ASK, "asked", buckets, whole=False)
    # All columns of the texts stay, as in the last join with them, and there is a shuffle at every size: Spark then
    # moves the texts once for both joins.
    joined = texts.join(asked.hint("merge"), ["key", "idx"]).select("key", "idx", "text", "asked", *(c for c in texts.columns if c not in ("key", "idx", "text")))
    names = [x.split(" ")[0] for x in PIECE.split(", ")]
    types = (pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    symbols = (lambda x: x) if unit.name == "byte" else bytes.split
    joint = b"" if unit.name == "byte" else b" "
    cut = lambda body, a, e: body[a:e] if unit.name == "byte" else joint.join(body[a:e])

    def ship(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def split(held: list[tuple]) -> list[tuple]:
        out = []
        for (key, idx, start, piece), gone in zip(held, again(held), strict=True):
            body = symbols(piece)
            out += [(key, GONE, key, idx, start + int(a), start + int(e), b"") for a, e in zip(*merge(gone, gone + unit.window), strict=True)]
            for k in sorted(set(range(len(body) - unit.window + 1)) - set(gone.tolist())):
                window = cut(body, k, k + unit.window)
                name = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)
                out.append((name, MIXED, key, idx, start + k, start + k, window))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held: list[tuple] = []
        size = waiting = 0
        for batch in batches:
            for key, idx, text, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                body = symbols(text.as_py())
                kind, s, n, block, first, copies = unpack(blob.as_py(), ASK[2:])
                for role, name, start, windows, f in stretches(kind, s, n, block, first, copies):
                    rows.append((name, role, key, idx, start, f, cut(body, start, start + windows + unit.window - 1)))
                    size += len(rows[-1][6])
                for start, more in zip(s[kind == SPLIT].tolist(), n[kind == SPLIT].tolist(), strict=True):
                    held.append((key, idx, start, cut(body, start, start + more + unit.window)))
                    waiting += len(held[-1][3])
                if waiting > chunk_bytes:
                    yield ship(split(held))
                    held, waiting = [], 0
                if size > 4 * chunk_bytes:
                    yield ship(rows)
                    rows, size = [], 0
        rows += split(held) if held else []
        if rows:
            yield ship(rows)

    return joined.mapInArrow(run, PIECE).repartition(buckets, "block").sortWithinPartitions("block", F.col("role") != SOURCE)


def in_blocks(batches: Iterator[pa.RecordBatch], chunk_bytes: int, work) -> Iterator[tuple[int, int, int, int]]:
    """Streams PIECE rows, and calls ``work(sources, rest)`` with lists of (block, role, key, idx, start, first, piece):
    whole blocks together until they fill a chunk; of a larger block its sources with one chunk of repeats after the
    other, which need nothing but the sources, and all its mixed pieces (a bounded number) at once."""
    now, sources, repeats, mixed = None, [], [], []
    held: tuple[list, list] = ([], [])
    size = fresh = 0
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
            if row[1] == GONE:
                yield row[2:6]
                continue
            if row[0] != now:
                held[0].extend(sources)
                held[1].extend(repeats + mixed)
                if size >= chunk_bytes:
                    yield from work(*held)
                    held, size = ([], []), 0
                now, sources, repeats, mixed, fresh = row[0], [], [], [], 0
            (sources if row[1] == SOURCE else repeats if row[1] == REPEAT else mixed).append(row)
            size += len(row[6])
            fresh += len(row[6]) if row[1] == REPEAT else 0
            if fresh >= chunk_bytes:
                yield from work(sources, repeats)
                repeats, size, fresh = [], size - fresh, 0
    held[0].extend(sources)
    held[1].extend(repeats + mixed)
    if held[0] or held[1]:
        yield from work(*held)


def cut_rows(found: DataFrame, run, buckets: int) -> DataFrame:
    """(bucket, blob) of the ranges (key, idx, start, end) that ``run`` yields over PIECE rows, dealt by document."""

    def ship(rows: list[tuple]) -> pa.RecordBatch:
        return by_document([np.array(c, t) for c, t in zip(zip(*rows, strict=True), CUT, strict=True)], buckets)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in run(batches):
            rows.append(row)
            if len(rows) >= 200_000:
                yield ship(rows)
                rows = []
        if rows:
            yield ship(rows)

    return found.mapInArrow(go, "bucket int, blob binary")


def apply_cuts(texts: DataFrame, cuts: DataFrame, buckets: int, schema: str, row) -> DataFrame:
    """One row for each text: its doc_id and what ``row(text, starts, ends)`` makes of the merged ranges that go."""
    cut = per_document(cuts, CUT, "cut", buckets, whole=True)
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    joined = texts.join(cut.hint("merge"), ["key", "idx"], "left").select("doc_id", "text", "cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row(text.as_py(), *merged(blob.as_py())) for text, blob in zip(batch.column(1), batch.column(2), strict=True)]
            cols = list(zip(*out, strict=True)) or [() for _ in names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(cols, row.types, strict=True))], names=names)

    return joined.mapInArrow(run, schema)


def merged(blob: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs that packed ranges cover."""
    return merge(*unpack(blob, CUT[2:])) if blob else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def merge(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(s, kind="stable")
    s, reach = s[order].astype(np.int64), np.maximum.accumulate(e[order].astype(np.int64))
    at = np.flatnonzero(np.r_[True, s[1:] > reach[:-1]])
    return s[at], reach[np.r_[at[1:] - 1, len(s) - 1]]

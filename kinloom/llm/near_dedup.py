"""MinHash near-duplicate detection with an LSH forest.

Each document is its set of distinct ``words``-word shingles (64-bit hashes). Documents with one set form a class, and
only the class's smallest id goes on. A class has ``TREES`` signatures of ``DEPTH`` minimum hashes; a tree is the order of
the classes by their signature in it, read from the left, so that classes with a long common prefix are neighbours.

A region is what shares a prefix. It begins at ``BASE`` minima, and inside it
 - neighbours in the order are compared, and those that look alike are joined;
 - what lies outside the region's largest group is compared with the whole region, so no pair is left out;
 - a region that would need more than ``WORK`` comparisons for that descends: it is split by the next minimum, and so on,
   so the depth follows the local density.
``Looks alike`` is a test on 256 one-bit minima carried along: up to ``APART`` may differ. A pair of similarity 0.8 differs
in 25.6 on average with a deviation of 4.8, so it fails in fewer than 1 of 10^8 cases; unlike texts that share some
boilerplate do not pass, and so do not drag regions together. A tree at depth d misses a pair of similarity 0.8 with
probability 1 - 0.8^d; all 32 trees miss it in 5 of 10^8 cases at depth 4, and in 0.3 % at depth 8, which only regions
reach whose classes are many and do not resemble each other.

The forest's edges only say which classes to bring together: their components are compared in full. A component is cut
into tiles of about ``TILE`` shingles by the size of the sets; two tiles whose sizes allow a link meet in one task, and
there the exact overlap of all sets is counted from an inverted index, so no link inside a component is missed and no
task holds more than two tiles. Pairs never become rows: a task emits a spanning forest of the links that it confirmed.

Null ids: such rows are linked with nothing, their component is null and they are kept. Null or empty texts have no
shingles and are linked with nothing. Rows that repeat an id are one document: all their links are its links. An empty
table gives no rows; other columns are not touched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import discard
from .blobs import bucket_of, by_bucket, deal
from .common import materialize, partitions, text_bytes, tune
from .hashing import P1, mix, range_hashes, word_hashes

TREES, BASE, DEPTH = 32, 4, 8
APART = 56
WORK = 1 << 24
TILE = 250_000
SALTS = 16
_draw = np.random.Generator(np.random.PCG64(77))
_FACTORS = (_draw.integers(0, 1 << 31, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)
_ADDED = _draw.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles: A-Z lower-cased, words parted by white space; a text of fewer
    words is one shingle; without words none."""
    h = word_hashes(text.lower().split())
    n = len(h)
    if not n:
        return h
    if n < words:
        return range_hashes(h, np.zeros(1, np.int64), np.full(1, n, np.int64))
    out = h[: n - words + 1].copy()
    for k in range(1, words):
        out = mix(out) + h[k : n - words + 1 + k]
    return np.unique(mix(out))


def minima(s: np.ndarray) -> np.ndarray:
    """For each of TREES * DEPTH hash functions the smallest value over the set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 256):
        block = x[at : at + 256, None] * _FACTORS
        block += _ADDED
        np.minimum(out, block.min(axis=0), out=out)
    return out


def bits(least: np.ndarray) -> np.ndarray:
    """One bit of each minimum, packed into four numbers."""
    return np.packbits((least * np.uint32(0x9E3779B1)) >> np.uint32(31), axis=-1).view(np.uint64)


SKETCH = "doc_id bigint, n_shingles bigint, digest binary, signature binary"


def sketch(docs: DataFrame, words: int) -> DataFrame:
    tune(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signs = [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), words)
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signs.append(minima(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signs, pa.binary())], names=["doc_id", "n_shingles", "digest", "signature"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")).mapInArrow(run, SKETCH)


#: A leaf of a tree: a hash of the tree and its first BASE minima, the id, the DEPTH minima, the four words of bits.
_LEAF = [np.uint64, np.int64, *[np.uint32] * DEPTH, *[np.uint64] * 4]


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of bits differ in at most APART places."""
    return np.bitwise_count(a ^ b).sum(axis=-1) <= APART


class Groups:
    """Union-find over a region's rows."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def join(self, x: int, y: int) -> bool:
        p, q = self.find(x), self.find(y)
        self.root[max(p, q)] = min(p, q)
        return p != q

    def labels(self) -> np.ndarray:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return up
            self.root = up


def region_links(least: np.ndarray, marks: np.ndarray, depth: int, work: int = WORK) -> list[tuple[int, int]]:
    """Edges (places) that join, inside rows sorted by their minima that share the first ``depth``, all that look alike."""
    n = len(least)
    groups, out = Groups(n), []
    near = np.flatnonzero(alike(marks[1:], marks[:-1]))
    for k in near.tolist():
        if groups.join(k, k + 1):
            out.append((k, k + 1))
    label = groups.labels()
    outside = np.flatnonzero(label != np.bincount(label).argmax())
    if not len(outside):
        return out
    if n * len(outside) > work and depth < least.shape[1]:  # descend: the same inside each smaller region
        cuts = np.r_[0, np.flatnonzero(least[1:, depth] != least[:-1, depth]) + 1, n]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            if e - s > 1:
                out += [(s + x, s + y) for x, y in region_links(least[s:e], marks[s:e], depth + 1, work)]
        return out
    for x in outside.tolist():
        for y in np.flatnonzero(alike(marks, marks[x])).tolist():
            if x != y and groups.join(x, y):
                out.append((x, y))
    return out


def forest_edges(representatives: DataFrame, buckets: int, limit: int = 1_000_000) -> DataFrame:
    """(id_a, id_b): classes that look alike and share a region of some tree. ``representatives`` has doc_id and
    signature."""
    tree = np.arange(TREES, dtype=np.uint64) * P1

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                least = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, TREES * DEPTH)
                marks = np.repeat(bits(least), TREES, axis=0)
                ids = np.repeat(batch.column(0).to_numpy(), TREES)
                least = least.reshape(-1, DEPTH)
                base = np.tile(tree, batch.num_rows)
                for k in range(BASE):
                    base = mix(base + least[:, k].astype(np.uint64))
                yield deal(bucket_of(base, buckets), [base, ids, *least.T, *marks.T])

    def shared(cols: list[np.ndarray]) -> list[np.ndarray]:
        """The leaves in their trees' orders, without those that share their region with nothing."""
        order = np.argsort(cols[0])
        base = cols[0][order]
        same = base[1:] == base[:-1]
        order = order[np.r_[False, same] | np.r_[same, False]]
        cols = [c[order] for c in cols]
        order = np.lexsort((cols[1], *cols[2 : 2 + DEPTH][::-1], cols[0]))
        return [c[order] for c in cols]

    def finish(cols: list[np.ndarray], _) -> Iterator[pa.RecordBatch]:
        cols = shared(cols)
        base, ids, least, marks = cols[0], cols[1], np.stack(cols[2 : 2 + DEPTH], axis=1), np.stack(cols[2 + DEPTH :], axis=1)
        cuts = np.r_[0, np.flatnonzero(base[1:] != base[:-1]) + 1, len(base)]
        found: set[tuple[int, int]] = set()
        pairs = np.flatnonzero(np.diff(cuts) == 2)  # regions of two need no groups
        s = cuts[pairs]
        s = s[alike(marks[s], marks[s + 1])] if len(s) else s
        found.update(zip(ids[s].tolist(), ids[s + 1].tolist(), strict=True))
        for k in np.flatnonzero(np.diff(cuts) > 2).tolist():
            a, b = cuts[k], cuts[k + 1]
            found.update((int(ids[a + x]), int(ids[a + y])) for x, y in region_links(least[a:b], marks[a:b], BASE))
        rows = [x for x in found if x[0] != x[1]]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], pa.int64()) for k in (0, 1)], names=["id_a", "id_b"])

    dealt = representatives.select("doc_id", "signature").mapInArrow(plant, "bucket int, blob binary")
    dealt = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda it: by_bucket(it, _LEAF, limit, lambda cols: (cols, None), finish), "id_a bigint, id_b bigint").distinct()


def confirm(nodes: list[int], sets: list[np.ndarray], per_cent: int, split: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest (node, root) of the links among the sets. With ``split`` (a tile for each set, two tiles) the
    same links count; tiles only bound what is held at once."""
    m = len(sets)
    root = list(range(m))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in sets], np.int64)
    if m == 2:
        if int(sizes.min()) * 100 >= per_cent * int(sizes.max()):
            both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
            if 100 * both >= per_cent * (int(sizes.sum()) - both):
                root[1] = 0
    else:
        owner = np.repeat(np.arange(m), sizes)
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")  # equal tokens stand together, by their set's number
        st, so = tokens[order], owner[order]
        first = np.r_[True, st[1:] != st[:-1]]
        start = np.maximum.accumulate(np.where(first, np.arange(len(st)), 0))
        rank = np.empty(len(st), np.int64)
        rank[order] = np.arange(len(st))
        begin = start[rank]  # of each token of each set: where its postings begin; they end before the set's own place
        at = 0
        for x in range(m):
            b, e = begin[at : at + sizes[x]], rank[at : at + sizes[x]]
            at += sizes[x]
            n = e - b
            if not (some := n > 0).any():
                continue
            b, n = b[some], n[some]
            places = np.repeat(b - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            overlap = np.bincount(so[places], minlength=x)[:x]
            for y in np.flatnonzero((overlap > 0) & (100 * overlap >= per_cent * (sizes[x] + sizes[:x] - overlap))):
                p, q = find(x), find(int(y))
                if p != q:
                    root[max(p, q)] = min(p, q)
    return [(nodes[x], nodes[find(x)]) for x in range(m) if find(x) != x]


def confirmed_links(docs: DataFrame, groups: DataFrame, words: int, per_cent: int, tile: int = TILE) -> DataFrame:
    """(id_a, id_b): confirmed links that join all linked documents of each group. ``groups``: doc_id, component,
    n_shingles. Sets of sizes m < n can only be linked if 100 m >= per_cent n, so a tile holds sets of one size class (a
    power of 100 / per_cent) and meets tiles of its own and the next class."""
    spark = docs.sparkSession
    size = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100.0 / per_cent))).cast("int")
    classed = groups.select("doc_id", "component", "n_shingles", size.alias("size"))
    totals = classed.groupBy("component").agg(F.sum("n_shingles").alias("all"))
    sizes = classed.groupBy("component", "size").agg(F.ceil(F.sum("n_shingles") / tile).cast("int").alias("tiles"))
    above = sizes.select("component", (F.col("size") - 1).alias("size"), F.col("tiles").alias("more"))
    plan = sizes.join(totals, "component").join(above, ["component", "size"], "left").withColumn("more", F.coalesce("more", F.lit(0)))
    small = F.col("all") <= tile
    below = sizes.select("component", (F.col("size") + 1).alias("size"), F.col("tiles").alias("less"))
    plan = plan.join(below, ["component", "size"], "left").withColumn("less", F.coalesce("less", F.lit(0)))
    own = F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int")
    spot = lambda z1, t1, z2, t2: F.struct(z1.alias("z1"), t1.alias("t1"), z2.alias("z2"), t2.alias("t2"))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    z, t, zero = F.col("size"), F.col("tile"), F.lit(0)
    meet = F.when(F.col("small"), F.array(spot(zero, zero, zero, zero))).otherwise(F.concat(
        F.transform(upto(F.col("tiles")), lambda j: spot(z, F.least(t, j), z, F.greatest(t, j))),
        F.transform(upto(F.col("more")), lambda j: spot(z, t, z + 1, j)), F.transform(upto(F.col("less")), lambda j: spot(z - 1, j, z, t)),
    ))
    plan = plan.withColumn("small", small).drop("all")
    placed = classed.select("doc_id", "component", "size").distinct().join(plan, ["component", "size"]).withColumn("tile", own).select("doc_id", "component", meet.alias("meet"))
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    joined = texts.join(placed.hint("merge"), "doc_id").select("doc_id", "component", "meet", "text")

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(x.as_py(), words).tobytes() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], names=["doc_id", "component", "meet", "shingles"])

    sets = joined.mapInArrow(to_sets, joined.select("doc_id", "component", "meet").schema.add("shingles", "binary"))
    met = sets.select("component", F.explode("meet").alias("m"), "doc_id", "shingles").select("component", "m.*", "doc_id", "shingles")
    task = ["component", "z1", "t1", "z2", "t2"]
    met = met.repartition(partitions(spark), *task).sortWithinPartitions(*task)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, held = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1 and (links := confirm(nodes, held, per_cent)):
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["id_a", "id_b"])

        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True)
            for key, doc_id, blob in zip(keys, batch.column(5).to_pylist(), batch.column(6), strict=True):
                if key != now:
                    yield from close()
                    now, nodes, held = key, [], []
                s = np.frombuffer(blob.as_py(), np.uint64)
                if len(s):
                    nodes.append(doc_id)
                    held.append(s)
        yield from close()

    return met.mapInArrow(run, "id_a bigint, id_b bigint")


def link(docs: DataFrame, words: int = 5, per_cent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    spark = docs.sparkSession
    sketches = materialize(sketch(docs, words), "sketches")
    rows = materialize(sketches.select("doc_id", "n_shingles", "digest"), "digests")
    named = rows.filter("doc_id is not null")
    full = named.filter("digest is not null")
    groups = full.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    # One row of each class goes into the forest, whichever it is of those with the smallest id.
    firsts = sketches.filter("doc_id is not null and digest is not null").groupBy("digest").agg(F.min_by(F.struct("signature", "n_shingles"), "doc_id").alias("x"), F.min("doc_id").alias("doc_id"))
    reps = materialize(firsts.select("doc_id", "x.n_shingles", "x.signature"), "classes")
    discard(sketches)  # most of their bytes are signatures, which only the classes still need
    near = connected_components(forest_edges(reps, max(partitions(spark), -(-reps.count() * TREES // 500_000))))
    found = materialize(near.withColumnRenamed("id", "doc_id").join(reps.select("doc_id", "n_shingles"), "doc_id"), "groups")
    discard(reps)
    links = confirmed_links(docs, found, words, per_cent)
    again = named.groupBy("doc_id").count().filter(F.col("count") > 1).select("doc_id")
    repeated = named.join(again, "doc_id", "left_semi").join(groups, "digest", "left").select("doc_id", F.coalesce("rep", "doc_id").alias("rep")).distinct()
    same_id = repeated.join(repeated.groupBy("doc_id").agg(F.min("rep").alias("lo")), "doc_id").select(F.col("rep").alias("id_a"), F.col("lo").alias("id_b"))
    parts = connected_components(links.unionByName(same_id)).select(F.col("id").alias("rep"), "component")
    # A class's members may be a third of all rows: its row is laid out SALTS times and members take one each.
    answers = groups.join(parts, "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    members = full.select("doc_id", "n_shingles", "digest", salt.alias("salt")).join(answers.hint("merge"), ["digest", "salt"]).select("doc_id", "n_shingles", "component_id")
    empty = named.filter("digest is null").join(parts, F.col("doc_id") == F.col("rep"), "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    found = members.unionByName(empty).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    nameless = rows.filter("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return found.unionByName(nameless)


def near_dedup(docs: DataFrame, words: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document has the smallest id of its group."""
    gone = link(docs, words, per_cent).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)

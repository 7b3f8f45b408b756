"""Suffix arrays, substring dedup, near-duplicates and the pipeline against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from kinloom.llm import anchors, fingerprint_index, near_dedup, suffix_dedup

from .brute import contaminated

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def corpus(n: int, seed: int) -> list[tuple]:
    """Texts that share passages, with exact and near copies, nulls, runs of one letter and repeated rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    passages = [" ".join(rng.choice(words) for _ in range(70)) for _ in range(4)]
    rows = []
    for k in range(n):
        body = [rng.choice(words) for _ in range(rng.randint(0, 160))]
        if rng.random() < 0.4:
            body.insert(rng.randrange(len(body) + 1), rng.choice(passages))
        text = rng.choice([" ", "\n"]).join(body)
        if rows and rng.random() < 0.2:
            text = rng.choice(rows)[1] or ""
            if text and rng.random() < 0.6:
                at = rng.randrange(len(text))
                text = text[:at] + " changed " + text[at:]
        rows.append((k * 2, text, "xx", f"s{k % 3}", len(text)))
    rows += [(9001, None, None, None, None), (9002, "a" * 700, "xx", "s1", 700), (9003, "a" * 150, "xx", "s1", 150), (9004, "", None, None, 0)]
    return rows


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(120):
        text = bytes(rng.randrange(97, 97 + rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 300))) * rng.choice([1, 1, 3])
        sa = suffix_dedup.suffix_array(text)
        keys = [text[i : i + suffix_dedup.DEPTH] for i in sa]
        assert sorted(sa.tolist()) == list(range(len(text))) and keys == sorted(keys)
        wanted = np.array([rng.random() < 0.3 for _ in text])
        part = suffix_dedup.suffix_array(text, wanted)
        assert set(np.flatnonzero(wanted)) <= set(part.tolist()) and [text[i : i + suffix_dedup.DEPTH] for i in part] == sorted(text[i : i + suffix_dedup.DEPTH] for i in part)
        lcp = suffix_dedup.common_prefixes(text, sa)
        for a, b, n in zip(keys, keys[1:], lcp[1:], strict=False):
            m = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert n == m


def brute(rows, window, within):
    """Ranges of symbols under windows that start earlier."""
    seen, out = {}, {}
    for k, s in rows:
        got = []
        for i in range(len(s) - window + 1):
            w = s[i : i + window] if isinstance(s, bytes) else tuple(s[i : i + window])
            first = seen.setdefault(w, (k, i))
            if first != (k, i) if within else first[0] != k:
                if got and i <= got[-1][1]:
                    got[-1][1] = i + window
                else:
                    got.append([i, i + window])
        out[k] = got
    return out


def cut(s, ranges):
    out, at = s[:0], 0
    for a, b in ranges:
        out, at = out + s[at:a], b
    return out + s[at:]


def test_suffix_dedup(spark):
    rows = corpus(150, 11)
    got = {r.doc_id: r for r in suffix_dedup.digest(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}
    texts = sorted((k, (t or "").encode()) for k, t, *_ in rows)
    want = brute(texts, 100, True)
    assert any(want.values())
    for k, s in texts:
        kept = cut(s, want[k])
        assert (got[k].n_bytes, got[k].n_removed, got[k].n_spans, got[k].kept_sha256) == (len(s), len(s) - len(kept), len(want[k]), hashlib.sha256(kept).hexdigest())


def test_suffix_dedup_keeps_rows_and_characters(spark):
    rng = random.Random(21)
    base = "".join(rng.choice("éèüßñx") for _ in range(120))
    rows = [(1, base, "a", None, 0), (1, base, "a", None, 0), (None, "b" + base, None, "s", 1), (2, None, None, None, None), (3, "z" + base, None, None, 3)]
    out = suffix_dedup.dedup(spark.createDataFrame(rows, DOCS))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = sorted(((r.doc_id is not None, r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    assert sorted(str(r[2]) for r in got) == sorted(["b" + base, "", "", "None", "z"])
    assert suffix_dedup.dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_substring_dedup(spark):
    rows = corpus(150, 12)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = {r.doc_id: r for r in fingerprint_index.digest(df).collect()}
    texts = sorted((k, (t or "").encode().split()) for k, t, *_ in rows)
    want = brute(texts, 50, False)
    assert any(want.values())
    for k, s in texts:
        kept = cut(s, want[k])
        assert (got[k].n_words, got[k].n_removed, got[k].kept_sha256) == (len(s), len(s) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())


def ranges_of(index, asks, texts):
    cuts = anchors.cut_rows(anchors.pieces(asks, texts, fingerprint_index.UNIT, index.buckets, fingerprint_index.again), fingerprint_index.verify, index.buckets)
    rows = anchors.per_document(cuts, anchors.CUT, "cut", index.buckets, whole=True).collect()
    return {r.key: [list(x) for x in zip(*(y.tolist() for y in anchors.merged(bytes(r.cut))), strict=True)] for r in rows}


def test_index_is_reopened_and_compacts(spark, tmp_path):
    """Three sessions of one index: every one opens the folder anew, adds a batch and finds what one pass finds."""
    rows = corpus(90, 13)
    texts = anchors.prepare(spark.createDataFrame(rows, DOCS))
    folder, asks = f"file://{tmp_path}/index", None
    for k, batch in enumerate(fingerprint_index.batches(texts, 3)):
        index = fingerprint_index.FingerprintIndex(spark, folder, 4, 2, fanout=2) if not k else fingerprint_index.FingerprintIndex.open(spark, folder)
        got = index.add(batch)
        asks = got if asks is None else asks.unionByName(got)
    again = fingerprint_index.FingerprintIndex.open(spark, folder)
    assert [len(level) for level in again.levels] == [1, 1] and again.levels == index.levels
    want = brute(sorted((k, (t or "").encode().split()) for k, t, *_ in rows), 50, False)
    assert ranges_of(index, asks, texts) == {k: v for k, v in want.items() if v}
    plan = index._met(again.levels[0][0], again.levels[1][0])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_query_compacts(spark, monkeypatch):
    seen = []
    compact = fingerprint_index.FingerprintIndex._compact
    monkeypatch.setattr(fingerprint_index.FingerprintIndex, "_compact", lambda self: (compact(self), seen.append([len(x) for x in self.levels]))[0])
    fingerprint_index.cuts(anchors.prepare(spark.createDataFrame(corpus(60, 13), DOCS)), 4)
    assert seen[-1] == [1, 1]


def test_removal_needs_the_array(spark, monkeypatch):
    """Without common prefixes from the array nothing goes."""
    rows = [(k, "same words again and again " * 20, None, None, None) for k in range(4)]
    work = lambda: anchors.in_blocks(iter([batch]), 1 << 20, lambda *_: iter(()))
    df = spark.createDataFrame(rows, DOCS)
    texts = anchors.prepare(df)
    found = anchors.pieces(anchors.read_buckets(anchors.extract(texts, suffix_dedup.UNIT, 4), suffix_dedup.UNIT, 4), texts, suffix_dedup.UNIT, 4, suffix_dedup.again)
    batch = pa.Table.from_batches(found.toArrow().to_batches()).combine_chunks().to_batches()[0]
    assert list(suffix_dedup.compare(iter([batch]))) and not list(work())
    monkeypatch.setattr(suffix_dedup, "common_prefixes", lambda text, sa, depth=0: np.zeros(len(sa), np.int64))
    assert not list(suffix_dedup.compare(iter([batch])))


def test_hot_grams_are_split(spark, monkeypatch):
    """A gram in many neighbourhoods, a passage in many documents, and null and repeated ids."""
    rng = random.Random(3)
    gram = "the one and only gram that stands in every text of this corpus "
    tail = [" ".join(f"w{rng.randrange(40)}" for _ in range(60)) for _ in range(12)]
    rows = [(None if k % 9 == 0 else k // 2, rng.choice(tail)[-rng.randrange(20, 90) :] + gram + rng.choice(tail), None, None, None) for k in range(160)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    plain = sorted(map(tuple, suffix_dedup.digest(df).collect()), key=str)
    other = sorted(map(tuple, fingerprint_index.digest(df).collect()), key=str)
    monkeypatch.setattr(anchors, "MIXED_MOST", 3)
    monkeypatch.setattr(anchors, "HELD", 50)
    monkeypatch.setattr(anchors, "blocks_of", lambda m: np.minimum(m, 3).astype(np.uint64))
    assert sorted(map(tuple, suffix_dedup.digest(df).collect()), key=str) == plain
    assert sorted(map(tuple, fingerprint_index.digest(df).collect()), key=str) == other
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][1]))
    want = brute([(i, rows[i][1].encode()) for i in order], 100, True)
    assert sorted(str((rows[i][0], sum(b - a for a, b in want[i]))) for i in order) == sorted(str((r[0], r[2])) for r in plain)
    want = brute([(i, rows[i][1].encode().split()) for i in order], 50, False)
    assert sorted(str((rows[i][0], sum(b - a for a, b in want[i]))) for i in order) == sorted(str((r[0], r[2])) for r in other)


@pytest.mark.parametrize("op", [suffix_dedup.digest, fingerprint_index.digest, near_dedup.link])
def test_empty_tables(spark, op):
    assert op(spark.createDataFrame([], DOCS)).count() == 0
    assert op(spark.createDataFrame([(1, None, None, None, None)], DOCS)).count() == 1


def test_forest_finds_links_in_dense_regions():
    """Sets that share most of their minima with hundreds of others, and pairs of similarity just above 0.8 among them."""
    rng = np.random.default_rng(5)
    draw = lambda n: rng.integers(0, 1 << 64, n, dtype=np.uint64)
    core = draw(60)
    sets, pairs = [], []
    for _ in range(400):
        own = draw(60)
        sets.append(np.unique(np.r_[core, own]))
        pairs.append((len(sets) - 1, len(sets)))
        sets.append(np.unique(np.r_[core, own[:47], draw(13)]))  # 107 of 133
    least = np.stack([near_dedup.minima(s) for s in sets])
    marks = near_dedup.bits(least)
    for work in (near_dedup.WORK, 2_000):
        met = set()
        for t in range(near_dedup.TREES):
            sub = least[:, t * near_dedup.DEPTH : (t + 1) * near_dedup.DEPTH]
            order = np.lexsort(sub.T[::-1])
            cuts = np.r_[0, np.flatnonzero((sub[order][1:, : near_dedup.BASE] != sub[order][:-1, : near_dedup.BASE]).any(axis=1)) + 1, len(order)]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if e - s > 1:
                    at = order[s:e]
                    met.update((min(at[x], at[y]), max(at[x], at[y])) for x, y in near_dedup.region_links(sub[at], marks[at], near_dedup.BASE, work))
        groups = near_dedup.Groups(len(sets))
        for x, y in met:
            groups.join(int(x), int(y))
        assert sum(groups.find(x) == groups.find(y) for x, y in pairs) >= 0.99 * len(pairs)


def components(rows, words):
    sets = {}
    for k, t in rows:
        w = (t or "").encode().lower().split()
        sets[k] = frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else (frozenset([tuple(w)]) if w else frozenset())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {k: find(k) for k in sets}, sets


@pytest.mark.parametrize("tile", [near_dedup.TILE, 300])
def test_near_dedup(spark, tile, monkeypatch):
    monkeypatch.setattr(near_dedup.confirmed_links, "__defaults__", (tile,))
    rows = corpus(120, 14)
    want, sets = components([r[:2] for r in rows], 4)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = {r.doc_id: r for r in near_dedup.link(df, 4).collect()}
    assert len(set(want.values())) < len(want)
    assert {k: r.component_id for k, r in got.items()} == want
    assert all(got[k].n_shingles == len(sets[k]) and got[k].kept == (want[k] == k) for k in want)


def test_near_dedup_edge_cases(spark):
    rows = [(None, "a b c d e f", None, None, None), (None, "a b c d e f", None, None, None), (5, "a b c d e f", None, None, None), (7, "A B  c d e f", None, None, None), (7, "q r s t u v", None, None, None), (9, "q r s t u v", None, None, None), (11, None, None, None, None)]
    got = near_dedup.link(spark.createDataFrame(rows, DOCS), 4).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(None, None, True), (5, 5, True), (7, 5, False), (9, 5, False), (11, 11, True)}
    assert near_dedup.near_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_pipeline(spark, tmp_path):
    rows = corpus(70, 15)
    items = [(1, " ".join((rows[3][1] or "x").split()[:12])), (2, "nothing of this stands anywhere in these texts at all here")]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(0, 1, 0), (2, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    left = {k: t for k, t, *_ in rows if t and any(ch.isalpha() for ch in t)}
    known = {r.doc_id for r in corpus_pipeline.language(spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert known == set(left)
    comp, _ = components(list(left.items()), 5)
    left = {k: t for k, t in left.items() if comp[k] == k}
    texts = sorted((k, t.encode()) for k, t in left.items())
    gone = brute(texts, 100, True)
    plain = {k: suffix_dedup.kept_text(s, *(__import__("numpy").array([r[i] for r in gone[k]], dtype=int) for i in (0, 1))) for k, s in texts}
    bad = {r[0] for r in contaminated(list(plain.items()), items) if r[-1]}
    assert bad and set(got) == set(plain) - bad
    assert all(got[k].size == len(plain[k].split()) and 0 <= got[k].taken <= 3 * got[k].size for k in got)

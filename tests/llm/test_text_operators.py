"""WARC, decontamination, URL rules, language ID, fingerprints and license scans against brute force and edge cases."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from kinloom.llm import decontaminate, language_id, licenses, order_minhash, url_filter, warc

from . import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, hits string"
TEXTS = [(1, "the cat sat on the mat and ate the big red apple pie today", "en", None, None, 1, "x"), (2, None, None, None, None, None, None), (3, "", "en", "a", 0, 0, ""), (4, "x" * 300_000, "en", "a", 1, 1, ""), (4, "x" * 300_000, "en", "a", 1, 1, ""), (None, "Ö 1 ö", None, None, None, None, None)]


def test_warc_round_trip(spark):
    same = "<p>" + "a" * 200 + "</p>"
    rows = [(3, "http://a/\n", same), (1, None, same), (2, "http://b", "short"), (4, "u", "short"), (5, "u", None), (6, "u", "é" * 60_000), (None, "u", "q" * 500)]
    stored = warc.archive(spark.createDataFrame(rows, "page_id bigint, url string, html string"), frame_bytes=400, bundle_bytes=200)
    got = {r.page_id: r for r in warc.read_bundles(stored).collect()}
    assert len(got) == len(rows)
    assert (got[3].record_type, got[3].refers_to, got[1].record_type) == ("revisit", 1, "response")
    assert got[2].record_type == got[4].record_type == "response" and got[5].payload_bytes == 0
    for page_id, _, html in rows:
        body = (html or "").encode()
        assert (got[page_id].payload_bytes, got[page_id].payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
    raw = warc.fetch(stored, 6).collect()
    assert len(raw) == 1 and raw[0].record.count("é".encode()) == 60_000
    assert warc.read_bundles(warc.archive(spark.createDataFrame([], "page_id bigint, url string, html string"))).count() == 0


def test_seek_table():
    bundle = warc.seal([(b"abc", 10), (b"defg", 20)])
    assert warc.seek_table(bundle) == [(0, 3, 10), (3, 4, 20)]


def test_decontaminate_matches_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "b", "c", "dé"])
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([1, 2, 3, 5, 9, 10, 11, 14, 0])] + [(20, None), (3, "zz yy")]
    docs = [(k, " ".join(word() for _ in range(rng.randrange(60)))) for k in range(60)] + [(100, None), (101, "A  b,C " + items[7][1].upper().replace("DÉ", "dé") + " q")]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(brute.contaminated(docs, items))
    for block in (1 << 20, 10):  # one block, and one item a block
        got = sorted(map(tuple, decontaminate.digest(decontaminate.scan(d, b, block_bytes=block)).collect()))
        assert got == want
    rows = spark.createDataFrame(TEXTS, DOCS)
    item = b.filter("item_id = 7")
    clean = decontaminate.decontaminate(rows, item)
    assert clean.schema == rows.schema and sorted(clean.collect(), key=str) == sorted(rows.collect(), key=str)
    found = decontaminate.scan(rows.withColumnRenamed("source", "leaks"), item)
    assert found.columns == ["doc_id", "text", "lang", "leaks", "n_chars", "n_words", "hits", "leaks_"]
    assert decontaminate.scan(d.limit(0), b.limit(0)).count() == 0


def test_url_rules(spark):
    urls = ["http://x.EXAMPLE.org/es/1", "https://example.org/en/1?x", "https://a.b.com/de/", "http://notcom/fr/", "https://q.com", None, "no scheme", "a://b://c/d", "http://org/x"]
    df = url_filter.judge(spark.createDataFrame([(k, u, 1) for k, u in enumerate(urls)], "page_id bigint, url string, rule int"))
    got = {r.page_id: r for r in df.collect()}
    assert [got[k].rule for k in range(9)] == ["example.org/es/", "example.org/en/1", "com/de/", None, None, None, None, None, "org/"]
    assert [got[k].verdict for k in (0, 1, 2, 8)] == ["block", "block", "block", "allow"]
    assert (got[7].host, got[7].path, got[6].host, got[5].path) == ("b:", "//c/d", "", "")
    assert url_filter.judge(df.select("page_id").limit(0).selectExpr("page_id", "cast(null as string) url")).count() == 0


def test_trees_learn():
    rng = random.Random(1)
    rows = [([x := rng.random(), rng.random()], int(x > 0.6)) for _ in range(600)]
    model = url_filter.fit([(x + [0.0], y) for x, y in rows], n_trees=20)

    def score(t, x):
        return t.value if t.low is None else score(t.low if x[t.feature] <= t.cut else t.high, x)

    right = sum((model.base + sum(score(t, x + [0.0]) for t in model.trees) > 0) == (y == 1) for x, y in rows)
    assert right / len(rows) > 0.95


def test_language_mixture(spark):
    rng = random.Random(4)
    bags = {"aa": ["lorem", "ipsum", "dolor", "amet"], "bb": ["zwick", "krumm", "pfahl", "schnur"], "cc": ["ñandu", "año", "cigüe", "quizá"]}
    text = lambda lang, n: " ".join(rng.choice(bags[lang]) for _ in range(n))
    rows = [(k, text(lang := sorted(bags)[k % 3], 20 + k % 30), lang) for k in range(240)]
    rows += [(1000, text("aa", 60) + " " + text("bb", 30), None), (1001, None, "aa"), (1002, "123 !!", "aa"), (1003, "", None), (None, text("cc", 9), "cc")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(df).collect()}
    held = [(got[i].lang_pred, lang) for i, _, lang in rows[:240] if got[i].held_out]
    assert len(held) > 30 and all(a == b for a, b in held)
    assert sorted(got[1000].langs) == ["aa", "bb"] and got[1000].lang_pred == "aa" and abs(got[1000].score - 0.66) < 0.12
    assert [got[k].lang_pred for k in (1001, 1002, 1003)] == ["und"] * 3 and got[None].lang_pred == "cc" and not got[None].held_out
    assert language_id.identify(df.filter("lang is null")).filter("lang_pred <> 'und'").count() == 0


def test_every_language_is_learned(spark):
    """70 languages of their own words, the rarest ones with half as many rows."""
    rng = random.Random(8)
    bags = {f"l{k:02}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(5)] for k in range(70)}
    rows = [(n, " ".join(rng.choices(bags[lang], k=30)), lang) for n, lang in enumerate(x for k, x in enumerate(bags) for _ in range(4 if k < 60 else 2))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.train(df)
    assert model.languages == sorted(bags)
    assert all(r.language.lang_pred == r.lang and r.language.known for r in language_id.predict(df, model).collect())


def test_mixture_matches_brute_force(spark):
    rng = random.Random(9)
    bags = {k: ["".join(rng.choice(k + "eo") for _ in range(5)) for _ in range(12)] for k in ("abc", "cdf", "fgh", "hkl")}
    text = lambda k, n: " ".join(rng.choices(bags[k], k=n))
    df = spark.createDataFrame([(k, text(lang, 30), lang) for k, lang in enumerate(sorted(bags) * 8)], "doc_id bigint, text string, lang string")
    model = language_id.train(df)
    for _ in range(12):
        sample = " ".join(text(rng.choice(sorted(bags)), rng.randint(1, 25)) for _ in range(rng.randint(1, 4))).encode()
        got, want = model.mixture(sample)[0], brute.mixture(model, sample)
        assert [x for x, _ in got] == [x for x, _ in want] and np.allclose([x for _, x in got], [x for _, x in want], atol=1e-6)


def test_language_keeps_columns(spark):
    rows = spark.createDataFrame([(1, "abc abd", "xx", 0.25, True, "a"), (1, "abc abd", "xx", 0.25, True, "a"), (None, "abc " * 60_000, None, None, None, "b"), (3, None, "xx", 1.0, False, None)], "doc_id bigint, text string, lang string, score double, known boolean, language string")
    model = language_id.train(rows.select("doc_id", "text", "lang"))
    out = language_id.known(rows, model)
    assert out.schema == rows.schema and sorted(out.collect(), key=str) == sorted(rows.filter("text is not null").collect(), key=str)
    found = language_id.predict(rows, model)
    assert found.columns[-1] == "language_" and language_id.predict(rows.limit(0), model).count() == 0


def test_order_minhash(spark):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcd é") for _ in range(n))
    a, b = text(400).encode(), text(400).encode()
    factors, offsets = order_minhash._FACTORS.tolist(), order_minhash._OFFSETS.tolist()
    printed = lambda t: order_minhash.fingerprint(t).astype(">u4").tobytes().hex()
    for t in (a, b, a[:300] + b[300:], b"ab" * 90, b"a", b"", b"abcdefgh", "é".encode() * 50):
        assert printed(t) == brute.order_minhash(t, factors, offsets)
    swapped = a[200:] + a[:200]
    assert order_minhash.likeness(order_minhash.fingerprint(a), order_minhash.fingerprint(swapped)) < 0.9
    docs = [(k * 3, text(rng.randrange(300))) for k in range(50)] + [(500, None), (501, "ab"), (502, "ab")]
    got = {r.doc_id: r for r in order_minhash.compare_with_next(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)).collect()}
    for k, (i, t) in enumerate(docs):
        t, following = t or "", docs[(k + 1) % len(docs)][1] or ""
        edited = (t[: len(t) - len(t) // 2] + following[: len(t) // 2]).encode()
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited).hexdigest())
        assert got[i].near_next == order_minhash.likeness(order_minhash.fingerprint(t.encode()), order_minhash.fingerprint(following.encode()))
    assert got[501].fingerprint == got[502].fingerprint and got[501].near_next == 1.0
    one = order_minhash.compare_with_next(spark.createDataFrame([(7, "abc")], "doc_id bigint, text string")).collect()
    assert one[0].near_next == 1.0
    assert order_minhash.compare_with_next(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_order_minhash_is_alike_at_every_size():
    """Texts on both sides of 2^16 and 2^17 k-mers, one byte apart."""
    rng = np.random.default_rng(1)
    for size in (1 << 16, 1 << 17):
        body = rng.integers(97, 123, size + 20, dtype=np.uint8).tobytes()
        prints = [order_minhash.fingerprint(body[: size + 7 + d]) for d in (-1, 0, 1, 2)]
        assert all(order_minhash.likeness(p, q) >= 0.9 for p in prints for q in prints)


def test_order_minhash_null_ids(spark):
    rows = [(None, "second text here"), (None, None), (4, "x" * 70_000), (9, "third")]
    got = sorted(((r.doc_id, r.n_chars, r.near_next) for r in order_minhash.compare_with_next(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str)
    assert [x[:2] for x in got] == [(4, 70_000), (9, 5), (None, 0), (None, 16)]


def test_licenses(spark):
    rng = random.Random(6)
    vocabulary = sorted({w for _, t, *_ in licenses.TEMPLATES for w in decontaminate.words_of(t.encode())}) + [b"cc", b"by", b"all", b"rights", b"reserved", b"general", b"public"]
    docs = [(k, b" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(120))).decode()) for k in range(150)]
    docs += [(900 + k, "Intro words. " + t + " And more text of another kind follows here.") for k, (_, t, *_) in enumerate(licenses.TEMPLATES)] + [(990, "ALL rights, reserved all rights reserved"), (991, None)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    for i, text in docs:
        w = decontaminate.words_of((text or "").encode())
        places = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.encode().split()]
        labels, best = {label for _, label in places}, 0.0
        for label, t, needs, bars in licenses.TEMPLATES:
            listed = decontaminate.words_of(t.encode())
            step, want = len(listed), set(listed)
            for s in range(0, max(0, -(-(len(w) - 2 * step) // step)) * step + 1, step):
                block = set(w[s : s + 2 * step])
                share = len(want & block) / len(want)
                if len(want & block) >= math.ceil(0.8 * len(want) - 1e-9) and set(needs.encode().split()) <= block and not set(bars.encode().split()) & block:
                    labels.add(label)
                    best = max(best, share)
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == (min((p for p, _ in places), default=None), max((p for p, _ in places), default=None))
        assert r.labels == ",".join(sorted(labels)) and r.score == (1.0 if places else best)
    assert all(licenses.TEMPLATES[k][0] in got[900 + k].labels for k in range(len(licenses.TEMPLATES)))


def test_license_precision(spark):
    """Sentences that differ from a notice in the word that matters get no false label, true ones their own."""
    cases = [
        ("Licensed under CC BY 4.0", "cc-by"), ("released under the license of the owner", ""), ("licensed under the license version 2 0", ""),
        ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "gpl,lgpl"), ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"), ("Released under the MIT License", "mit"),
        ("Licensed under the Apache License, Version 2.0", "apache-2.0"), ("The cat sat on the mat under the license plate", ""), (None, ""),
    ]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame([(k, t) for k, (t, _) in enumerate(cases)], "doc_id bigint, text string")).collect()}
    assert [got[k] for k in range(len(cases))] == [x for _, x in cases]
    assert licenses.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_trees_on_held_out_urls(spark):
    """Block rates and lexical features find what the rules of one half say of the other; the columns say what the trees say."""
    rng = random.Random(5)
    hosts = [f"{a}.{b}" for a in ("shop", "news", "wiki", "blog") for b in ("net", "info", "edu")]
    bad = lambda h, p: h.endswith("info") or p.startswith("win")
    rows, truth = [], {}
    for k in range(1500):
        h, p = rng.choice(hosts), rng.choice(["win", "about", "a", "docs"]) + f"/{rng.randrange(50)}"
        rows.append((k, f"http://{h}/{p}?x={rng.randrange(9)}"))
        truth[k] = bad(h, p)
    df = url_filter.with_features(spark.createDataFrame(rows, "page_id bigint, url string"), [])
    labelled = df.withColumn("fixed", F.when(F.col("page_id") % 2 == 0, F.when(F.col("host").endswith("info") | F.col("path").startswith("/win"), "block").otherwise("allow")))
    fitted = url_filter.to_fit(labelled, 4096)
    rated = url_filter.with_rates(labelled, fitted)
    model = url_filter.train(rated, fitted)
    got = {r.page_id: (r.m, list(r.f)) for r in rated.select("page_id", model.column().alias("m"), F.array(*url_filter.FEATURES).alias("f")).collect()}
    held = [k for k in got if k % 2]
    assert sum((got[k][0] > 0) == truth[k] for k in held) >= 0.97 * len(held)

    def score(t, x):
        return t.value if t.low is None else score(t.low if x[t.feature] <= t.cut else t.high, x)

    assert all(math.isclose(m, model.base + sum(score(t, x) for t in model.trees), abs_tol=1e-9) for m, x in got.values())


def test_url_filter_edges(spark):
    rows = [(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None), (3, ""), (4, "http://b.com/" + "y" * 50_000), (5, "http://q.net/z")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    assert len(got) == len(rows) and all(r.verdict in ("allow", "block") for r in got)
    assert len({tuple(r) for r in got if r.page_id == 1}) == 1

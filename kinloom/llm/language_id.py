"""Language identification as a mixture: which languages, and in which proportions, wrote a document's n-grams.

Training counts hashed byte trigrams by language over a bounded sample of the labelled rows: about ``per_language``
rows of each language, those with the smallest hash, whatever the size of the table. Every language that occurs is
learned. The model is a table of 2^15 probabilities (128 KB) for each of them, made in blocks of languages from sparse
counts and sent to tasks.

Inference works on the whole text. Expectation-maximisation estimates the proportions under all languages; then sets of
the one, two, three ... strongest languages are compared by log-likelihood less ``penalty`` * size * log(n-grams) / 2,
and the best set's proportions are the answer. A document is ``known`` if some language explains its n-grams better
than the uniform distribution does.

Null text, and text without letters: ``und`` with score 0 and not known; so is everything if no labelled row exists.
Rows without a language, or with an empty text, teach nothing. Equal texts get equal answers; no column but the text
matters to a prediction. An empty table gives no rows. All columns of the input are kept as they are, whatever their
names: the answer goes to one struct column with a name that is free.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, text_bytes, tune

BITS = 15
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def grams(text: bytes) -> np.ndarray:
    """Hashed trigrams of the text's letters, words parted by one space."""
    x = np.frombuffer(b" " + b" ".join(text.translate(_LETTERS).split()) + b" ", np.uint8).astype(np.uint32)
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def has_letters(text: bytes) -> bool:
    if _ASCII_LETTER.search(text):
        return True
    return not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


class Model:
    """``p``: a row for each hashed trigram, a column for each language."""

    def __init__(self, languages: list[str], p: np.ndarray):
        self.languages, self.p = languages, p

    def mixture(self, text: bytes, penalty: float = 3.0, rounds: int = 12) -> tuple[list[tuple[str, float]], bool]:
        """(language, proportion) of the chosen set, largest first, and whether the document is known."""
        if not self.languages or not has_letters(text):
            return [], False
        tally = np.bincount(grams(text), minlength=1 << BITS)
        where = np.flatnonzero(tally)
        c = tally[where].astype(np.float64)
        n = c.sum()
        if not n:
            return [], False
        p = self.p[where].astype(np.float64)

        def em(q: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
            theta = np.full(q.shape[1], 1 / q.shape[1])
            for _ in range(rounds):
                theta = theta * ((c / (q @ theta)) @ q) / n
            return theta, float(c @ np.log(q @ theta))

        alone = c @ np.log(p)
        theta, _ = em(p, rounds)
        order = np.lexsort((-alone, -theta))
        best = int(np.argmax(alone))
        chosen, share, value = [best], np.ones(1), float(alone[best]) - penalty * math.log(n) / 2
        for k in range(2, len(order) + 1):
            if theta[order[k - 1]] * n < 1:
                break
            mix, ll = em(p[:, order[:k]], rounds)
            if (v := ll - penalty * k * math.log(n) / 2) <= value:
                break
            chosen, share, value = list(order[:k]), mix, v
        top = sorted(zip(share, (self.languages[k] for k in chosen), strict=True), key=lambda x: (-x[0], x[1]))
        return [(lang, float(s)) for s, lang in top], float(alone[best]) > n * -BITS * math.log(2)


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(labelled: DataFrame, per_language: int = 2000, block: int = 64) -> Model:
    """Learns every language of ``labelled`` (doc_id, text, lang). The driver holds the counts of ``block`` languages at
    a time."""
    spark = labelled.sparkSession
    tune(spark)
    rows = labelled.filter("lang is not null and text is not null and text <> ''")
    sizes = sorted((r["lang"], r["count"]) for r in rows.groupBy("lang").count().collect())
    languages = [lang for lang, _ in sizes]
    p = np.empty((1 << BITS, len(languages)), np.float32)
    if not languages:
        return Model(languages, p)
    shares = spark.createDataFrame([(lang, k, min(1.0, per_language / n)) for k, (lang, n) in enumerate(sizes)], "lang string, k int, share double")
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0)), F.length("text")), F.lit(1 << 20)) / float(1 << 20)
    picked = rows.join(F.broadcast(shares), "lang").filter(draw < F.col("share")).select("k", text_bytes().alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[int, np.ndarray] = {}
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                got = np.bincount(grams(text), minlength=1 << BITS)
                sums[k] = sums[k] + got if k in sums else got
            for k, got in sums.items():
                where = np.flatnonzero(got)
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(where), pa.int32()), pa.array(where, pa.int32()), pa.array(got[where], pa.int64())], names=["k", "gram", "n"])

    counted = picked.mapInArrow(count, "k int, gram int, n bigint").groupBy("k", "gram").agg(F.sum("n").alias("n"))
    if len(languages) > block:
        counted = materialize(counted, "counted")
    for first in range(0, len(languages), block):
        part = counted.filter(F.col("k").between(first, first + block - 1)).toArrow()
        got = np.full((min(block, len(languages) - first), 1 << BITS), 0.5)
        got[part["k"].to_numpy() - first, part["gram"].to_numpy()] += part["n"].to_numpy()
        p[:, first : first + len(got)] = (got / got.sum(axis=1, keepdims=True)).T
    return Model(languages, p)


FOUND = "struct<lang_pred:string,score:double,known:boolean,langs:array<string>,shares:array<double>>"


def predict(docs: DataFrame, model: Model, penalty: float = 3.0) -> DataFrame:
    """``docs`` and, as the last column, a struct of lang_pred, score (the language's proportion), known, langs and
    shares."""
    spark = docs.sparkSession
    tune(spark)
    start = docs.withColumn(free_name(docs.columns, "language"), F.lit(None).cast(FOUND))
    sent = spark.sparkContext.broadcast((model.languages, model.p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for batch in batches:
            out = []
            for text in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()):
                found, known = m.mixture(text.as_py() or b"", penalty)
                lang, score = found[0] if found else ("und", 0.0)
                out.append({"lang_pred": lang, "score": min(max(score, 0.0), 1.0), "known": known, "langs": [x for x, _ in found], "shares": [x for _, x in found]})
            last = batch.schema.field(batch.num_columns - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, last.type)], schema=batch.schema)

    return start.mapInArrow(run, start.schema)


def known(docs: DataFrame, model: Model, penalty: float = 3.0) -> DataFrame:
    """The rows of ``docs`` whose text some language explains."""
    found = predict(docs, model, penalty)
    return found.filter(F.col(found.columns[-1])["known"]).select(*docs.columns)


def identify(docs: DataFrame, per_language: int = 2000) -> DataFrame:
    """doc_id, held_out, lang_pred, score, known, langs and shares; learned from the rows that are not held out."""
    model = train(docs.filter(~held_out()).select("doc_id", "text", "lang"), per_language)
    found = predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", f"{found.columns[-1]}.*")

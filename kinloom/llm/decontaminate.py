"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of ``window`` consecutive words of a benchmark item (an item of fewer words is one pattern).
Words are the alphabet, known by numbers; a word that no item holds has none. Patterns of one length form a class with
 - a shift table: for every block of ``B`` words in a pattern, how far the scan may advance when that block ends the
   current position; a block that no pattern holds allows a full skip of ``m - B + 1`` words,
 - buckets of patterns by their last block (shift zero), whose words are compared directly with the text.

The item set is a stated query set: it goes out to the tasks in blocks of at most ``block_bytes`` of item text (about 30
bytes of memory for each). One scan of the rows serves one block and what it finds is carried along with the row, so no
shuffle is needed; between two blocks the rows are stored, so a task never holds more than one block's tables.

Null or empty text: no words, no hits. Null item text: no windows. Several items with one id count once. Repeated
documents each get a row; an empty table gives no rows. All columns of the input are kept as they are, whatever their
names: what is found goes to one struct column with a name that is free.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize, text_bytes, tune

_KEEP = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
#: A-Z become a-z; every byte outside the word class becomes a space. UTF-8 bytes above 127 are word bytes, so this is
#: the class ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` on code points.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEEP else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class WuManber:
    """Patterns of one length: places in ``stream``, the items' words as numbers one after the other."""

    def __init__(self, length: int, stream: list[int], places: dict[int, list[int]]):
        self.m, self.stream, self.owners = length, stream, places
        self.B = min(2, length)
        self.skip = length - self.B + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, list[int]] = defaultdict(list)
        for at in places:
            for j in range(self.B, length + 1):
                block = self._block(stream, at + j)
                self.shift[block] = min(self.shift.get(block, self.skip), length - j)
            self.bucket[self._block(stream, at + length)].append(at)

    def _block(self, words: list[int], end: int) -> int:
        return words[end - 1] if self.B == 1 else words[end - 2] << 32 | words[end - 1]

    def search(self, words: list[int]) -> Iterator[tuple[int, list[int]]]:
        """(start, owners of the pattern) of every occurrence in words given by their numbers; unknown ones are 0."""
        m, skip, shift, bucket, stream, n = self.m, self.skip, self.shift.get, self.bucket, self.stream, len(words)
        end, one = m, self.B == 1
        while end <= n:
            block = words[end - 1] if one else words[end - 2] << 32 | words[end - 1]
            s = shift(block, skip)
            if s:
                end += s
                continue
            text = words[end - m : end]
            for at in bucket[block]:
                if stream[at : at + m] == text:
                    yield end - m, self.owners[at]
            end += 1


def compile_items(items: list[tuple[str, bytes]], window: int) -> tuple[dict[bytes, int], list[WuManber]]:
    """Numbers of the items' words (from 1), and a machine for each length of pattern."""
    numbers: dict[bytes, int] = {}
    stream: list[int] = []
    first: dict[tuple, int] = {}
    sizes: dict[int, dict[int, list[int]]] = defaultdict(dict)
    for k, (_, text) in enumerate(items):
        begin = len(stream)
        stream += [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        n = len(stream) - begin
        size = min(window, n)
        for i in range(begin, begin + n - size + 1) if n else ():
            at = first.setdefault(tuple(stream[i : i + size]), i)
            owners = sizes[size].setdefault(at, [])
            if k not in owners[-1:]:
                owners.append(k)
    return numbers, [WuManber(size, stream, places) for size, places in sorted(sizes.items())]


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The item set, in id order, in blocks of at most ``block_bytes`` of text (or one item)."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), text_bytes().alias("t"))
    block: list[tuple[str, bytes]] = []
    size = 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        if block and size + len(r.t) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r.i or "", bytes(r.t)))
        size += len(r.t)
    yield block


FOUND = "struct<n_words:bigint,hits:array<struct<start:bigint,end:bigint>>,items:array<string>>"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` and, as the last column, a struct of n_words, hits (array of [start, end) word ranges, sorted and disjoint)
    and items (sorted distinct ids). Text must be in the column ``text``."""
    tune(docs.sparkSession)
    name = free_name(docs.columns, "leaks")
    start = F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("hits"), F.array().cast("array<string>").alias("items"))
    out = docs.withColumn(name, start.cast(FOUND))
    for k, block in enumerate(item_blocks(benchmark, block_bytes)):
        if k:
            out = materialize(out, "scanned")
        out = out.mapInArrow(_scanner(block, window), out.schema)
    return out


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scanner(items: list[tuple[str, bytes]], window: int):
    names = [i for i, _ in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, machines = compile_items(items, window)
        number = numbers.get
        for batch in batches:
            out = []
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
            for text, before in zip(texts, batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                w = [number(x, 0) for x in words_of(text.as_py() or b"")]
                found = [(s, s + m.m, o) for m in machines for s, o in m.search(w)]
                ranges = [(x["start"], x["end"]) for x in before["hits"]] + [x[:2] for x in found]
                out.append({
                    "n_words": len(w), "hits": [{"start": a, "end": b} for a, b in merge_ranges(ranges)],
                    "items": sorted({*before["items"], *(names[k] for x in found for k in x[2])}),
                })
            last = batch.schema.field(batch.num_columns - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, last.type)], schema=batch.schema)

    return run


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of what ``scan`` gives."""
    x = F.col(scanned.columns[-1])
    n_hit = F.aggregate(x["hits"], F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return scanned.select(
        "doc_id", x["n_words"].alias("n_words"), n_hit.alias("n_hit"), F.size(x["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(x["items"], ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item."""
    found = scan(docs, benchmark, **how)
    return found.filter(F.size(F.col(found.columns[-1])["hits"]) == 0).select(*docs.columns)

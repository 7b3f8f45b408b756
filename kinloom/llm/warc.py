"""WARC records in seekable Zstandard bundles.

Records are grouped into frames of about ``frame_bytes``; each frame is compressed on its own, and a bundle ends with
the seek table of the seekable format (a skippable frame with the compressed and plain size of every frame). A record
identifier maps to (frame, offset in the plain frame, length), so one record is read by inflating one frame.

A bundle is a row of a table in the shared folder: Spark's committer writes it once, whatever tasks are lost, and it
works on every store that Spark can write. ``export_bundles`` puts bundles out as plain ``.warc.zst`` files.

Nulls and edge cases: a null payload is empty; a null url has no target header; a null record id is kept, and comes
back as null. Rows that repeat an id and payload are all written; those that hold a group's smallest id are responses.
Payloads under ``min_revisit_bytes`` are always responses. An empty table gives no bundle and no rows.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, tune

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

SALTS = 16
DATE = "1970-01-01T00:00:00Z"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def seal(frames: list[tuple[bytes, int]]) -> bytes:
    """A bundle of (compressed frame, plain size) with its footer seek table."""
    entries = b"".join(struct.pack("<II", len(data), plain) for data, plain in frames)
    footer = struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    head = struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer))
    return b"".join(data for data, _ in frames) + head + entries + footer


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of each frame, from the footer."""
    count, flags, magic = struct.unpack_from("<IBI", bundle, len(bundle) - 9)
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("not a seekable bundle")
    at, out = 0, []
    base = len(bundle) - 9 - 8 * count
    for k in range(count):
        size, plain = struct.unpack_from("<II", bundle, base + 8 * k)
        out.append((at, size, plain))
        at += size
    return out


def read_record(bundle: bytes, frame: int, offset: int, length: int) -> bytes:
    """One record: only its frame is inflated."""
    start, size, plain = seek_table(bundle)[frame]
    data = zstandard.ZstdDecompressor().decompress(bundle[start : start + size], max_output_size=max(plain, 1))
    return data[offset : offset + length]


def _record(rid, url, payload: bytes, digest: str, n_bytes: int, kind: str, refers) -> bytes:
    name = "" if rid is None else str(rid)
    block = b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:record:{name}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:record:{refers}>",
            f"X-Payload-Length: {n_bytes}",
        ]
    else:
        head.append("Content-Type: application/http; msgtype=response")
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {n_bytes}\r\n\r\n"
        block = http.encode() + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """The headers (lower-case names), the block and the end of the record that starts at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    begin = stop + 4
    end = begin + int(head["content-length"])
    return head, data[begin:end], end + 4


BUNDLE = (
    "bundle string, data binary, record_ids array<bigint>, frames array<int>, offsets array<bigint>, lengths array<bigint>"
)


def mark_revisits(pages: DataFrame, key: str, payload: str, min_revisit_bytes: int = 100) -> DataFrame:
    """``pages`` with payload, payload_bytes, payload_digest, record_type and refers_to.

    Payloads under ``min_revisit_bytes`` meet no join. The smallest id of each digest is found by a partial aggregate;
    only digests that occur with more than one row join back, each laid out ``SALTS`` times, so that the rows of a hot
    payload are dealt over as many tasks."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).cast("long").alias("rid"), F.col("url").alias("url"), body.alias("payload")
    ).select("*", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha2("payload", 256).alias("digest"))
    large = rows.filter(F.col("n_bytes") >= min_revisit_bytes).withColumn("salt", F.pmod(F.xxhash64("rid", "url"), F.lit(SALTS)).cast("int"))
    firsts = large.groupBy("digest").agg(F.min("rid").alias("first_rid"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.select("digest", "first_rid", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    again = F.col("first_rid").isNotNull() & ~F.col("rid").eqNullSafe(F.col("first_rid"))
    marked = large.join(firsts, ["digest", "salt"], "left").select(
        "rid", "url", F.when(again, F.lit(b"")).otherwise(F.col("payload")).alias("payload"), "n_bytes", "digest",
        F.when(again, "revisit").otherwise("response").alias("kind"), F.when(again, F.col("first_rid")).alias("refers"),
    )
    small = rows.filter(F.col("n_bytes") < min_revisit_bytes)
    return marked.unionByName(small.select("rid", "url", "payload", "n_bytes", "digest", F.lit("response").alias("kind"), F.lit(None).cast("long").alias("refers")))


def bundles(records: DataFrame, frame_bytes: int = 1 << 20, bundle_bytes: int = 16 << 20, level: int = 3) -> DataFrame:
    """Packs what ``mark_revisits`` gives into bundles, each with its record index. A task holds one open frame and
    the compressed frames of one bundle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=level)
        frames: list[tuple[bytes, int]] = []
        plain: list[bytes] = []
        size = done = 0
        index: list[tuple] = []

        def close() -> None:
            nonlocal plain, size, done
            if plain:
                data = b"".join(plain)
                frames.append((packer.compress(data), len(data)))
                done += len(frames[-1][0])
                plain, size = [], 0

        def ship() -> pa.RecordBatch:
            nonlocal frames, index, done
            data = seal(frames)
            ids, fr, off, ln = zip(*index, strict=True)
            row = pa.RecordBatch.from_arrays(
                [pa.array([hashlib.sha256(data).hexdigest()[:32]]), pa.array([data], pa.binary()), pa.array([ids], pa.list_(pa.int64())), pa.array([fr], pa.list_(pa.int32())), pa.array([off], pa.list_(pa.int64())), pa.array([ln], pa.list_(pa.int64()))],
                names=["bundle", "data", "record_ids", "frames", "offsets", "lengths"],
            )
            frames, index, done = [], [], 0
            return row

        for batch in batches:
            for x in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                rid, url, payload, n_bytes, digest, kind, refers = x
                rec = _record(rid, url, payload, digest, n_bytes, kind, refers)
                index.append((rid, len(frames), size, len(rec)))
                plain.append(rec)
                size += len(rec)
                if size >= frame_bytes:
                    close()
                    if done >= bundle_bytes:
                        yield ship()
        close()
        if frames:
            yield ship()

    tune(records.sparkSession)
    return records.select("rid", "url", "payload", "n_bytes", "digest", "kind", "refers").mapInArrow(pack, BUNDLE)


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"


def read_bundles(stored: DataFrame) -> DataFrame:
    """Every record of every bundle, in its frames' order; a response's digest is computed anew from its payload and
    held against its header."""

    def name(urn: str):
        got = urn[len("<urn:record:") : -1]
        return int(got) if got else None

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for bundle in batch.column(0):
                data = memoryview(bundle.as_buffer())
                for start, size, plain in seek_table(data):
                    frame = reader.decompress(data[start : start + size], max_output_size=max(plain, 1))
                    at, rows = 0, []
                    while at < len(frame):
                        head, block, at = parse(frame, at)
                        digest = head["warc-payload-digest"].removeprefix("sha256:")
                        if head["warc-type"] == "revisit":
                            n, refers = int(head["x-payload-length"]), name(head["warc-refers-to"])
                        else:
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            n, refers = len(payload), None
                            if hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"payload of {head['warc-record-id']} is damaged")
                        rows.append((name(head["warc-record-id"]), n, digest, head["warc-type"], refers, head.get("warc-target-uri")))
                    cols = list(zip(*rows, strict=True))
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                        names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"],
                    )

    return stored.select("data").mapInArrow(unpack, READ)


def record_index(stored: DataFrame) -> DataFrame:
    """record_id, bundle, frame, offset, length: where each record is."""
    zipped = F.explode(F.arrays_zip("record_ids", "frames", "offsets", "lengths")).alias("x")
    return stored.select("bundle", zipped).select(
        F.col("x.record_ids").alias("record_id"), "bundle", F.col("x.frames").alias("frame"),
        F.col("x.offsets").alias("offset"), F.col("x.lengths").alias("length"),
    )


def fetch(stored: DataFrame, record_id: int) -> DataFrame:
    """The raw records of one id. The index columns are read first; then only the bundles that hold the id, by a filter
    that reaches the scan, and of each a single frame is inflated."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, f, o, n in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([read_record(data, f, o, n)], pa.binary())], names=["record"])

    at = record_index(stored.filter(F.array_contains("record_ids", record_id))).filter(F.col("record_id") == record_id)
    holders = [r.bundle for r in at.select("bundle").distinct().collect()]
    return at.join(stored.filter(F.col("bundle").isin(holders)).select("bundle", "data"), "bundle").select("data", "frame", "offset", "length").mapInArrow(pick, "record binary")


def export_bundles(stored: DataFrame, folder: str) -> None:
    """Writes each bundle as ``<bundle>.warc.zst`` into a folder that all executors see."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = f"{folder}/.{name}.{os.getpid()}"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, f"{folder}/{name}.warc.zst")
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())], names=["bundle"])

    stored.select("bundle", "data").mapInArrow(put, "bundle string").count()


def archive(pages: DataFrame, **sizes) -> DataFrame:
    """Writes the pages' bundles to the shared folder and returns the table of bundles."""
    return materialize(bundles(mark_revisits(pages, "page_id", "html"), **sizes), "bundles")

"""WARC records in seekable Zstandard bundles.

A bundle is one object: records in independent frames of about FRAME_BYTES, then a skippable
frame with the seek table (compressed and full size of every frame, their number, a magic
number), so that any Zstandard reader can read it and a reader of the table can begin at any
frame. An index row maps each record to bundle, frame, and the offset inside the frame.

Bundles are written by tasks into the shared folder, each under a name of its own; the index,
which Spark commits, is what makes a bundle valid, so that a task that is lost and run again
leaves an unreferenced object and no double records. Reading goes by the bundles that the
index names, one bundle a row, one frame at a time.

Among payloads of at least REVISIT_BYTES that are equal the smallest id is written as
response and the others as revisits without a payload; digests are folded per partition
first, so a payload that a third of all pages share is one row per partition.

Defined results: a null payload is empty; rows that share the smallest id of their payload
are all responses, since a record cannot refer to its own id; a null id is last; a record's
url may be null. An empty table gives an empty index and no bundle.
"""

from __future__ import annotations

import hashlib
import struct
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecat.llm.common import same, small_side, whole
from framecat.session import materialise, scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REVISIT_BYTES = 100
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
LEVEL = 3
# Fixed values of the formats.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "page_id long, bundle string, frame int, at long, length long"


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, local if it names none."""
    if uri.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    for ours in ("s3a://", "s3n://"):
        if uri.startswith(ours):
            uri = "s3://" + uri[len(ours) :]
    return fs.FileSystem.from_uri(uri)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit keeps the payload's length in its HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else "%%%02X" % ord(c) for c in url))
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block, and where the record ends."""
    cut = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:cut].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    fields = dict(line.split(": ", 1) for line in lines)
    end = cut + 4 + int(fields["Content-Length"])
    return fields, data[cut + 4 : end], end + 4


def _number(urn: str) -> int | None:
    told = urn[len("<urn:page:") : -1]
    return int(told) if told else None


class BundleWriter:
    """Frames and seek table of one object."""

    def __init__(self, root: str):
        self.path = f"{root}/{uuid.uuid4().hex}.warc.zst"
        store, path = store_of(self.path)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.held, self.size, self.total = store.open_output_stream(path, compression=None), [], 0, 0
        self.frames: list[tuple[int, int]] = []

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        place = (len(self.frames), self.size)
        self.held.append(data)
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self._close_frame()
        return place

    def _close_frame(self) -> None:
        if self.size:
            packed = zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((len(packed), self.size))
            self.total += len(packed)
            self.held, self.size = [], 0

    def close(self) -> None:
        self._close_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()


class BundleReader:
    def __init__(self, path: str):
        store, name = store_of(path)
        self.file = store.open_input_file(name)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"no seek table in {path}")
        entries = np.frombuffer(self.file.read_at(8 * count, size - 9 - 8 * count), "<u4").reshape(count, 2).astype(np.int64)
        self.sizes, self.starts = entries, np.concatenate(([0], np.cumsum(entries[:, 0])))

    def frame(self, number: int) -> bytes:
        packed, full = (int(x) for x in self.sizes[number])
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, int(self.starts[number])), max_output_size=full)

    def __enter__(self) -> BundleReader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def with_revisits(pages: DataFrame, id: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """page_id, url, html, digest, first (the id of the response with this payload, or null) of every page."""
    rows = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"), whole(html).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    digests = rows.filter(F.octet_length("html") >= REVISIT_BYTES).select("digest", "page_id")
    firsts = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1")
    firsts = materialise(firsts.select(F.col("digest").alias("_digest"), "first"), "responses")
    return rows.join(small_side(firsts), F.col("digest") == F.col("_digest"), "left").drop("_digest")


def write_bundles(pages: DataFrame, root: str, id: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """Writes the pages' records below root; gives the committed index, one row a record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            told = []
            for row in batch.to_pylist():
                if bundle is None:
                    bundle = BundleWriter(root)
                payload, first = row["html"].encode(), row["first"]
                revisit = row["grouped"] and row["page_id"] != first
                data = record(row["page_id"], row["url"], payload, row["digest"], first, revisit)
                told.append((row["page_id"], bundle.path, *bundle.add(data), len(data)))
                if bundle.total >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            names = ("page_id", "bundle", "frame", "at", "length")
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            columns = list(zip(*told)) if told else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        if bundle is not None:
            bundle.close()

    rows = with_revisits(pages, id, html, url)
    grouped = rows.withColumn("grouped", F.col("first").isNotNull())
    return materialise(grouped.mapInArrow(run, INDEX), "warc-index")


_READ = "page_id long, record_type string, payload_bytes long, payload_digest string, told_digest string, refers_to long"


def _told(data: bytes, at: int) -> tuple[tuple, int]:
    fields, block, end = parse(data, at)
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    kind, told = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    own = (len(payload), hashlib.sha256(payload).hexdigest()) if kind == "response" else (None, None)
    refers = _number(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return (_number(fields["WARC-Record-ID"]), kind, *own, told, refers), end


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    names = [f.split()[0] for f in _READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_records(index: DataFrame) -> DataFrame:
    """Every record of the bundles that the index names: type, size and digest of the payload read, and what its header tells."""
    bundles = materialise(index.groupBy("bundle").agg(F.count(F.lit(1)).alias("n")), "bundles")
    count = bundles.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("bundle").to_pylist():
                with BundleReader(path) as bundle:
                    for number in range(len(bundle.sizes)):
                        data, at, rows = bundle.frame(number), 0, []
                        while at < len(data):
                            row, at = _told(data, at)
                            rows.append(row)
                        yield _batch(rows)

    spread = bundles.repartition(max(1, min(count, 100_000)), "bundle") if count else bundles
    return spread.mapInArrow(run, _READ)


def resolve(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit gets size and digest of the response it refers to."""
    held = materialise(records, "records")
    asked = held.filter("record_type = 'revisit'").select(F.col("refers_to").alias("_asked")).distinct()
    answers = held.filter("record_type = 'response'").join(small_side(materialise(asked, "asked")), same(F.col("page_id"), F.col("_asked")))
    answers = answers.groupBy("_asked", "payload_digest").agg(F.min("payload_bytes").alias("_bytes"))
    answers = materialise(answers.select("_asked", F.col("payload_digest").alias("_digest"), "_bytes"), "answers")
    ok = same(F.col("refers_to"), F.col("_asked")) & (F.col("told_digest") == F.col("_digest")) & (F.col("record_type") == "revisit")
    told = held.join(small_side(answers), ok, "left")
    return told.select(
        "page_id",
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def lookup(index: DataFrame, ids: DataFrame, id: str = "page_id") -> DataFrame:
    """page_id and payload of the asked ids' records, by seeking to their frames only; a revisit's payload is null."""
    found = index.join(small_side(ids.select(F.col(id).alias("_id")).distinct()), F.col("page_id") == F.col("_id"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, payloads = [], []
            for row in batch.to_pylist():
                with BundleReader(row["bundle"]) as bundle:
                    fields, block, _ = parse(bundle.frame(row["frame"]), row["at"])
                pages.append(row["page_id"])
                payloads.append(block[block.index(b"\r\n\r\n") + 4 :] if fields["WARC-Type"] == "response" else None)
            yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int64()), pa.array(payloads, pa.binary())], ["page_id", "payload"])

    return found.mapInArrow(run, "page_id long, payload binary")


def archive(pages: DataFrame, root: str | None = None, **columns: str) -> DataFrame:
    """Writes all pages and reads the archives back."""
    index = write_bundles(pages, root or scratch_path(pages.sparkSession, "warc"), **columns)
    return resolve(read_records(index))

"""Removal of long repeated substrings, judged on bytes.

A place is removed if a string of LEAST bytes that covers it also starts elsewhere. Every
such string has an anchor: the leftmost of those of its KGRAM-byte pieces whose hash is
least. Equal strings have equal anchors, so only strings of one anchor hash can be equal, and
the anchors are about a hundredth of all places. The neighbouring starts that share an anchor
place are one context (on average 85 starts and the bytes they cover).

1. One pass writes anchor hash and context hash of every context. An anchor hash that occurs
   once settles its context: no string of it repeats. One whose contexts are all equal
   settles them too: all their strings repeat. Copies thus never leave as text.
2. Where contexts of one anchor hash differ, the bytes of each different context are brought
   into shards by that hash, and the repeated strings are found on each shard's
   Burrows-Wheeler transform (``bwt``): threshold-bounded interval expansion.
3. An anchor hash with more than CROWD different contexts (the border of a passage that a
   third of all documents have) is dealt on by where the anchor lies in the strings. Strings in
   which it lies at an offset in [a, b) share the a bytes before the anchor and all but the
   last b - 1 after it, so equal strings go to equal (anchor, range, shared bytes). A group that
   is still too large is halved by offset and dealt again, at most eight times: a range of
   one offset shares the whole string. Pieces that are equal fold to one before each step. So a
   context costs about two rows a step, and no group is gathered without a bound.
4. The runs of repeated starts of a document are united and cut out of its bytes.

Contexts are told apart by 128 bits of hashes, 64 of them the anchor's, pieces of crowded ones
by their bytes; nothing else is approximate. A document is found again by its id and the hash of its text.

Defined results: a null text is empty; texts under LEAST bytes lose nothing; rows that repeat
are copies of each other, whatever their ids; very long texts are scanned in overlapping parts.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framecat.llm import bwt
from framecat.llm.common import raw_hash, small_side, whole
from framecat.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST, KGRAM = 200, 32
PART_BYTES = 1 << 21
SHARD_BYTES = 1 << 21
CROWD = 2_000
BASE = 0x9E3779B97F4A7C15
KEYS = "doc_id long, raw long"


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the KGRAM bytes from each place on."""
    table = np.random.default_rng(7).integers(1, 2**63, 256).astype(np.uint64)
    h, power = table[data], BASE
    width = 1
    while width < KGRAM:
        h = h[:-width] * np.uint64(power) + h[width:]
        power = power * power % 2**64
        width *= 2
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes the place of the least upper half, the leftmost of ties."""
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    done = 1
    while 2 * done <= width:
        packed = np.minimum(packed[:-done], packed[done:])
        done *= 2
    if done < width:
        packed = np.minimum(packed[: len(packed) - (width - done)], packed[width - done :])
    return (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)


def contexts(data: bytes, least: int) -> Iterator[tuple[int, int, int, int, int]]:
    """first start, number of starts, where the anchor lies from there, anchor hash, context hash for each context of one text."""
    width = least - KGRAM + 1
    for low in range(0, len(data) - least + 1, PART_BYTES):
        part = data[low : low + PART_BYTES + least - 1]
        hashes = _gram_hashes(np.frombuffer(part, np.uint8))
        place = _least_places(hashes, width)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.append(first[1:], len(place))
        anchors = hashes[place[first]].view(np.int64).tolist()
        for a, b, at, anchor in zip(first.tolist(), last.tolist(), (place[first] - first).tolist(), anchors):
            yield low + a, b - a, at, anchor, xxhash.xxh3_64_intdigest(part[a : b + least - 1]) - 2**63


def _anchored(docs: DataFrame, least: int) -> DataFrame:
    """All contexts of docs (doc_id, raw, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                rows, counts = [], []
                for text in part.column(2):
                    found = list(contexts(text.as_buffer().to_pybytes(), least))
                    rows += found
                    counts.append(len(found))
                if rows:
                    owner = pa.array(np.repeat(np.arange(len(part)), counts))
                    start, n, at, anchor, context = np.array(rows, np.int64).T
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(owner), part.column(1).take(owner), *map(pa.array, (start, n, at, anchor, context))],
                        ["doc_id", "raw", "start", "n", "at", "anchor", "context"],
                    )

    return docs.mapInArrow(run, f"{KEYS}, start long, n long, at long, anchor long, context long")


def _of(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    ids = keys.select(F.col("doc_id").alias("_id"), F.col("raw").alias("_raw"))
    return docs.join(small_side(ids), docs["doc_id"].eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw")), how)


def _with_lists(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """docs that have a list, with it; only their texts are shuffled while the ids fit a broadcast."""
    held = _of(docs, lists, "left_semi")
    named = lists.withColumnsRenamed({"doc_id": "_id", "raw": "_raw"})
    return held.join(named, held["doc_id"].eqNullSafe(F.col("_id")) & (F.col("raw") == F.col("_raw"))).drop("_id", "_raw")


def _context_bytes(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """wanted contexts with their bytes, cut from the texts."""
    entry = F.struct("start", "n", "at", "anchor", "single")
    lists = materialise(wanted.groupBy("doc_id", "raw").agg(F.collect_list(entry).alias("list")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 64):
                rows = []
                for row in batch.slice(low, 64).to_pylist():
                    data = row["text"].encode()
                    for c in row["list"]:
                        cut = data[c["start"] : c["start"] + c["n"] + least - 1]
                        rows.append((row["doc_id"], row["raw"], c["start"], c["at"], c["anchor"], c["single"], cut))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                columns = list(zip(*rows)) if rows else [()] * 7
                names = ["doc_id", "raw", "start", "at", "anchor", "single", "bytes"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    told = _with_lists(docs, lists).select("doc_id", "raw", "text", "list")
    # Rows that repeat with id and text give each context once.
    return told.dropDuplicates(["doc_id", "raw"]).mapInArrow(run, f"{KEYS}, start long, at long, anchor long, single boolean, bytes binary")


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """First place and length of each run of neighbouring places."""
    if not len(starts):
        return []
    first = np.flatnonzero(np.concatenate(([True], np.diff(starts) > 1)))
    return list(zip(starts[first].tolist(), np.diff(np.append(first, len(starts))).tolist()))


def _in_shards(held: DataFrame, least: int) -> DataFrame:
    """Repeated starts of contexts (or pieces of them) that occur once, from the transform of each shard's contexts."""
    total = held.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_BYTES))

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["doc_id", "raw", "start", "single", "bytes"]).to_pylist()
        out = []
        for row, starts in zip(rows, bwt.repeats([r["bytes"] for r in rows], least)):
            if row["single"]:
                out += [(row["doc_id"], row["raw"], row["start"] + a, n) for a, n in _runs(starts)]
        columns = list(zip(*out)) if out else [()] * 4
        return pa.table({k: pa.array(c, pa.int64()) for k, c in zip(("doc_id", "raw", "start", "n"), columns)})

    placed = held.withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(shards)))
    return placed.repartition(min(shards, 20_000), "shard").groupBy("shard").applyInArrow(run, f"{KEYS}, start long, n long")


PIECE = f"{KEYS}, start long, single boolean, bytes binary, anchor long, a int, b int, low int, high int, deal long"
NAMES = [f.split()[0] for f in PIECE.split(", ")]


def _halved(pieces: DataFrame, least: int) -> DataFrame:
    """Pieces cut at the middle of their range of offsets; what each half shares decides where it is dealt.

    low and high are the offsets of the anchor in a piece's own strings, last and first of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slow in range(0, len(batch), 256):
                out = []
                for row in batch.slice(slow, 256).to_pylist():
                    middle = (row["a"] + row["b"]) // 2
                    for a, b in ((row["a"], middle), (middle, row["b"])):
                        low, high = max(a, row["low"]), min(b, row["high"])
                        if low >= high:
                            continue
                        skip = row["high"] - high  # strings whose anchor lies farther right come first
                        cut = row["bytes"][skip : skip + high - low + least - 1]
                        at = high - 1  # the anchor in this piece
                        shared = cut[at - a : at + least + 1 - b]
                        deal = xxhash.xxh3_64_intdigest(shared, seed=a * least + b) - 2**63
                        out.append((row["doc_id"], row["raw"], row["start"] + skip, row["single"], cut, row["anchor"], a, b, low, high, deal))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), *[pa.int32()] * 4, pa.int64()]
                columns = list(zip(*out)) if out else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)

    return pieces.mapInArrow(run, PIECE)


def _in_ranges(crowded: DataFrame, least: int, crowd: int) -> tuple[DataFrame, list[DataFrame]]:
    """Pieces that fit the transform, and the runs of pieces that were found equal on the way."""
    high = (F.col("at") + 1).cast("int")
    n = (F.octet_length("bytes") - least + 1).cast("int")
    whole_range = [F.lit(0).alias("a"), F.lit(least - KGRAM + 1).alias("b"), (high - n).alias("low"), high.alias("high")]
    pieces = crowded.select("doc_id", "raw", "start", "single", "bytes", "anchor", *whole_range, F.col("anchor").alias("deal"))
    fit, runs = None, []
    group, deal = ["anchor", "a", "b", "low", "high", "bytes"], ["anchor", "a", "b", "deal"]
    while True:
        pieces = materialise(_halved(pieces, least), "pieces")
        folded = pieces.groupBy(*group, "deal").agg(
            F.count(F.lit(1)).alias("times"), F.bool_and("single").alias("single"), F.min(F.struct("doc_id", "raw", "start")).alias("one")
        )
        folded = folded.withColumn("again", (F.col("times") > 1) | ~F.col("single"))
        folded = materialise(folded.select("one.*", (~F.col("again")).alias("single"), "again", *group, "deal"), "folded")
        told = folded.filter("again").select(*[F.col(c).alias(f"_{c}") for c in group])
        equal = [F.col(c) == F.col(f"_{c}") for c in group]
        runs.append(pieces.filter("single").join(told, equal, "left_semi").select("doc_id", "raw", "start", (F.col("high") - F.col("low")).cast("long").alias("n")))
        sizes = folded.groupBy(*deal).agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > crowd)
        large = materialise(sizes.select(*[F.col(c).alias(f"_{c}") for c in deal]), "large")
        same = [F.col(c) == F.col(f"_{c}") for c in deal]
        small = folded.join(small_side(large), same, "left_anti").select(*NAMES)
        fit = small if fit is None else fit.unionByName(small)
        if large.isEmpty():
            return fit, runs
        pieces = folded.join(small_side(large), same, "left_semi").select(*NAMES)


def repeated_starts(docs: DataFrame, least: int = LEAST, crowd: int = CROWD) -> DataFrame:
    """doc_id, raw, start, n: runs of places of docs (doc_id, raw, text) where a string starts that also starts elsewhere."""
    found = materialise(_anchored(docs, least), "contexts")
    per = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times"), F.min("context").alias("a"), F.max("context").alias("b"))
    per = per.filter("times > 1").select(F.col("anchor").alias("_anchor"), (F.col("a") != F.col("b")).alias("mixed"))
    told = materialise(found.join(per, F.col("anchor") == F.col("_anchor")).drop("_anchor"), "repeated")
    mixed = told.filter("mixed")
    counts = mixed.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("doc_id", "raw", "start", "n", "at")).alias("one"))
    counts = materialise(counts, "different")
    many = counts.filter("times > 1").select(F.col("anchor").alias("_anchor"), F.col("context").alias("_context"))
    again = mixed.join(many, (F.col("anchor") == F.col("_anchor")) & (F.col("context") == F.col("_context")), "left_semi")
    wanted = counts.select("one.*", "anchor", (F.col("times") == 1).alias("single"))
    held = materialise(_context_bytes(docs, wanted, least), "context-bytes")
    crowds = counts.groupBy("anchor").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") > crowd)
    crowds = materialise(crowds.select(F.col("anchor").alias("_anchor")), "crowds")
    names = ["doc_id", "raw", "start", "n"]
    found = told.filter("not mixed").select(*names).unionByName(again.select(*names))
    held = held.withColumn("deal", F.col("anchor"))
    if not crowds.isEmpty():
        crowded, same = held.join(small_side(crowds), F.col("anchor") == F.col("_anchor"), "left_semi"), F.col("anchor") == F.col("_anchor")
        fit, runs = _in_ranges(crowded, least, crowd)
        for run in runs:
            found = found.unionByName(run)
        columns = ["doc_id", "raw", "start", "single", "bytes", "deal"]
        held = held.join(small_side(crowds), same, "left_anti").select(*columns).unionByName(fit.select(*columns))
    return found.unionByName(_in_shards(held.select("doc_id", "raw", "start", "single", "bytes", "deal"), least))


def _united(runs: list[dict], least: int, size: int) -> list[tuple[int, int]]:
    """Removed spans, in order, none touching another."""
    spans: list[list[int]] = []
    for low, high in sorted((r["start"], min(size, r["start"] + r["n"] + least - 1)) for r in runs):
        if spans and low <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], high)
        else:
            spans.append([low, high])
    return [tuple(s) for s in spans]


def remove_repeats(docs: DataFrame, least: int = LEAST, id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """doc_id, raw, n_bytes, spans (removed, begin and end), kept (the remaining bytes) for every row."""
    rows = docs.select(F.col(id).alias("doc_id"), raw_hash(text).alias("raw"), whole(text).alias("text"))
    # Rows that repeat with id and text tell each run once.
    runs = repeated_starts(rows, least, crowd).distinct()
    lists = materialise(runs.groupBy("doc_id", "raw").agg(F.collect_list(F.struct("start", "n")).alias("list")), "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 64):
                part = batch.slice(low, 64)
                sizes, spans, kept = [], [], []
                for row in part.to_pylist():
                    data = row["text"].encode()
                    found = _united(row["list"], least, len(data))
                    edges = [0, *(x for s in found for x in s), len(data)]
                    sizes.append(len(data))
                    spans.append([{"begin": a, "end": b} for a, b in found])
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                    ["doc_id", "raw", "n_bytes", "spans", "kept"],
                )

    schema = f"{KEYS}, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary"
    cut = _with_lists(rows, lists).select("doc_id", "raw", "text", "list").mapInArrow(run, schema)
    same = _of(rows, lists, "left_anti").select(
        "doc_id",
        "raw",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<begin: bigint, end: bigint>>").alias("spans"),
        F.col("text").cast("binary").alias("kept"),
    )
    return cut.unionByName(same)

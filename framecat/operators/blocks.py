"""Vectors in blocks with pivot distances, so that block pairs which cannot meet are never formed.

Every vector has its distances to some pivots. Rows are ordered by the nearest pivot and the
distance to it, and cut into blocks, one row each: keys, vectors and pivot distances as
bytes, and the least and largest distance to each pivot. Two blocks whose ranges lie far
apart for one pivot hold no near pair (triangle inequality), so block pairs are made from
ranges alone, and only then do vectors move.

More data needs more pivots to keep blocks narrow: ``pivot_count`` grows with the square
root of the number of blocks. Pivots come from a bounded sample; they decide how much is
skipped, never what is found.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.session import materialise

# What runs inside tasks travels with them, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1024
#: Rows of the sample pivots are chosen from, and how many of them at least and at most.
SAMPLE_ROWS, FEWEST, MOST = 4096, 16, 256
#: Ranges of so many blocks travel as one row.
RANGES = 1024
#: Distances are kept as float32; a bound is loosened by this share of the distance.
SINGLE = 4e-7
#: Coordinates are cut off here before distances are taken, and distances at CUT; neither moves two vectors apart.
LARGEST, CUT = 1e100, 3e38

BLOCK = "block long, n int, width int, keys binary, kind string, cells binary, pivots binary, low binary, high binary"


def small(cells: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest type that holds them all."""
    for kind in (np.int8, np.int16, np.int32, np.float32, np.int64):
        with np.errstate(invalid="ignore", over="ignore"):
            cast = cells.astype(kind)
            if np.array_equal(cast.astype(cells.dtype), cells) and (kind is not np.int64 or cells.dtype == np.int64):
                return cast
    return cells


def pivot_count(rows: int, block_rows: int = BLOCK_ROWS) -> int:
    return min(MOST, max(FEWEST, math.isqrt(max(1, rows // block_rows)) * 2))


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` rows of the sample, each the farthest from those chosen before it."""
    if not len(sample):
        return sample
    chosen, near = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(count, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def fitted(pivots: np.ndarray, width: int) -> np.ndarray:
    """Pivots for vectors of another length: cut, or filled with zeros."""
    out = np.zeros((len(pivots), width))
    out[:, : min(width, pivots.shape[1])] = pivots[:, :width]
    return out


def pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    p, rows = fitted(pivots, rows.shape[1]), np.clip(rows, -LARGEST, LARGEST)
    squares = np.einsum("ij,ij->i", rows, rows)[:, None] + np.einsum("ij,ij->i", p, p)[None, :] - 2 * (rows @ p.T)
    near = squares < 1e-4 * np.einsum("ij,ij->i", rows, rows)[:, None]  # where cancellation would be felt
    told = np.sqrt(np.maximum(squares, 0.0))
    for j in np.flatnonzero(near.any(axis=0)):
        i = np.flatnonzero(near[:, j])
        told[i, j] = np.linalg.norm(rows[i] - p[j], axis=1)
    return told


def stacked(column: pa.Array) -> np.ndarray:
    """Rows of a list column that have one length, as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    width = len(column[0])
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


Seen = Callable[[np.ndarray], np.ndarray]


def as_they_are(cells: np.ndarray) -> np.ndarray:
    return cells


def sampled_pivots(rows: DataFrame, vector: str, key: str, count: int, seen: Seen = as_they_are) -> np.ndarray:
    """Pivots from SAMPLE_ROWS rows in hash order, of the width most of them have, as ``seen`` shows them."""
    held = rows.select(vector).orderBy(F.xxhash64(key), key).limit(SAMPLE_ROWS).toArrow().column(0).to_pylist()
    if not held:
        return np.zeros((0, 0))
    widths = [len(v) for v in held]
    width = max(sorted(set(widths)), key=widths.count)
    cells = np.array([v for v in held if len(v) == width], np.float64).reshape(-1, width)
    return far_apart(np.clip(seen(cells), -LARGEST, LARGEST), count)


def lengths(from_origin: np.ndarray) -> np.ndarray:
    """Lengths of vectors from their distances to the origin, which are lower bounds where they were cut off."""
    return np.where(from_origin >= CUT * (1 - 1e-6), np.inf, from_origin)


def blocked(
    rows: DataFrame,
    pivots,
    key: str,
    vector: str,
    label: str,
    block_rows: int = BLOCK_ROWS,
    total: int | None = None,
    seen: Seen = as_they_are,
) -> DataFrame:
    """Blocks of rows (key, a long; vector, an array without NULL), written. ``pivots`` is a broadcast.

    Vectors of other lengths are in blocks of their own. Distances to pivots are those of what
    ``seen`` makes of the vectors (unit vectors, say).
    """
    total = rows.count() if total is None else total
    parts = min(20_000, max(1, math.ceil(total / (8 * block_rows))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.diff(batch.column(1).offsets.to_numpy())
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width)) if len(np.unique(widths)) > 1 else batch
                cells = stacked(part.column(1))
                away = pivot_distances(seen(cells), pivots.value)
                home = away.argmin(axis=1) if away.shape[1] else np.zeros(len(cells), int)
                near = away[np.arange(len(cells)), home] if away.shape[1] else np.zeros(len(cells))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.full(len(cells), width, np.int32)), pa.array(home.astype(np.int32)), pa.array(near)],
                    ["key", "vec", "width", "home", "near"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            part = pa.Table.from_batches(rows)
            cells = stacked(part.column("vec"))
            # Cutting off is no farther apart than before, so bounds hold beyond float32 too.
            away = np.minimum(pivot_distances(seen(cells), pivots.value), CUT).astype(np.float32)
            least = small(cells)
            low = away.min(axis=0).astype(np.float64)
            high = away.max(axis=0).astype(np.float64)
            keys = part.column("key").to_numpy().astype(np.int64)
            told = (0, len(cells), cells.shape[1], keys.tobytes(), least.dtype.str, least.tobytes(), away.tobytes(), low.tobytes(), high.tobytes())
            return pa.RecordBatch.from_pylist([dict(zip(shape.names, told))], schema=shape)

        for batch in batches:
            widths = batch.column("width").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(widths)) + 1).tolist(), len(batch)]
            for low, high in zip(edges, edges[1:]):
                at = low
                while at < high:
                    if held and held[0].column("width")[0].as_py() != widths[at]:
                        yield block(held)
                        held = []
                    take = min(high - at, block_rows - sum(map(len, held)))
                    held.append(batch.slice(at, take))
                    at += take
                    if sum(map(len, held)) == block_rows:
                        yield block(held)
                        held = []
        if held:
            yield block(held)

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    shape = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in BLOCK.split(", "))])
    kind = rows.schema[vector].dataType.simpleString()
    placed = rows.select(F.col(key).alias("key"), F.col(vector).alias("vec")).mapInArrow(place, f"key long, vec {kind}, width int, home int, near double")
    # The key settles ties, so that no group of equal distances lands in one task.
    order = ["width", "home", "near", "key"]
    placed = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    packed = placed.mapInArrow(pack, BLOCK).withColumn("block", F.monotonically_increasing_id())
    return materialise(packed, label)


#: What only the choice of block pairs needs, and a step that asks for no pivot distances can do without.
RANGES_ONLY = ("pivots", "low", "high")


def rows_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Keys, vectors as doubles of a block."""
    keys = np.frombuffer(row["keys"], np.int64)
    return keys, np.frombuffer(row["cells"], np.dtype(row["kind"])).reshape(row["n"], row["width"]).astype(np.float64)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, vectors as doubles, pivot distances of a block."""
    keys, cells = rows_of(row)
    away = np.frombuffer(row["pivots"], np.float32).reshape(row["n"], -1).astype(np.float64)
    return keys, cells, away


def range_gap(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The least distance that a vector of one block can have to one of each of the others."""
    gaps = np.maximum(lows - high[None, :], low[None, :] - highs) - SINGLE * (np.maximum(high[None, :], highs))
    return np.maximum(gaps, 0.0).max(axis=1, initial=0.0)


Cost = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
Step = Callable[[dict, Iterator[dict]], Iterator[pa.RecordBatch]]


def led(heads: DataFrame, rows: DataFrame, by: list[str], order: list[str], step: Step, shape: str) -> DataFrame:
    """Gives ``step`` each head and then the rows with its key in order, one at a time.

    A secondary sort: the head comes first, rows stream after it, so a task holds one head
    and one row whatever the number of rows.
    """
    both = heads.withColumn("_head", F.lit(True)).unionByName(rows.withColumn("_head", F.lit(False)), allowMissingColumns=True)
    dealt = both.repartition(*by).sortWithinPartitions(*by, F.desc("_head"), *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (r for batch in batches for at in range(len(batch)) for r in batch.slice(at, 1).to_pylist())
        head = next(stream, None)
        while head is not None:
            after: list[dict | None] = [None]

            def own() -> Iterator[dict]:
                for row in stream:
                    if row["_head"]:
                        after[0] = row
                        return
                    yield row

            led_by = own()
            yield from step(head, led_by)
            for _ in led_by:  # a step may stop early
                pass
            head = after[0]

    return dealt.mapInArrow(run, shape)


def lane(column: str, lanes: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(lanes)).cast("int")


def each(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def block_pairs(left: DataFrame, right: DataFrame, cost: Cost, ordered: bool = False) -> DataFrame:
    """left, right, cost: pairs of blocks of one width whose cost is at most the left block's ``most``; written.

    left has block, width, low, high, most. Ranges of right are dealt in chunks that all left
    blocks stream by; nothing is broadcast, and no vector is read. With ``ordered`` only right
    blocks from the left one on are taken (a table against itself).
    """
    chunks, lanes = (max(1, math.ceil(side.count() / RANGES)) for side in (right, left))
    told = right.select(F.struct("block", "width", "low", "high").alias("range"), lane("block", chunks).alias("chunk"))
    heads = told.groupBy("chunk").agg(F.collect_list("range").alias("ranges")).select("chunk", "ranges", each(lanes).alias("lane"))
    rows = left.select("block", "width", "low", "high", F.col("most").cast("double").alias("most"), lane("block", lanes).alias("lane"))

    def decide(head: dict, rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        if head["ranges"] is None:  # no right blocks in this chunk
            return
        ranges, of_width = head["ranges"], {}
        for width in {r["width"] for r in ranges}:
            there = [r for r in ranges if r["width"] == width]
            lows, highs = (np.stack([np.frombuffer(r[k], np.float64) for r in there]) for k in ("low", "high"))
            of_width[width] = np.array([r["block"] for r in there], np.int64), lows, highs
        for row in rows:
            if row["width"] not in of_width:
                continue
            names, lows, highs = of_width[row["width"]]
            told = cost(np.frombuffer(row["low"], np.float64), np.frombuffer(row["high"], np.float64), lows, highs)
            fits = np.flatnonzero((told <= row["most"]) & ((names >= row["block"]) | (not ordered)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(fits), row["block"])), pa.array(names[fits]), pa.array(told[fits].astype(np.float64))],
                ["left", "right", "cost"],
            )

    dealt = led(heads, rows.select("*", each(chunks).alias("chunk")), ["chunk", "lane"], ["block"], decide, "left long, right long, cost double")
    return materialise(dealt, "block-pairs")


def streamed(pairs: DataFrame, left: DataFrame, right: DataFrame, lanes: int, step: Step, shape: str) -> DataFrame:
    """Gives ``step`` each left block with its right blocks, cheapest first.

    A left block with many partners is worked on in up to ``lanes`` tasks.
    """
    per = pairs.withColumn("lane", lane("right", lanes))
    heads = left.join(per.select(F.col("left").alias("block"), "lane").distinct(), "block")
    rows = right.withColumnRenamed("block", "right").join(per, "right").withColumnRenamed("left", "block")
    return led(heads, rows, ["block", "lane"], ["cost", "right"], step, shape)

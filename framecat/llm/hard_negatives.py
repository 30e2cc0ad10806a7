"""Hard negatives by a secondary sort.

For an anchor the positives are its best other rows of the same label, and the hard negatives
of a positive are the best rows of other labels whose score lies in a window below the
positive's. Sorted by (anchor, descending score, id), one pass over an anchor's scores is
enough: a positive opens a window, and a negative belongs to the windows it falls into.

1. Rows are dealt into lanes of about LANE_ROWS; blocks of anchors stream by each lane, so
   products are matrix products, a task holds one lane and one block, and rows move once.
2. A first pass keeps, for each lane and anchor, the best rows of the anchor's label; merged
   by anchor they are the positives. With them the windows are known.
3. A second pass sends on, for each lane and window, only the best rows within it, and the
   positives themselves. These keys are dealt by anchor and sorted within the partitions by
   (anchor, descending score, id): ``repartition`` and ``sortWithinPartitions``, the shuffle that
   repartitionAndSortWithinPartitions is for RDDs, without rows as Python objects.
4. An iterator runs over each partition: positives open windows, negatives are emitted with
   their rank in each window, a window closes when it is full or scores fall below it. It
   holds the open windows of one anchor, however many rows the anchor has.

Scores are exact integers (clamped to a long), components floor(scale * x).

Defined results: rows with a null id, label, vector or component, or a component that is not
finite (before or after scaling) take no part; vectors meet those of their length only; rows that
repeat id, label and vector count once; rows that share an id only are different rows, told
apart in the order of their labels and vectors. Ties go to the smaller id. An empty table, no
anchor, or anchors without positives give an empty result.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framecat.llm.common import numbered
from framecat.llm.pivot_topk import integers, products, sound
from framecat.operators.blocks import each, lane, small
from framecat.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LANE_ROWS, BLOCK_ROWS = 1 << 15, 1 << 10
#: So many anchors are multiplied with a lane at a time.
STRIP = 64
PIECE = "width int, n int, numbers binary, labels binary, kind string, cells binary, windows binary"


def _pieces(rows: DataFrame, by: list[str], order: str, windows: bool) -> DataFrame:
    """Rows (number, label, cells, and for anchors windows) of one width in pieces of BLOCK_ROWS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in by]
            ends = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1 if len(batch) else []
            edges = [0, *np.asarray(ends, int).tolist(), len(batch)]
            for start, stop in zip(edges, edges[1:]):
                for low in range(start, stop, BLOCK_ROWS):
                    part = batch.slice(low, min(stop, low + BLOCK_ROWS) - low)
                    n, width = len(part), part.column("width")[0].as_py()
                    cells = small(part.column("cells").flatten().to_numpy().reshape(n, width))
                    told = {c: part.column(c)[0].as_py() for c in by}
                    told |= {"n": n, "numbers": part.column("number").to_numpy().tobytes(), "labels": part.column("label").to_numpy().astype(np.int64).tobytes()}
                    told |= {"kind": cells.dtype.str, "cells": cells.tobytes()}
                    told["windows"] = part.column("windows").flatten().to_numpy().tobytes() if windows else b""
                    yield pa.RecordBatch.from_pylist([told], schema=pa.schema([(f, kinds[f]) for f in fields]))

    fields = [f.split()[0] for f in PIECE.split(", ")] + [c for c in by if c != "width"]
    types = {"int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    kinds = {f.split()[0]: types[f.split()[1]] for f in PIECE.split(", ")} | {c: pa.int32() for c in by}
    dealt = rows.repartition(*by).sortWithinPartitions(*by, order)
    return dealt.mapInArrow(run, PIECE + "".join(f", {c} int" for c in by if c != "width"))


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cells = np.frombuffer(row["cells"], np.dtype(row["kind"])).reshape(row["n"], row["width"]).astype(np.float64)
    return np.frombuffer(row["numbers"], np.int64), np.frombuffer(row["labels"], np.int64), cells


def _met(lanes: DataFrame, anchors: DataFrame, count: int, step, shape: str) -> DataFrame:
    """Anchor pieces stream by each lane; ``step`` gets an anchor piece and the lane's numbers, labels and cells."""
    rows = lanes.withColumn("kind_of", F.lit(0))
    asked = anchors.select("*", each(count).alias("lane")).withColumn("kind_of", F.lit(1))
    both = rows.unionByName(asked).repartition("lane", "width").sortWithinPartitions("lane", "width", "kind_of")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, joined = None, [], None
        for batch in batches:
            for place in range(len(batch)):
                row = batch.slice(place, 1).to_pylist()[0]
                if (row["lane"], row["width"]) != at:
                    at, held, joined = (row["lane"], row["width"]), [], None
                if row["kind_of"] == 0:
                    held.append(_unpacked(row))
                elif held:
                    if joined is None:
                        joined = tuple(np.concatenate(c) for c in zip(*held))
                    yield from step(row, *joined)

    return both.mapInArrow(run, shape)


def _best_of(scores: np.ndarray, fits: np.ndarray, numbers: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best fitting scores of each row, ties to the smaller number (columns are in that order)."""
    count = fits.sum(axis=1)
    masked = np.where(fits, scores, np.iinfo(np.int64).min)
    if scores.shape[1] > k:
        bound = np.partition(masked, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        fits = fits & ((scores >= bound[:, None]) | (count <= k)[:, None])
    i, j = np.nonzero(fits)
    order = np.lexsort((numbers[j], -scores[i, j], i))
    i, j = i[order], j[order]
    first = np.searchsorted(i, i)  # where the row begins
    near = np.arange(len(i)) - first < k
    return i[near], j[near]


def _window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score n with low * positive <= 100 * n <= high * positive."""
    whole, rest = np.divmod(positive, 100)
    return whole * low - (-(rest * low) // 100), whole * high + (rest * high) // 100


def mine(
    table: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id: str = "vec_id",
    label: Column | str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``low`` and ``high`` are the window's ends in hundredths of the positive's score; a
    positive with a score below zero has no window.
    """
    if not 0 <= low < high <= 100:
        raise ValueError("a window lies below its positive: 0 <= low < high <= 100")
    label = F.col(label) if isinstance(label, str) else label
    told = table.select(F.col(id).alias("id"), label.cast("long").alias("label"), integers(vector, scale).alias("cells"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    told = told.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & sound("cells"))
    once = materialise(told.groupBy("id", "label", "cells").agg(F.max("anchor").alias("anchor")), "rows")
    once = once.withColumn("width", F.size("cells"))
    # Numbers rise with ids, so they settle ties.
    rows = materialise(numbered(once, [F.col("id"), F.col("label"), F.xxhash64("cells")], "number"), "numbered")
    count = max(1, math.ceil(rows.count() / LANE_ROWS))
    lanes = materialise(_pieces(rows.withColumn("lane", lane("number", count)), ["lane", "width"], "number", False), "lanes")
    asked = rows.filter("anchor").withColumn("part", lane("number", max(1, math.ceil(count * LANE_ROWS / 100 / BLOCK_ROWS))))
    anchors = materialise(_pieces(asked, ["part", "width"], "number", False), "anchors").drop("part")

    def near(piece: dict, numbers: np.ndarray, labels: np.ndarray, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
        names, own, asked = _unpacked(piece)
        for at in range(0, len(names), STRIP):
            who = slice(at, at + STRIP)
            scores = products(asked[who], cells)
            fits = (own[who, None] == labels[None, :]) & (names[who, None] != numbers[None, :])
            i, j = _best_of(scores, fits, numbers, positives)
            yield pa.RecordBatch.from_arrays([pa.array(names[who][i]), pa.array(numbers[j]), pa.array(scores[i, j])], ["anchor", "row", "score"])

    order = W.partitionBy("anchor").orderBy(F.desc("score"), "row")
    pairs = _met(lanes, anchors, count, near, "anchor long, row long, score long")
    chosen = pairs.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives).drop("place")
    chosen = materialise(chosen, "positives")
    windows = chosen.groupBy("anchor").agg(F.array_distinct(F.sort_array(F.collect_list("score"), asc=False)).alias("windows"))
    pad = F.concat("windows", F.array_repeat(F.lit(-1).cast("long"), F.lit(positives) - F.size("windows")))
    opened = asked.join(windows.select(F.col("anchor").alias("number"), pad.alias("windows")), "number")
    opened = materialise(_pieces(opened, ["part", "width"], "number", True), "windows").drop("part")

    def inside(piece: dict, numbers: np.ndarray, labels: np.ndarray, cells: np.ndarray) -> Iterator[pa.RecordBatch]:
        names, own, asked = _unpacked(piece)
        scored = np.frombuffer(piece["windows"], np.int64).reshape(len(names), positives)
        for at in range(0, len(names), STRIP):
            who = slice(at, at + STRIP)
            scores = products(asked[who], cells)
            other, found = own[who, None] != labels[None, :], []
            for p in range(positives):
                least, most = _window(scored[who, p], low, high)
                fits = other & (scores >= least[:, None]) & (scores <= most[:, None]) & (scored[who, p] >= 0)[:, None]
                i, j = _best_of(scores, fits, numbers, negatives)
                found.append(i * len(numbers) + j)
            i, j = np.divmod(np.unique(np.concatenate(found)), len(numbers))
            yield pa.RecordBatch.from_arrays([pa.array(names[who][i]), pa.array(numbers[j]), pa.array(scores[i, j])], ["anchor", "row", "score"])

    fitting = _met(lanes, opened, count, inside, "anchor long, row long, score long")
    keys = chosen.withColumn("side", F.lit(0)).unionByName(fitting.withColumn("side", F.lit(1)))
    keys = keys.select("anchor", (-F.col("score")).alias("below"), "side", "row")
    # At one score positives come before negatives: a positive of score zero takes negatives of its own score.
    dealt = keys.repartition("anchor").sortWithinPartitions("anchor", "below", "side", "row")
    mined = materialise(dealt.mapInArrow(_opened(negatives, low, high), "anchor long, positive long, rank int, negative long, positive_score long, negative_score long"), "mined")
    names = rows.select("number", "id")
    for number, name in (("anchor", "anchor_id"), ("positive", "positive_id"), ("negative", "negative_id")):
        mined = mined.join(names.select(F.col("number").alias(number), F.col("id").alias(name)), number)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _opened(negatives: int, low: int, high: int):
    """The iterator over keys sorted by (anchor, descending score, side, row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, windows = None, []  # a window: the positive, its score, how many negatives it has
        for batch in batches:
            out: list[tuple] = []
            for anchor, below, side, row in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != at:
                    at, windows = anchor, []
                score = -below
                if side == 0:
                    if score >= 0:
                        windows.append([row, score, 0])
                    continue
                windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
                for w in windows:
                    if 100 * score <= high * w[1]:
                        w[2] += 1
                        out.append((anchor, w[0], w[2], row, w[1], score))
            names = ["anchor", "positive", "rank", "negative", "positive_score", "negative_score"]
            kinds = [pa.int32() if n == "rank" else pa.int64() for n in names]
            columns = list(zip(*out)) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run

"""Exact top-k inner products by elimination with a table of pivot distances.

Each vector has its distances to many pivots, one of them the origin. For a query q and a
row x the largest of |d(q, p) - d(x, p)| over the pivots p is a lower bound of d(q, x), and

    q * x = (|q|^2 + |x|^2 - d(q, x)^2) / 2

turns it into an upper bound of the score. No vector need be of unit length.

1. Vectors that are equal fold to one, with their k + 1 smallest ids (a query takes no more
   of them); queries with equal vectors are one query.
2. Rows and queries lie in blocks (``operators.blocks``) with the range of their distances to
   each pivot. A pair of blocks has a bound too, and a query block takes its best FIRST blocks
   first, which gives each query the k-th best score so far.
3. Only pairs of blocks whose bound reaches the least of those scores are formed. A task takes
   them in bound order, and the rows of a block in strips in bound order; a query leaves as
   soon as no bound that is left reaches its k-th best score, so nothing that could enter is
   skipped. The few that may enter are multiplied one by one, dense strips as a matrix product.

The query set is stated (``asked``), so rows meet queries in blocks, never as a cross join.
Where bounds exclude little (independent coordinates, many of them) the work is that of all
products; it stays exact.

Components become floor(scale * x) and scores are exact integers (clamped to a long).

Defined results: rows with a null id, a null vector, or a null or non-finite component (before
or after scaling) take no part; vectors are compared with those of their length only; rows
that repeat id and vector count once; rows that share an id only are different rows. Ties go
to the smaller id. An empty table, or no query, gives an empty result.
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

from framecat.llm.common import small_side
from framecat.operators import blocks
from framecat.operators.blocks import SINGLE, lengths, range_gap, unpacked
from framecat.session import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIRST, PER_LANE, STRIP = 4, 64, 128
#: A strip in which fewer of the products than this share can matter is multiplied pair by pair.
SPARSE = 1 / 16
NONE = np.iinfo(np.int64).min + 1


def integers(vector: Column | str, scale: int) -> Column:
    """floor(scale * x) of every component, as doubles (which hold them exactly)."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    return F.transform(scaled, lambda y: F.when(F.abs(y) < float(2**53), F.floor(y).cast("double")).otherwise(y))


def sound(cells: Column | str) -> Column:
    """No null vector, no component that is null or not finite."""
    fits = F.forall(cells, lambda y: F.coalesce(F.abs(y) < float("inf"), F.lit(False)))
    return F.coalesce(fits, F.lit(False))


def _largest(a: np.ndarray, b: np.ndarray) -> float:
    """What no sum of products of their rows exceeds; sums below 2^53 are exact in doubles."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows as longs."""
    if _largest(a, b) < 2**53:
        return (a @ b.T).astype(np.int64)
    one, two = (np.array([int(v) for v in m.ravel()], object).reshape(m.shape) for m in (a, b))
    return np.clip(one @ two.T, NONE + 1, 2**63 - 1).astype(np.int64)


def pair_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for row i of a and row i of b."""
    if _largest(a, b) < 2**53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    return np.array([products(x[None], y[None])[0, 0] for x, y in zip(a, b)], np.int64)


def upper_bounds(away_q: np.ndarray, away_x: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of queries and rows, from their pivot distances (the first pivot is the origin)."""
    gap = np.zeros((len(away_q), len(away_x)))
    for p in range(away_q.shape[1]):
        np.maximum(gap, np.abs(away_q[:, p, None] - away_x[None, :, p]), out=gap)
    far = np.maximum(away_q.max(axis=1, initial=0.0)[:, None], away_x.max(axis=1, initial=0.0)[None, :])
    gap = np.maximum(gap - 2 * SINGLE * far, 0.0)
    return _bound(away_q[:, 0, None], away_x[None, :, 0], gap)


def _bound(long_q: np.ndarray, long_x: np.ndarray, gap: np.ndarray) -> np.ndarray:
    squares = (lengths(long_q) ** 2 + lengths(long_x) ** 2) * (1 + 4 * SINGLE)
    return (squares - gap**2) / 2 + 1


def block_cost(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The negated upper bound of the scores between one block and each of others."""
    return -_bound(high[0], highs[:, 0], range_gap(low, high, lows, highs))


class Best:
    """The best scores of each query so far, ties to the smaller key."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.scores = np.full((queries, k), NONE)
        self.keys = np.full((queries, k), np.iinfo(np.int64).max)
        self.floor = np.full(queries, NONE) if floor is None else floor

    def least(self) -> np.ndarray:
        """What a score has to reach to matter."""
        return np.maximum(self.floor, self.scores[:, -1])

    def take(self, who: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """Rows of scores (NONE for those not evaluated) and keys for the queries ``who``."""
        new = scores >= np.maximum(self.least()[who][:, None], NONE + 1)
        some = np.flatnonzero(new.any(axis=1))
        if not len(some):
            return
        at = who[some]
        scores = np.concatenate([self.scores[at], np.where(new[some], scores[some], NONE)], axis=1)
        keys = np.concatenate([self.keys[at], np.broadcast_to(keys, new.shape)[some]], axis=1)
        for by in (lambda: keys, lambda: -scores):  # stable: by score, then by key
            order = np.argsort(by(), axis=1, kind="stable")
            scores, keys = np.take_along_axis(scores, order, axis=1), np.take_along_axis(keys, order, axis=1)
        self.scores[at], self.keys[at] = scores[:, : self.scores.shape[1]], keys[:, : self.keys.shape[1]]


def search(best: Best, queries: np.ndarray, away_q: np.ndarray, keys: np.ndarray, rows: np.ndarray, away_x: np.ndarray) -> int:
    """Takes the rows of one block in bound order until no query can gain; returns how many products it made."""
    bound, made = upper_bounds(away_q, away_x), 0
    order = np.argsort(-bound.max(axis=0), kind="stable")
    bound = bound[:, order]
    left = np.maximum.accumulate(bound[:, ::-1], axis=1)[:, ::-1]  # the best bound from a place on
    for low in range(0, len(order), STRIP):
        least = best.least()
        who = np.flatnonzero(left[:, low] >= least)
        if not len(who):
            break
        at = order[low : low + STRIP]
        fits = bound[who, low : low + STRIP] >= least[who][:, None]
        if fits.mean() >= SPARSE:
            scores = products(queries[who], rows[at])
            made += scores.size
        else:
            scores = np.full(fits.shape, NONE)
            i, j = np.nonzero(fits)
            scores[i, j] = pair_products(queries[who[i]], rows[at[j]])
            made += len(i)
        best.take(who, scores, keys[at])
    return made


def top_k(table: DataFrame, asked: Column, k: int = 20, scale: int = 64, id: str = "vec_id", vector: str = "embedding", block_rows: int = blocks.BLOCK_ROWS) -> DataFrame:
    """query_id, rank, id, score: for every row that is asked the k other rows with the highest scores."""
    told = table.select(F.col(id).alias("id"), integers(vector, scale).alias("cells"), F.coalesce(asked, F.lit(False)).alias("asked"))
    told = told.filter(F.col("id").isNotNull() & sound("cells"))
    rows = materialise(told.groupBy("id", "cells").agg(F.max("asked").alias("asked")), "rows")
    # A limit per group is applied before the shuffle, so a large group of copies is never gathered.
    few = W.partitionBy("cells").orderBy("id")
    kept = materialise(rows.select("id", "cells", F.row_number().over(few).alias("place")).filter(F.col("place") <= k + 1), "kept")
    firsts = kept.filter("place = 1").select("id", "cells", F.xxhash64("cells").alias("tie"))
    placed = firsts.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").drop("tie")
    # Keys rise with the smallest id of the vector: they settle ties.
    vectors = materialise(placed.withColumn("key", F.monotonically_increasing_id()), "vectors")
    more = kept.filter("place > 1").join(vectors.select("key", "cells"), "cells").select("key", "id")
    names = materialise(vectors.select("key", "id").unionByName(more), "names")
    queries = materialise(rows.filter("asked").join(vectors.select("key", "cells"), "cells").select(F.col("id").alias("query_id"), "key"), "queries")
    questions = vectors.join(queries.select("key").distinct(), "key", "left_semi")

    total = vectors.count()
    chosen = blocks.sampled_pivots(vectors, "cells", "key", blocks.pivot_count(total, block_rows))
    pivots = table.sparkSession.sparkContext.broadcast(np.concatenate([np.zeros((1, chosen.shape[1])), chosen]))
    there = blocks.blocked(vectors, pivots, "key", "cells", "row-blocks", block_rows, total)
    here = blocks.blocked(questions, pivots, "key", "cells", "query-blocks", block_rows)
    pairs = blocks.block_pairs(here.withColumn("most", F.lit(float("inf"))), there, block_cost)
    best_first = W.partitionBy("left").orderBy("cost", "right")
    first = pairs.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= FIRST).drop("place")

    def least(head: dict, partners: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        _, queries, away = unpacked(head)
        best = Best(len(queries), k + 1)
        for row in partners:
            search(best, queries, away, *unpacked(row))
        floor = best.least()
        yield pa.RecordBatch.from_pylist([{"block": head["block"], "floor": floor.tobytes(), "most": -float(floor.min())}])

    floors = materialise(blocks.streamed(first, here, there, 1, least, "block long, floor binary, most double"), "floors")
    wanted = pairs.join(floors.select(F.col("block").alias("left"), "most"), "left").filter("cost <= most").drop("most")

    def all_of(head: dict, partners: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        names, queries, away = unpacked(head)
        best = Best(len(queries), k + 1, np.frombuffer(head["floor"], np.int64))
        for row in partners:
            if row["cost"] > -float(best.least().min()):
                break  # no later block has a better bound
            search(best, queries, away, *unpacked(row))
        i, j = np.nonzero(best.scores > NONE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[i]), pa.array(best.keys[i, j]), pa.array(best.scores[i, j])], ["query_key", "key", "score"]
        )

    lanes = max(1, math.ceil(there.count() / PER_LANE))
    named = here.join(floors.select("block", "floor"), "block")
    local = blocks.streamed(wanted, named, there, lanes, all_of, "query_key long, key long, score long")
    order = W.partitionBy("query_key").orderBy(F.desc("score"), "key")
    best = materialise(local.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1), "best")
    entry = F.struct((-F.col("score")).alias("order"), "id", "key")
    by_id = W.partitionBy("query_key").orderBy(F.desc("score"), "id", "key")
    found = best.join(small_side(names), "key").select("query_key", "score", "id", "key", F.row_number().over(by_id).alias("place"))
    lists = found.filter(F.col("place") <= k + 1).groupBy("query_key").agg(F.sort_array(F.collect_list(entry)).alias("list"))
    told = queries.join(lists, F.col("key") == F.col("query_key")).select(
        "query_id",
        F.posexplode(F.slice(F.filter("list", lambda e: (e["key"] != F.col("query_key")) | (e["id"] != F.col("query_id"))), 1, k)).alias("at", "e"),
    )
    return told.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.id").alias(id), (-F.col("e.order")).alias("score"))

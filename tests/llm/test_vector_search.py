"""Exact top-k by pivots and hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from framecat.llm import hard_negatives, pivot_topk

SCHEMA = "vec_id long, embedding array<double>, label int, id string, cells int, score string, key int"


def frame(spark, rows):
    """Rows (id, vector, label) with further columns whose names the operators use too."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(3)


def usable(rows, scale):
    """Different rows that take part, components made integers."""
    out = {}
    for i, v, label in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v):
            out[(i, label, tuple(int(math.floor(scale * x)) for x in v))] = None
    return list(out)


def product(a, b):
    return max(-(2**63) + 2, min(2**63 - 1, sum(x * y for x, y in zip(a, b))))


def brute_top(rows, every, k, scale=64):
    told = {(i, cells): None for i, _, cells in usable(rows, scale)}
    out = []
    for i, q in told:
        if i % every:
            continue
        found = sorted((-product(q, x), j) for j, x in told if len(x) == len(q) and (j, x) != (i, q))[:k]
        out += [(i, place + 1, j, -s) for place, (s, j) in enumerate(found)]
    return sorted(out)


def brute_mined(rows, every, scale=256):
    told, out = usable([r for r in rows if r[2] is not None], scale), []
    for i, label, q in told:
        if i % every:
            continue
        scored = sorted((-product(q, x), j, l) for j, l, x in told if len(x) == len(q) and (j, l, x) != (i, label, q))
        for s, j, _ in [r for r in scored if r[2] == label][:5]:
            near = [r for r in scored if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s][:10]
            out += [(i, j, place + 1, n, -s, -m) for place, (m, n, _) in enumerate(near)]
    return sorted(out)


def clusters(n, width=6, seed=1):
    """Clusters of several sizes, a third of the rows copies of one vector, many equal scores."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width)) * rng.choice([0.2, 1, 6], size=(9, 1))
    m = centres[rng.integers(0, 9, n)] + rng.normal(scale=0.05, size=(n, width))
    m[rng.permutation(n)[: n // 3]] = m[0]
    m[rng.permutation(n)[: n // 5]] = np.round(m[: n // 5] * 4) / 4
    return [(i, m[i].tolist(), int(rng.integers(0, 4)) if i % 9 else None) for i in range(n)]


ODD = [
    (None, [1.0] * 6, 1),
    (1000, None, 1),
    (1001, [], 1),
    (1100, [], 2),
    (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
    (1003, [float("nan")] * 6, 1),
    (1004, [float("inf")] * 6, 2),
    (1020, [0.5] * 3, 1),
    (1021, [0.25, -1.0, 2.0], 2),
    (1040, [0.0] * 6, 1),
    (1041, [0.0] * 6, 1),
    (-20, [-0.3, 0.7, 0.1, 0.2, 0.3, -0.9], 1),
    (-100, [-0.3, 0.7, 0.1, 0.2, 0.3, -0.9], 2),
    (0, [0.1] * 6, 3),  # shares its id with another row
    (20, [0.1] * 6, 3),
    (20, [0.1] * 6, 3),  # a repeated row
]


def top(spark, rows, every=20, k=20, **kind):
    found = pivot_topk.top_k(frame(spark, rows), F.col("vec_id") % every == 0, k, **kind)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_top_k(spark, block_rows):
    rows = clusters(300) + ODD
    assert top(spark, rows, 20, 7, block_rows=block_rows) == brute_top(rows, 20, 7)


def test_top_k_of_fewer_rows_and_of_none(spark):
    rows = clusters(12)
    assert top(spark, rows, 5) == brute_top(rows, 5, 20)
    assert top(spark, [r for r in rows if r[0] % 5]) == []
    assert top(spark, []) == []


def test_top_k_of_numbers_beyond_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=4) * 10.0 ** (2 * (i % 9))).tolist(), 0) for i in range(60)]
    rows += [(100, [1e300] * 4, 0), (101, [-1e300] * 4, 0)]
    assert top(spark, rows, 10, 5) == brute_top(rows, 10, 5)


def test_bounds_stop_the_search(spark):
    """Most products are never made where vectors lie in clusters, and none that matters is left out."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 8)) * 20
    rows = np.floor(64 * (centres[rng.integers(0, 40, 4000)] + rng.normal(scale=0.2, size=(4000, 8))))
    queries = rows[:50]
    pivots = np.concatenate([np.zeros((1, 8)), 64 * centres[:32]])
    away = lambda m: np.linalg.norm(m[:, None] - pivots[None], axis=2)
    best, made = pivot_topk.Best(len(queries), 10), 0
    for low in range(0, 4000, 1000):
        part = slice(low, low + 1000)
        made += pivot_topk.search(best, queries, away(queries), np.arange(low, low + 1000), rows[part], away(rows[part]))
    assert (best.scores == -np.sort(-(queries @ rows.T), axis=1)[:, :10]).all()
    assert made < 0.5 * 50 * 4000
    bound = pivot_topk.upper_bounds(away(queries), away(rows))
    assert (bound >= queries @ rows.T).all()


def mined(spark, rows, every=100, **kind):
    found = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % every == 0, **kind)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("lane_rows, block_rows", [(1 << 15, 1 << 10), (40, 7)])
def test_hard_negatives(spark, monkeypatch, lane_rows, block_rows):
    monkeypatch.setattr(hard_negatives, "LANE_ROWS", lane_rows)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block_rows)
    rows = clusters(400, seed=2) + ODD
    want = brute_mined(rows, 10)
    assert mined(spark, rows, 10) == want and len(want) > 300
    assert any(r[4] == 0 for r in want)  # positives of score zero take negatives of score zero


def test_hard_negatives_of_odd_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(0, [1.0], 1), (2, [1.0], 2)]) == []  # no positive
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 9.0], 2), (3, [-0.5, 9.0], 2)]
    assert mined(spark, rows) == brute_mined(rows, 100) == [(0, 1, 1, 2, 65536, 32768)]
    with pytest.raises(ValueError):
        hard_negatives.mine(frame(spark, rows), F.col("vec_id") == 0, low=90, high=30)

"""Scores: the unigram base exactly, the tree as a distribution, and held-out gain."""

import collections
import math
import random
import zlib

import numpy as np
import pytest

from framecat.llm import suffix_tree

SCHEMA = "doc_id long, text string, score double, row int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, 1) for i, t in rows], SCHEMA).repartition(3)


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\x0b\x0c\r":
        text = text.replace(white, " ")
    return [w for w in text.split(" ") if w]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1


def corpus(seed=1):
    rng = random.Random(seed)
    follow = {w: [rng.choice("abcdefgh") for _ in range(2)] for w in "abcdefgh"}
    rows = [(None, None), (None, "A b"), (1, ""), (2, "É é"), (2, "É é"), (3, "x" * 50000)]
    for i in range(4, 400):
        text = [rng.choice("abcdefgh")]
        for _ in range(rng.randrange(60)):
            text.append(rng.choice(follow[text[-1]]) if rng.random() < 0.8 else f"r{rng.randrange(500)}" if rng.random() < 0.3 else rng.choice("abcdefgh"))
            if text[-1] not in follow:
                text.append("a")
        rows.append((i, " ".join(text)))
    return rows


def base(rows):
    counts = collections.Counter()
    for i, t in rows:
        if not held(i):
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = collections.Counter()
    for i, t in rows:
        tokens = [*words(t), None]
        score = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        out[(i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, round(score, 6))] += 1
    return out


@pytest.mark.parametrize("frequent", [1 << 16, 12])
def test_base_and_gain(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffix_tree, "FREQUENT", frequent)
    monkeypatch.setattr(suffix_tree, "HELD_PER_TASK", 50)
    rows = corpus()
    got = suffix_tree.score_texts(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == base(rows)
    assert all(math.isfinite(r.score) for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > 0.8 * sum(r.base_score for r in out)


def test_states_are_distributions(spark):
    rows = [(i, t) for i, t in corpus() if not held(i)]
    tree, _ = suffix_tree.train(frame(spark, rows).selectExpr("coalesce(text, '') as text"))
    assert len(tree.one.states) and np.exp(np.delete(tree.root, suffix_tree.START)).sum() == pytest.approx(1, abs=1e-3)
    symbols = np.array([s for s in range(len(tree.root)) if s != suffix_tree.START])
    for level, contexts in ((tree.one, tree.one.states), (tree.two, tree.two.states)):
        for context in contexts[:50]:
            below = tree.root[symbols] if level is tree.one else tree.suffix_logs(np.full(len(symbols), context & ((1 << suffix_tree.BITS) - 1)), symbols)
            assert np.exp(level.score(np.full(len(symbols), context), symbols, below)).sum() == pytest.approx(1, abs=2e-3)


def test_no_training_rows(spark):
    assert suffix_tree.score_texts(frame(spark, [])).count() == 0
    i = next(i for i in range(100) if held(i))
    (row,) = suffix_tree.score_texts(frame(spark, [(i, "a b")])).collect()
    assert row.train_tokens == 0 and row.base_score == pytest.approx(0) and row.score == pytest.approx(0)

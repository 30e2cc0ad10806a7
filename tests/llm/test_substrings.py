"""Repeated substrings against brute force."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from framecat.llm import bwt, substrings

SCHEMA = "doc_id long, text string, raw string, start int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(3)


def brute(rows, least):
    data = [(i, (t or "").encode()) for i, t in rows]
    times = collections.Counter(d[a : a + least] for _, d in data for a in range(len(d) - least + 1))
    out = []
    for i, d in data:
        gone = bytearray(len(d))
        for a in range(len(d) - least + 1):
            if times[d[a : a + least]] > 1:
                gone[a : a + least] = b"\x01" * least
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((i, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


def got(docs, least, crowd=substrings.CROWD):
    told = substrings.remove_repeats(docs, least, crowd=crowd)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["begin"])
    return collections.Counter(map(tuple, told.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect()))


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, rows = text(40), [(None, None), (0, ""), (1, "a" * 500), (2, "short"), (3, "ab" * 150), (4, "ab" * 150)]
    for i in range(5, 60):
        kind = rng.randrange(5)
        if kind == 0:
            rows.append((i, text(20) + passage + text(20)))
        elif kind == 1 and rows[-1][1]:
            rows += [(i, rows[-1][1]), (i, rows[-1][1])]
        elif kind == 2 and rows[-1][1]:
            old = rows[-1][1]
            at = rng.randrange(len(old))
            rows.append((i, old[:at] + "#" + old[at:]))
        else:
            rows.append((i, text(rng.choice([3, 60, 150]))))
    return [*rows, (None, passage), (None, "x" + passage)]


@pytest.mark.parametrize(("least", "crowd", "part"), [(200, 2000, 1 << 21), (64, 3, 100), (50, 2000, 333)])
def test_remove_repeats(spark, monkeypatch, least, crowd, part):
    monkeypatch.setattr(substrings, "PART_BYTES", part)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 5000)
    rows = corpus(least)
    assert got(frame(spark, rows), least, crowd) == brute(rows, least)


def test_a_passage_in_every_third_document(spark):
    """Its borders are crowded anchors: contexts that share one side with all others and nothing else."""
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, rows = noise(500), []
    for i in range(150):
        text = noise(300) + passage + noise(300) if i % 3 == 0 else noise(400)
        rows += [(i, text)] * (2 if i % 10 == 0 else 1)  # some rows repeat
    assert got(frame(spark, rows), 200, 8) == brute(rows, 200)


def test_empty(spark):
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_interval_expansion():
    rng = random.Random(0)
    for round_ in range(200):
        letters = b"ab" if round_ % 2 else b"abcd\x00\xff"
        texts = [bytes(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(rng.randrange(1, 6))]
        if round_ % 3 == 0:
            texts += [texts[0] + b"x", texts[0]]
        for least in (1, 2, 5, 20):
            times = collections.Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
            want = [[i for i in range(len(t) - least + 1) if times[t[i : i + least]] > 1] for t in texts]
            assert [x.tolist() for x in bwt.repeats(texts, least)] == want

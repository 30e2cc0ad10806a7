"""Kneser-Ney against a direct computation, and both classifiers on held-out rows."""

import collections
import math
import random

import numpy as np
import pytest

from framecat.llm import kneser_ney, severity

SCHEMA = "doc_id long, text string, lang string, quality2 int, raw string"


def frame(spark, rows, lang="en"):
    return spark.createDataFrame([(i, t, lang, 1, "x") for i, t in rows], SCHEMA).repartition(3)


def modified_kneser_ney(texts, symbols):
    """The last symbol's probability given the ones before, as a function of a tuple of symbols."""
    s, n = kneser_ney.SYMBOLS, kneser_ney.ORDER
    tables = [collections.Counter() for _ in range(n)]
    for t in texts:
        ids = [0] * (n - 1) + [int(symbols[ord(c)]) if ord(c) < len(symbols) else 1 for c in t]
        for i in range(n - 1, len(ids)):
            tables[-1][tuple(ids[i - n + 1 : i + 1])] += 1
    for k in range(n - 2, -1, -1):
        for g in tables[k + 1]:
            tables[k][g[1:]] += 1
    cut = []
    for t in tables:
        m = [sum(c == k for c in t.values()) for k in (1, 2, 3, 4)]
        y = m[0] / (m[0] + 2 * m[1]) if m[0] else 0.0
        own = [k - (k + 1) * y * m[k] / m[k - 1] if m[k - 1] else 0.5 * k for k in (1, 2, 3)]
        cut.append([min(max(d, 0.01), k - 0.01) for k, d in zip((1, 2, 3), own)])

    def p(gram):
        if not gram:
            return 1 / (s - 1)
        t, d = tables[len(gram) - 1], cut[len(gram) - 1]
        after = {g: c for g, c in t.items() if g[:-1] == gram[:-1]}
        if not after:
            return p(gram[1:])
        total, c = sum(after.values()), t.get(gram, 0)
        left = sum(d[min(x, 3) - 1] for x in after.values())
        return (c - d[min(c, 3) - 1] if c else 0) / total + left / total * p(gram[1:])

    return p


def test_kneser_ney(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "PART_CHARS", 50)
    rng = random.Random(2)
    texts = ["".join(rng.choice("aaabbc d\né") for _ in range(rng.randrange(120))) for _ in range(12)] + ["", "🙂a"]
    docs = frame(spark, list(enumerate(texts))).select("text")
    symbols = kneser_ney.alphabet(docs)
    logs = kneser_ney.train(docs, symbols)
    p = modified_kneser_ney(texts, symbols)
    s, n = kneser_ney.SYMBOLS, kneser_ney.ORDER
    grams = [tuple(rng.choice([0, 1, 2, 3, 4, 5, 6, 9]) for _ in range(n - 1)) + (rng.choice([1, 2, 3, 4, 5]),) for _ in range(300)]
    for gram in grams:
        assert math.exp(logs[sum(x * s**k for k, x in enumerate(reversed(gram)))]) == pytest.approx(p(gram), rel=1e-4)
    assert np.exp(logs.astype(np.float64)).reshape(-1, s)[:200, 1:].sum(axis=1) == pytest.approx(np.ones(200), abs=1e-3)


def test_classify(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    odd = docs.unionByName(frame(spark, [(None, None), (-5, "")], None).selectExpr("doc_id", "text", "lang", "raw as source", "0L as n_chars"))
    told = kneser_ney.classify(odd, labels).collect()
    assert len(told) == docs.count() + 2 and not any(r.kept for r in told if not r.n_symbols)
    by_id = {r.doc_id: r for r in told}
    label = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([by_id[i].kept for i, q in label.items() if q == 1]) > 0.95
    assert np.mean([not by_id[i].kept for i, q in label.items() if q == 0]) > 0.5
    assert kneser_ney.classify(docs.limit(0), labels).count() == 0
    assert not any(r.kept for r in kneser_ney.classify(docs, labels.limit(0)).collect())


def test_rare_code_points_share_their_symbol(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "LETTERS", 3)
    monkeypatch.setattr(kneser_ney, "PART_CHARS", 7)
    texts = ["aabbcc" * 5, "abcabc\u0436\u0436\u0436\u0434", "aab\U0001f642\u0436", "", "abc" * 4]
    docs = frame(spark, list(enumerate(texts)))
    counts = kneser_ney.code_points(docs.select("text"))
    symbols = kneser_ney.alphabet(docs, counts)
    rare = kneser_ney.rare_shares(counts, symbols)
    held = collections.Counter(c for t in texts for c in t if c not in "abc")
    base = sum(held.values()) + 0.5 * (len(held) + 1)
    for c in "abc\u0436\u0434\U0001f642xy":
        want = 0.0 if c in "abc" else math.log((held[c] + 0.5) / base)
        assert rare[ord(c)] == pytest.approx(want, abs=1e-5)
    monkeypatch.undo()
    logs = kneser_ney.train(docs.select("text"), symbols)
    monkeypatch.setattr(kneser_ney, "PART_CHARS", 7)
    told = kneser_ney.perplexities(docs, symbols, logs, rare, "doc_id", "text", "lang").collect()
    s = kneser_ney.SYMBOLS
    for r in told:
        text = texts[r.doc_id]
        ids = [0, 0, 0] + [int(symbols[ord(c)]) if ord(c) < len(symbols) else 1 for c in text]
        total = sum(logs[((ids[i] * s + ids[i + 1]) * s + ids[i + 2]) * s + ids[i + 3]] + rare[ord(c)] for i, c in enumerate(text))
        assert r.perplexity == (pytest.approx(math.exp(-total / len(text)), rel=1e-4) if text else None)


def test_script_of_few_texts_is_judged(spark):
    """Gibberish in a script outside the alphabet is told from its prose by the shares of its letters."""
    rng = random.Random(4)
    letters = [chr(0x430 + k) for k in range(32)]
    word = lambda w: "".join(rng.choices(letters, [2.0 ** -(k / 2) for k in range(32)], k=w))
    prose = [" ".join(word(5) for _ in range(60)) for _ in range(4)]
    odd = "".join(rng.choice(letters[20:]) + rng.choice(letters[20:]) + " " for _ in range(150))
    latin = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ01", k=5)) for _ in range(300)) for _ in range(8)]
    texts = latin + prose
    docs = frame(spark, [*enumerate(texts), (90, odd)])
    labels = spark.createDataFrame([(i, 1) for i in range(len(texts))], "doc_id long, quality int")
    told = {r.doc_id: r.perplexity for r in kneser_ney.classify(docs, labels).collect()}
    assert told[90] > 1.5 * max(told[i] for i in range(8, 12))


def severity_brute(rows, labels):
    """Features, their values by row and the grades, of rows (id, text) with labels {id: toxic}, halves {id: half}."""
    label, half = labels
    found = {}
    for i, text in rows:
        words = [w.strip(severity.EDGES.decode()) for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()]
        traits = collections.Counter(w for w in words if w)
        for w in words:
            traits.update(w[:k] + "*" for k in severity.BEGINNINGS if len(w) > k)
        found[i] = traits, len(words)

    def errors(word, ids):
        a = sum(word in found[i][0] for i in ids if label[i])
        b = sum(word in found[i][0] for i in ids if not label[i])
        yes, no = sum(label[i] for i in ids), sum(not label[i] for i in ids)
        odds = math.log((a + 0.5) / (yes - a + 0.5)) - math.log((b + 0.5) / (no - b + 0.5))
        return a + b, odds, odds / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))

    every = {w for t, _ in found.values() for w in t}
    told = {w: errors(w, list(label)) for w in every}
    usual = [w for w in every if told[w][0] >= severity.LEAST_ROWS]
    features = [w for w in usual if abs(told[w][2]) >= severity.LEAST_ERRORS]
    features.sort(key=lambda w: (-round(abs(told[w][2]), 9), w))
    strong = []
    for h in (0, 1):
        ids = [i for i in label if half[i] == h]
        by = {w: errors(w, ids) for w in usual if not w.endswith("*")}
        strong.append({w for w, x in by.items() if x[1] >= severity.STRONG_ODDS and x[2] >= severity.STRONG_ERRORS})
    density = {i: sum(n for w, n in found[i][0].items() if w in strong[1 - half[i]]) / max(1, found[i][1]) for i in label}
    ranked = sorted(density[i] for i in label if label[i])
    cuts = np.quantile(ranked, [1 / 3, 2 / 3])
    grades = {i: 1 + sum(density[i] > c for c in cuts) if label[i] else 0 for i in label}
    return features, found, grades


def test_severity_features_and_grades(spark, monkeypatch):
    monkeypatch.setattr(severity, "STRONG_ERRORS", 3.0)
    monkeypatch.setattr(severity, "STRONG_ODDS", 2.0)
    rng = random.Random(8)
    plain, bad = [f"w{k}x" for k in range(40)], ["Vile!", "rotten", "nasty,"]
    rows, label = [], {}
    for i in range(160):
        label[i] = int(i % 4 == 0)
        dirty = rng.choice([0.05, 0.2, 0.5]) if label[i] else 0
        rows.append((i, " ".join(rng.choice(bad) if rng.random() < dirty else rng.choice(plain) for _ in range(rng.randrange(20, 90)))))
    ids = spark.createDataFrame([(i,) for i in label], "doc_id long")
    half = {r[0]: r[1] for r in ids.selectExpr("doc_id", "pmod(xxhash64(1, doc_id), 2)").collect()}
    seen = {}
    kept = lambda lengths, column, amount, grades, size: seen.update(n=lengths, c=column, v=amount, g=grades) or (np.zeros(size), np.arange(3.0))
    monkeypatch.setattr(severity, "fit_flat", kept)
    model = severity.train(frame(spark, rows), spark.createDataFrame(list(label.items()), "doc_id long, toxic int"))
    features, found, grades = severity_brute(rows, (label, half))
    assert sorted(model.features) == sorted(features) and {"vile", "rotten", "nasty"} <= set(features)
    place = model.features
    want = sorted(
        (grades[i], sorted((place[w], round(severity.SCALE * math.sqrt(n / found[i][1]), 6)) for w, n in found[i][0].items() if w in place)) for i in label
    )
    cut = np.cumsum(seen["n"])[:-1]
    told = zip(seen["g"], np.split(seen["c"], cut), np.split(seen["v"], cut))
    assert sorted((int(g), [(int(k), round(float(v), 6)) for k, v in zip(ks, vs)]) for g, ks, vs in told) == want
    assert set(grades.values()) == {0, 1, 2, 3}


def test_severity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = severity.train(docs, labels.filter("doc_id % 3 <> 0"))
    assert (np.diff(model.thresholds) > 0).all()
    told = {r.doc_id: r for r in severity.severities(docs, model).collect()}
    out = [(told[r.doc_id], r.toxic) for r in labels.filter("doc_id % 3 = 0").collect()]
    assert np.mean([t.toxic == bool(y) for t, y in out]) > 0.97
    assert min(np.mean([t.toxic for t, y in out if y]), np.mean([not t.toxic for t, y in out if not y])) > 0.8
    assert {t.grade for t in told.values()} == {0, 1, 2, 3}


def test_severity_of_odd_tables(spark):
    rows = frame(spark, [(None, None), (1, ""), (2, "a b"), (2, "a b"), (3, "x" * 90000)])
    labels = spark.createDataFrame([(1, 1, None), (2, 1, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert severity.train(rows, labels) is None
    assert [r.severity for r in severity.severities(rows, None).collect()] == [0.0] * 5
    assert severity.severities(rows.limit(0), None).count() == 0


def test_fit_orders_grades():
    rng = np.random.default_rng(3)
    rows = [sorted(rng.choice(6, rng.integers(0, 4), replace=False).tolist()) for _ in range(600)]
    grades = np.array([min(3, sum(c < 3 for c in r)) for r in rows])
    weights, thresholds = severity.fit(rows, grades, 6)
    model = severity.Model({}, weights, thresholds)
    expected = model.above(rows).sum(axis=1)
    assert (np.diff(thresholds) > 0).all()
    means = [expected[grades == g].mean() for g in range(4) if (grades == g).any()]
    assert all(a < b for a, b in zip(means, means[1:])) and abs(expected - grades).mean() < 0.2

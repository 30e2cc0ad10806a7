"""Findings of the round on models of which a part was left out."""

import collections
import math
import random
import zlib

import pytest

from framecat.llm import kneser_ney, suffix_tree

SCHEMA = "doc_id long, text string, lang string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA).repartition(3)


def whole_kneser_ney(texts):
    """The probability of a character after those before it, by counting; '' begins a text."""
    n = kneser_ney.ORDER
    tables = [collections.Counter() for _ in range(n)]
    for t in texts:
        chars = [""] * (n - 1) + list(t)
        tables[-1].update(tuple(chars[i - n + 1 : i + 1]) for i in range(n - 1, len(chars)))
    for k in range(n - 2, -1, -1):
        tables[k].update(g[1:] for g in tables[k + 1])
    cut = []
    for t in tables:
        m = [sum(c == k for c in t.values()) for k in (1, 2, 3, 4)]
        y = m[0] / (m[0] + 2 * m[1]) if m[0] else 0.0
        own = [k - (k + 1) * y * m[k] / m[k - 1] if m[k - 1] else 0.5 * k for k in (1, 2, 3)]
        cut.append([min(max(d, 0.01), k - 0.01) for k, d in zip((1, 2, 3), own)])

    def p(gram):
        if not gram:
            return 1 / (len(tables[0]) + 1)
        t, d = tables[len(gram) - 1], cut[len(gram) - 1]
        after = {g: c for g, c in t.items() if g[:-1] == gram[:-1]}
        if not after:
            return p(gram[1:])
        total, c = sum(after.values()), t.get(gram, 0)
        return (c - d[min(c, 3) - 1] if c else 0) / total + sum(d[min(x, 3) - 1] for x in after.values()) / total * p(gram[1:])

    return p


@pytest.mark.parametrize("chars", [1 << 20, 7, 2])
def test_every_code_point_is_in_the_model(spark, monkeypatch, chars):
    """Before, code points beyond the 54 most frequent were one symbol, in contexts too."""
    monkeypatch.setattr(kneser_ney, "PART_CHARS", chars)
    rng = random.Random(3)
    letters = [chr(0x430 + k) for k in range(32)] + [chr(0x4E00 + k) for k in range(60)] + ["\U0001f642", "\0", "a"]
    trusted = ["".join(rng.choice(letters[low : low + 6]) for low in rng.choices(range(0, 90, 6), k=1) * rng.randrange(40)) for _ in range(30)] + ["", "a"]
    others = ["", "zz", "\U0001f643a", trusted[0][::-1], "".join(rng.choices(letters, k=50))]
    docs = frame(spark, trusted + others)
    labels = spark.createDataFrame([(i, 1) for i in range(len(trusted))], "doc_id long, quality int")
    told = kneser_ney.classify(docs, labels).collect()
    p = whole_kneser_ney(trusted)
    assert len(told) == len(trusted + others)
    for r in told:
        text = (trusted + others)[r.doc_id]
        chars_ = [""] * (kneser_ney.ORDER - 1) + list(text)
        total = sum(math.log(p(tuple(chars_[i : i + kneser_ney.ORDER]))) for i in range(len(text)))
        assert r.perplexity == (pytest.approx(math.exp(-total / len(text)), rel=1e-4) if text else None)


def test_more_letters_than_a_number_holds(monkeypatch):
    """N-grams of parts with too many different code points to number them are taken as they are."""
    import numpy as np

    held = [(0, "abcab一", 0), (1, "abc", 5)]
    ids, ends, sizes = kneser_ney._symbols(held)
    few = kneser_ney._distinct(ids, ends)
    many = np.concatenate((ids, np.arange(1, 70_000)))
    most = kneser_ney._distinct(many, ends)
    assert sizes.tolist() == [6, 0] and len(most[3]) == len(ends)
    assert (few[0][few[2]] == most[0]).all() and (few[1][few[2]] == most[1]).all()


def test_suffix_tree_keeps_all_states_and_words(spark, monkeypatch):
    """Before, words, contexts of two and listed probabilities were the most frequent or telling up to a bound."""
    for name, value in (("FREQUENT", 3), ("STATES", 2), ("ENTRIES", 2), ("MIN_COUNT", 4), ("HELD_PER_TASK", 20), ("CHUNK", 90), ("SHARD_ROWS", 7)):
        monkeypatch.setattr(suffix_tree, name, value, raising=False)
    rng = random.Random(5)
    follow = {w: rng.sample([f"w{k}" for k in range(40)], 3) for w in (f"w{k}" for k in range(40))}
    texts = []
    for _ in range(80):
        text = [rng.choice(list(follow))]
        for _ in range(rng.randrange(30)):
            text.append(rng.choice(follow[text[-1]]) if rng.random() < 0.9 else rng.choice(list(follow)))
        texts.append(" ".join(text))
    texts += ["", "W1 w1\tunseené", "x" * 500]
    rows = {i: t.lower().split() for i, t in enumerate(texts)}
    train = [w for i, w in rows.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    words = collections.Counter(w for t in train for w in [*t, None])
    base = sum(words.values()) + 0.5 * (len(words) + 1)
    root = lambda past, w: (words[w] + 0.5) / base
    tables = [collections.defaultdict(collections.Counter) for _ in range(2)]
    for t in train:
        padded = ["^", *t, None]
        for k in range(1, len(padded)):
            tables[0][padded[k - 1]][padded[k]] += 1
            if k > 1:
                tables[1][tuple(padded[k - 2 : k])][padded[k]] += 1

    def level(table, length, below):
        states = {}
        for context, after in table.items():
            n, kinds = sum(after.values()), len(after)
            past = context if length == 2 else (context,)
            low = {w: below(past[1:], w) for w in after}
            less = sum(c * math.log((c - 1 + kinds * low[w]) / (n - 1 + kinds) / low[w]) for w, c in after.items()) / n
            if n >= 4 and less >= suffix_tree.MIN_DIVERGENCE:
                own = {w: (c + kinds * low[w]) / (n + kinds) for w, c in after.items() if c > 1}
                states[past] = own, max(1 - sum(own.values()), 1e-12) / max(1 - sum(low[w] for w in own), 1e-12)

        def p(past, w):
            own, rest = states.get(tuple(past), ({}, 1.0)) if len(past) == length else ({}, 1.0)
            return own[w] if w in own else rest * below(past[1:], w)

        return p, states

    one, first = level(tables[0], 1, root)
    two, second = level(tables[1], 2, one)
    assert len(words) > 30 and len(first) > 20 and len(second) > 10
    for r in suffix_tree.score_texts(frame(spark, texts)).collect():
        padded = ["^", *rows[r.doc_id], None]
        total = sum(math.log10(two(padded[max(0, k - 2) : k], w) if k > 1 else one(["^"], w)) for k, w in enumerate(padded) if k)
        assert r.score == pytest.approx(total, rel=1e-6), r.doc_id

"""Exact and near duplicates against brute force."""

import collections
import random

import numpy as np
import pytest
import xxhash

from framecat.llm import exact_dedup, golomb, simhash
from framecat.llm.components import components

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, raw long, code string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "x") for i, t in rows], SCHEMA).repartition(3)


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "ab"), (6, "a\x0cb"), (6, "a\x0cb"), (None, "ab"), (None, None),
       (7, "é à"), (8, "éà"), (9, "a\xa0b"), (10, "word " * 30000), (11, "word" * 30000), (12, "A b")]


def exact_brute(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups["".join(c for c in t or "" if c not in WHITE)].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for members in groups.values():
        keep = min(members, key=lambda m: m[:3])
        out += [(m[3], keep[3], len(members)) for m in members]
    return collections.Counter(out)


@pytest.mark.parametrize("rows", [ODD, [(i, f"t{i % 7} " + " " * (i % 3)) for i in range(300)], []])
def test_exact_duplicates(spark, rows):
    got = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == exact_brute(rows)
    per_text = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert all(n == 1 for n in per_text.values()) and len(per_text) == len({r.text_sha256 for r in got})


def test_exact_drop_keeps_columns_and_one_of_repeated_rows(spark):
    kept = exact_dedup.drop_exact_duplicates(frame(spark, ODD))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    texts = collections.Counter("".join(c for c in r.text or "" if c not in WHITE) for r in kept.collect())
    assert all(n == 1 for n in texts.values())
    assert len(texts) == len({"".join(c for c in t or "" if c not in WHITE) for _, t in ODD})


def test_owners_see_duplicates_of_other_senders(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "OWNER_ROWS", 16)
    monkeypatch.setattr(exact_dedup, "SENDER_BITS", 3)
    rows = [(i, f"text {i % 90}") for i in range(200)]
    got = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == exact_brute(rows)


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n, span in ((1, 2), (7, 9), (1000, 1 << 40), (5000, 5001)):
        values = np.unique(rng.integers(0, span, n).astype(np.uint64))
        bits = golomb.parameter(values, span)
        assert (golomb.decode(golomb.encode(values, bits), bits, len(values)) == values).all()


def code_of(text, shingle):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for white in WHITE:
        words = words.replace(white, " ")
    words = [w for w in words.split(" ") if w]
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_brute(codes, radius):
    label = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if bin(codes[i] ^ codes[j]).count("1") <= radius:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    return label


def test_simhash_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE_ROWS", 8)
    rng = random.Random(3)
    words = [f"W{i}é" for i in range(40)]
    rows = list(ODD)
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 60, 150]))]
        for copy in range(8):
            edited = list(text)
            if copy:
                edited[rng.randrange(len(edited))] = rng.choice(words)
            rows.append((100 + base * 10 + copy, " ".join(edited)))
    codes = [code_of(t, 3) for _, t in rows]
    label = groups_brute(codes, 2)
    least = {g: min((i for (i, _), x in zip(rows, label) if x == g and i is not None), default=None) for g in label}
    want = collections.Counter((i, f"{c:016x}", least[g]) for (i, _), c, g in zip(rows, codes, label))
    got = simhash.simhash_components(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.code.hex(), r.component_id) for r in got) == want


def test_count_tiles_reach_every_pair_within_the_radius():
    rng = random.Random(5)
    for parts in (1, 2, 4, 8):
        steps = set(simhash._count_steps(parts, 2)) | {(0,) * parts}
        tile = lambda c: tuple(bin(c >> (64 - 64 // parts * (k + 1)) & (2 ** (64 // parts) - 1)).count("1") for k in range(parts))
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            ab = tuple(y - x for x, y in zip(tile(a), tile(b)))
            assert ab in steps or tuple(-d for d in ab) in steps


def test_empty_and_near(spark):
    assert simhash.simhash_components(frame(spark, [])).count() == 0
    rng = random.Random(9)
    text = [f"w{rng.randrange(400)}" for _ in range(300)]
    other = [f"w{rng.randrange(400)}" for _ in range(300)]
    rows = [(1, " ".join(text)), (2, " ".join([*text[:150], "changed", *text[151:]])), (3, " ".join(other)), (None, " ".join(text))]
    kept = simhash.drop_near_duplicates(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3]


def shingle_set(text, shingle=5):
    found = text.lower().split()
    return {tuple(found[i : i + shingle]) for i in range(max(1, len(found) - shingle + 1))} if found else set()


def near_brute(rows, similarity=0.8):
    sets, label = [shingle_set(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or 10 * len(a & b) >= round(10 * similarity) * len(a | b):
                x, y = label[i], label[j]
                label = [y if g == x else g for g in label]
    least = {g: min(i for (i, _), x in zip(rows, label) if x == g) for g in label}
    return {i: least[g] for (i, _), g in zip(rows, label)}


def pairs_near_the_limit(rng, count=120):
    """Pairs whose texts share a beginning; the Jaccard similarity of their shingles is 0.65 to 0.9."""
    rows = []
    for k in range(count):
        n, likeness = rng.choice([9, 20, 100, 300]), 0.65 + 0.25 * k / count
        new = round(n * (1 - likeness) / (1 + likeness))
        text = [f"w{rng.randrange(10**6)}" for _ in range(n + 4)]
        rows.append((2 * k, " ".join(text)))
        rows.append((2 * k + 1, " ".join([*text[: n + 4 - new], *(f"x{rng.randrange(10**6)}" for _ in range(new))])))
    return rows


@pytest.mark.parametrize("block", [4, 512])
def test_near_duplicates_are_those_of_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "SET_ROWS", block)
    rng = random.Random(12)
    rows = pairs_near_the_limit(rng)
    text = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    for copy in range(40):  # a group that is larger than a block, with pairs on both sides of the limit
        edited = list(text)
        for _ in range(copy % 6):
            edited[rng.randrange(len(edited))] = f"y{rng.randrange(10**6)}"
        rows.append((1000 + copy, " ".join(edited)))
    rows += [(2000, ""), (2001, " "), (2002, "one"), (2003, "One"), (2004, "two")]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == near_brute(rows)


def test_repeats_in_a_text_do_not_count_in_the_near_stage(spark):
    rng = random.Random(21)
    some = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, rows = some(15), []
    for k in range(4):  # different texts with one repeated line, and a text with that line once or often
        rows.append((k, " ".join([*some(500), *line * 25])))
    text = some(300)
    rows += [(10, " ".join([*text, *line])), (11, " ".join([*text, *line * 40]))]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == near_brute(rows) == {0: 0, 1: 1, 2: 2, 3: 3, 10: 10, 11: 10}
    once, often = (np.frombuffer(simhash._majority(simhash._shingle_set(t, 5), 256), np.uint8) for _, t in rows[-2:])
    assert np.bitwise_count(once ^ often).sum() < 41


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == {i: 0 if i < 61 else 100 for i in [*range(61), *range(100, 150)]}

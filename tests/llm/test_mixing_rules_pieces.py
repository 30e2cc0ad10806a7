"""Mixing, quality rules, pieces and the pipeline against brute force and round trips."""

import collections
import os
import random

import numpy as np
import pytest

import corpus_pipeline
from framecat.llm import mixing, pieces, quality_rules
from framecat.llm.queries import PIECE_MODEL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string"
WHITE = " \t\n\x0b\x0c\r"


def words(text):
    for white in WHITE:
        text = (text or "").replace(white, " ")
    return [w for w in text.split(" ") if w]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 1, "x") for i, t, lang, s in rows], SCHEMA).repartition(3)


def corpus(seed=1):
    rng = random.Random(seed)
    rows = [(None, None, None, None), (1, "", "en", "b"), (2, " \n", "xx", None), (2, " \n", "xx", None)]
    for i in range(3, 120):
        source = rng.choice(["a", "a", "a", "b", "c", "é", None, "B"])
        rows.append((i, " ".join(rng.choice(["the", "of", "w1", "x"]) for _ in range(rng.choice([1, 7, 80, 300]))), "en", source))
    return [*rows, (200, "word " * 9000, "de", "c")]


def targets_brute(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / max(1, sum(weight[s] for s in rest))
        more = {s for s in rest if 3 * sizes[s] <= level * weight[s]}
        if not more:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= more


@pytest.mark.parametrize("block", [16, 2048])
def test_mix_meets_its_targets(spark, block):
    rows = corpus()
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    want = targets_brute(sizes)
    told = [mixing.taken_words(frame(spark, rows), block=block).collect() for _ in range(2)]
    assert collections.Counter(told[0]) == collections.Counter(told[1])
    assert len(told[0]) == len(rows)
    source = {i: s for i, _, _, s in rows}
    taken = collections.Counter()
    for r in told[0]:
        assert r.taken <= 3 * r.size and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_mixed_rows_are_the_words_taken(spark):
    rows = corpus(2)
    docs = frame(spark, rows)
    out = mixing.mixed(docs, block=64)
    assert out.columns == docs.columns
    got = collections.Counter()
    for r in out.collect():
        got[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
    want = {r.doc_id: r.taken for r in mixing.taken_words(docs, block=64).collect() if r.taken}
    assert got == want
    assert mixing.taken_words(frame(spark, [])).count() == 0 and mixing.mixed(frame(spark, [])).count() == 0


def test_schedule_is_even(spark):
    rows = [(i, "w " * 100, "en", "abc"[i % 3]) for i in range(300)]
    _, sources, mix = mixing.mixture(frame(spark, rows), block=50)
    place = {r.slot: r.doc_id % 3 for r in mix.collect()}
    order = [place[s] for s in sorted(place)]
    assert len(order) == 600
    for k in range(3):
        share = order.count(k) / len(order)
        seen = np.cumsum(np.array(order) == k) - share * np.arange(1, len(order) + 1)
        assert abs(seen).max() < 12


def rules_brute(text):
    text = text or ""
    found = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    at = collections.defaultdict(list)
    for i in range(len(found) - 2):
        at[tuple(found[i : i + 3])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    n = len(found)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_rules_base(spark):
    rng = random.Random(4)
    rows = corpus(3) + [(300 + k, "\n".join(rng.choice(["a b c", "d|e #", " ", "x é y z", "q"]) for _ in range(k * 4)), "fr", "s") for k in range(30)]
    rows += [(400, "a a a a a a", "en", "s"), (401, "no space" * 20000, None, "s")]
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    got = collections.Counter((r.doc_id, *(r[n] for n in names)) for r in quality_rules.rules(frame(spark, rows)).collect())
    assert got == collections.Counter((i, *rules_brute(t)) for i, t, _, _ in rows)
    assert quality_rules.rules(frame(spark, [])).count() == 0


def test_equal_hashes_of_different_words_are_no_repeats(spark):
    from pyspark.sql import functions as F

    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (0, 1, 2, 3, 4, 30, 90)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    few = lambda a, b, c: F.pmod(quality_rules._window_hash(a, b, c), F.lit(3))
    got = docs.select("text", quality_rules._repeat_words(quality_rules.words_of(F.col("text")), few).alias("n")).collect()
    assert {r.text: r.n for r in got} == {t: rules_brute(t)[4] for t in texts}


def shares(text, lang):
    import unicodedata

    known = quality_rules.COMMON_WORDS.get(lang, quality_rules.COMMON_WORDS["en"])
    kinds = [unicodedata.category(c) for c in text]
    first = [kinds.count("Lu"), kinds.count("Ll") + kinds.count("Lo"), kinds.count("Nd"), sum(c in WHITE for c in text), sum(c in "#*$%&|<>" for c in text)]
    second = [words(text).count(w) for w in known]
    part = lambda xs, n: [x * 1_000_000 // n for x in [*xs, n - sum(xs)]]
    return part(first, len(text)), part(second, len(words(text)))


def test_distances(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = quality_rules.references(quality_rules.measure(docs))
    told = {r.doc_id: r for r in quality_rules.rules(docs).collect()}

    def distance(p, q):
        part = lambda a, m: a * np.log2(a / m) if a else 0.0
        return np.sqrt(sum(part(a, (a + b) / 2) + part(b, (a + b) / 2) for a, b in zip(p, q)) / 2e6)

    for r in docs.collect():
        a, b = shares(r.text or " ", r.lang) if words(r.text) else ([], [])
        if told[r.doc_id].class_distance is not None:
            assert told[r.doc_id].class_distance == pytest.approx(distance(a, known[r.lang][0]))
        if told[r.doc_id].word_distance is not None:
            assert told[r.doc_id].word_distance == pytest.approx(distance(b, known[r.lang][1]))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(told[i].kept for i, q in labels.items() if q and not told[i].base_failed)
    assert sum(not told[i].kept for i, q in labels.items() if not q) > 0.8 * sum(not q for q in labels.values())


def prose(rng, lang, n=200):
    """Words of which a third are the language's common words, and as many others."""
    common = quality_rules.COMMON_WORDS[lang]
    return " ".join(rng.choice(common) if rng.random() < 0.35 else "w" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(n))


def test_copies_of_a_bad_page_are_no_reference(spark):
    rng = random.Random(8)
    clean = [(i, prose(rng, "fr"), "fr", "s") for i in range(40)]
    page = " ".join("ZQ%X " + str(rng.randrange(10**9)) for _ in range(100))
    looped = [(200 + i, "rien du tout " * 100 + str(i), "fr", "s") for i in range(20)]
    copies = [(100 + i, page, "fr", "s") for i in range(30)]
    told = {r.doc_id: r.kept for r in quality_rules.rules(frame(spark, clean + copies + looped)).collect()}
    assert {i for i, kept in told.items() if kept} == set(range(40))
    good = quality_rules.drop_low_quality(frame(spark, clean + copies + looped))
    assert {r.doc_id for r in good.collect()} == set(range(40))
    once = quality_rules.references(quality_rules.measure(frame(spark, clean + copies[:1])))
    assert quality_rules.references(quality_rules.measure(frame(spark, clean + copies + looped))) == once


@pytest.mark.parametrize("lang", [None, "xx", "DE"])
def test_rows_without_a_language_are_judged_by_the_nearest(spark, lang):
    rng = random.Random(9)
    texts = {name: [prose(rng, name) for _ in range(30)] for name in quality_rules.COMMON_WORDS}
    rows = [(i, t, name, "s") for i, (name, t) in enumerate((n, t) for n, ts in texts.items() for t in ts)]
    unknown = [(i + 1000, t, lang, "s") for i, t, name, _ in rows if i % 10 == 0]
    foreign = " ".join("w" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(200))
    docs = frame(spark, [*rows, *unknown, (5000, foreign, lang, "s"), (5001, foreign, "de", "s")])
    told = {r.doc_id: r for r in quality_rules.rules(docs).collect()}
    assert all(told[i].kept for i, *_ in rows + unknown)
    assert all(told[i].word_distance <= 0.23 for i, *_ in unknown)
    assert told[5000].kept and told[5000].word_distance is None and told[5000].class_distance is not None
    assert not told[5001].kept
    assert {r.doc_id for r in quality_rules.drop_low_quality(docs).collect()} == {i for i, r in told.items() if r.kept}
    alone = quality_rules.rules(frame(spark, unknown)).collect()  # no reference of any language
    assert all(r.kept and r.word_distance is None for r in alone)


@pytest.fixture(scope="module")
def table():
    if not os.path.exists(PIECE_MODEL):
        pytest.skip("no model file")
    return pieces.load(PIECE_MODEL)


def test_pieces_are_those_of_the_library_search(table):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(PIECE_MODEL, "rb") as f:
        model.ParseFromString(f.read())
    for piece, score in zip(model.pieces, pieces.piece_scores(model)):
        piece.score = score
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    score = lambda ids: sum(library.get_score(i) for i in ids)
    rng, letters = random.Random(6), 'abcdeghinorstu   éü\n\t.,"▁漢字🙂A0'
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        got, want = list(pieces.encode_texts(table, [text], {})[0]), library.encode(text)
        assert got == want or (len(got) == len(want) and score(got) == pytest.approx(score(want)))


def test_pieces_round_trip(spark, table, monkeypatch):
    monkeypatch.setattr(pieces, "SLICE_CHARS", 200)
    monkeypatch.setattr(pieces, "KNOWN_UNITS", 50)
    texts = [None, "", " ", "  a", "a \n\n b\t", "▁x", "é" * 5000, "x" * 70000, "\x00", *(t for _, t, _, _ in corpus())]
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    out = pieces.decode(pieces.encode(docs, table), table).collect()
    assert {r.doc_id: r.text for r in out} == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    told = {r.doc_id: r for r in docs.collect()}
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert all(r.decoded for r in out)
    from framecat.llm import exact_dedup, simhash

    good = quality_rules.drop_low_quality(docs)
    assert good.columns == docs.columns
    kept = simhash.drop_near_duplicates(exact_dedup.drop_exact_duplicates(good))
    want = {r.doc_id: r.taken for r in mixing.taken_words(kept).collect() if r.taken}
    got = collections.Counter()
    for r in out:
        got[r.doc_id] += 1
    assert set(got) == set(want)
    assert all(got[i] == -(-want[i] // len(words(told[i].text))) for i in got)


def test_every_stage_takes_odd_tables(spark, sf_dir):
    odd = frame(spark, [(None, None, None, None), (1, "", "en", "a"), (1, "", "en", "a"), (2, "the of " * 9, "xx", None), (3, " \n", None, "a"), (4, "z" * 90000, "en", "a")])
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, sf_dir).count() <= 3 * docs.count()

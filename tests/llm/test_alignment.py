"""Alignment of tokenizers against a walk over all tokens of whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Row

from framecat.llm import alignment, queries

SIDES = alignment.read_sides(queries.BYTE_FILE, queries.PIECE_MODEL)
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.fixture(scope="module")
def encoders():
    return SIDES.load()


def brute(encoders, texts):
    """Results by whole texts and links by comparing byte ranges."""
    told, links = [], Counter()
    for text in texts:
        if not text:
            told.append(None)
            continue
        a, b = encoders.a.encode(" " + text, add_special_tokens=False).ids, encoders.b.encode(text)
        if not encoders.spells(text, a, b):
            told.append(None)
            continue
        spans = []
        for ids, spelled in ((a, encoders.a_bytes), (b, encoders.b_bytes)):
            ends = np.cumsum([len(spelled[i]) for i in ids]).tolist()
            spans.append(list(zip([0, *ends], ends, ids)))
        found, j = [], 0
        for low, high, i in spans[0]:
            while spans[1][j][1] <= low:
                j += 1
            at = j
            while at < len(spans[1]) and spans[1][at][0] < high:
                found.append((i, spans[1][at][2]))
                at += 1
        links.update(found)
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [
            "|".join(",".join(str(i) for low, high, i in side if begin <= low and high <= end) for side in spans)
            for begin, end in zip([0, *common], common)
        ] if len(text) < 3000 else None
        told.append((len(a), len(b), len(common), found, groups))
    highest = defaultdict(int)
    for (_, i), n in links.items():
        highest[i] = max(highest[i], n)
    out = []
    for t in told:
        if t is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        best = sum(links[p] == highest[p[1]] for p in t[3])
        out.append((t[0], t[1], t[2], len(t[3]), best, sum(links[p] for p in t[3]), None if t[4] is None else ";".join(t[4])))
    return out


CASES = [
    None,
    "",
    " ",
    "  ",
    "a",
    " leading and trailing ",
    "two  blanks\nand lines\n next\t tab",
    "a▁b is not spelled",
    "plain <|endoftext|> text </s> <s> <unk> <0x41>",
    "Größe, naïve façade – 北京大学 и русский текст 🙂👩‍👩‍👧",
    "no-break  space 　 wide  end",
    "x" * 700,
    "1234567890 " * 80,
    "don't  we'll\r\n\r\n  I've",
    "tail blank ",
    "\n",
    "ab " * 300 + "z" * 150 + " ab" * 300,
    "\x1c a \x85 b \x00 c",
]


def run(spark, texts, **kind):
    rows = spark.createDataFrame([Row(doc_id=i, text=t, groups="clash", raw=1) for i, t in enumerate(texts)], "doc_id long, text string, groups string, raw int")
    got = {r["doc_id"]: r for r in alignment.align(rows, SIDES, **kind).collect()}
    assert len(got) == len(texts)
    return [tuple(got[i][n] for n in NAMES) for i in range(len(texts))]


def same(got, want):
    for i, (g, w) in enumerate(zip(got, want)):
        assert g[:6] == w[:6], i
        assert w[6] is None or g[6] == w[6], i


@pytest.mark.parametrize("chunk,lookup", [(1 << 16, 4_000_000), (64, 4_000_000), (64, 0)])
def test_cases_equal_brute_force(spark, encoders, chunk, lookup):
    same(run(spark, CASES + CASES[4:8], chunk=chunk, lookup_rows=lookup), brute(encoders, CASES + CASES[4:8]))


def test_both_ways_to_encode_agree(encoders):
    assert encoders.fast
    texts = [c for c in CASES if c]
    a, _ = encoders.encode(texts)
    assert a == [e.ids for e in encoders.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    file = {"model": {"merges": ["a b"], "vocab": {"ab": 7}}, "pre_tokenizer": {"type": "ByteLevel"}}
    assert encoders.ranked(file) is None


def test_documents_equal_brute_force(spark, encoders, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    want = dict(zip(texts, brute(encoders, list(texts.values()))))
    found = queries.op12_alignment(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        w = want[row["doc_id"]]
        assert tuple(row[n] for n in NAMES[:6]) == w[:6]
        if w[6] is not None:
            assert row["groups_sha256"] == (hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "")


def test_composition_is_associative_and_cuts_do_not_matter(encoders):
    text = "Unbelievable internationalisation, 12345 characterisations: " * 6
    tokens, fits = alignment.stream(encoders, text)
    assert fits
    end, rng = int(tokens.a_ends[-1]), random.Random(5)
    whole = alignment.Closed.of(tokens)
    for _ in range(20):
        edges = [0, *sorted(rng.sample(range(1, end), 9)), end]
        parts = [alignment.Fragment.of(tokens.between(a, b)) for a, b in zip(edges, edges[1:])]
        while len(parts) > 1:  # any order of composition
            at = rng.randrange(len(parts) - 1)
            parts[at : at + 2] = [parts[at].then(parts[at + 1])]
        told = alignment.no_fragment().then(parts[0]).then(alignment.no_fragment())
        assert not len(told.suffix.a) and not len(told.suffix.b)
        closed = told.ended()
        assert ";".join(closed.texts) == ";".join(whole.texts)
        assert (closed.n_a, closed.n_b, closed.n_groups) == (whole.n_a, whole.n_b, whole.n_groups)
        assert closed.keys.tolist() == whole.keys.tolist() and closed.times.tolist() == whole.times.tolist()


def test_a_very_long_document_is_cut_into_ranges(spark, encoders):
    text = "A sentence of eight words goes on here. " * 400
    data = (" " + text).encode()
    cut = alignment.ranges(data, 1024)
    assert len(cut) > 10 and [c[0] for c in cut[1:]] == [c[1] for c in cut[:-1]]
    assert all(high - low <= 3 * 1024 for _, _, low, high in cut)
    assert len(alignment.ranges(b" " + b"y" * 5000, 1024)) == 1  # no cut inside one unit
    same(run(spark, [text, text, "short"], chunk=1024), brute(encoders, [text, text, "short"]))


def test_empty_table_and_null_ids(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(rows, SIDES).count() == 0
    rows = spark.createDataFrame([(None, "one text"), (None, "one text"), (3, None)], "doc_id long, text string")
    got = sorted(alignment.align(rows, SIDES, chunk=4).select("doc_id", "n_a").collect(), key=str)
    assert [r["n_a"] for r in got] == [0, got[1]["n_a"], got[1]["n_a"]] and got[1]["n_a"] > 0

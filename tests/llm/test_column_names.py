"""Extra columns named like those that operators make inside: stages keep them, verdicts do not change."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framecat.llm import exact_dedup, kneser_ney, mixing, severity, simhash, suffix_tree

NAMES = """_id _ID_ _raw _raw_ raw _words _size _from _slot slot row node shingles held group component key code kept _kept _n
    _doc _key words size place block _lang _text _m lang_ n perplexity limit sha fingerprint sender points toxic""".split()


@pytest.fixture(scope="module")
def tables(spark):
    rng = ["blue", "stone", "river", "goes", "down", "the", "hill", "and", "of", "night"]
    base = [" ".join(rng[(i * 7 + k * k + k // 3) % 10] + str((i * k) % 5) for k in range(120)) for i in range(12)]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(base + base[:4] + [base[5] + " end", "", None or ""])]
    rows += [rows[0], (None, None, None, None, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    plain = spark.createDataFrame(plain.toArrow())
    return plain, plain.select("*", *[F.lit(f"kept {n}").alias(n) for n in NAMES])


def rows_of(frame, columns):
    return sorted(map(str, frame.select(*columns).collect()))


@pytest.mark.parametrize("name, stage", [s for s in corpus_pipeline.STAGES[1:4]] + [corpus_pipeline.STAGES[0]])
def test_stages(spark, tables, name, stage):
    plain, wide = tables
    told = stage(spark, wide, "")
    assert told.columns == wide.columns
    assert rows_of(told, plain.columns) == rows_of(stage(spark, plain, ""), plain.columns)
    assert all(r[n] == f"kept {n}" for r in told.collect() for n in NAMES)


def test_last_stage(spark, tables):
    plain, wide = tables
    last = corpus_pipeline.STAGES[-1][1]
    assert sorted(map(str, last(spark, wide, "").collect())) == sorted(map(str, last(spark, plain, "").collect()))


@pytest.mark.parametrize(
    "operator",
    [exact_dedup.exact_duplicates, simhash.simhash_components, simhash.near_duplicates, mixing.taken_words, suffix_tree.score_texts],
)
def test_operators(tables, operator):
    plain, wide = tables
    assert sorted(map(str, operator(wide).collect())) == sorted(map(str, operator(plain).collect()))


def test_models(spark, tables):
    plain, wide = tables
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(12)], "doc_id long, quality int, toxic int")
    odd = labels.withColumn("_id", F.lit("x")).withColumn("_doc", F.lit("x"))
    told = lambda d, n: sorted(map(str, kneser_ney.classify(d, n).collect()))
    assert told(wide, odd) == told(plain, labels)
    marks = lambda d, n: sorted(map(str, severity.severities(d, severity.train(d, n)).collect()))
    assert marks(wide, odd) == marks(plain, labels)


def test_slots_of_the_mix(tables):
    plain, wide = tables
    told = mixing.mixed(wide, slot="order")
    assert told.columns == [*wide.columns, "order"]
    plan = mixing.mixture(plain)[2].groupBy("row", "epoch").agg(F.min("slot").alias("s"))
    assert sorted(r.order for r in told.collect()) == sorted(r.s for r in plan.collect())

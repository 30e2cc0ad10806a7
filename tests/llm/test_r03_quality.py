"""Repeated words: only windows that may repeat are compared by their words."""

from pyspark.sql import functions as F

from framecat.llm import quality_rules


def test_only_windows_that_share_a_hash_are_compared(spark):
    text = " ".join(f"w{k}" for k in range(60)) + " w3 w4 w5 end"
    docs = spark.createDataFrame([(text,), ("a b c",), ("",)], "text string")
    hashes = F.transform(quality_rules.words_of(F.col("text")), lambda word: F.xxhash64(word))
    rows = docs.select("text", F.array_sort(quality_rules._suspects(hashes, quality_rules._window_hash)).alias("at")).collect()
    assert {r.text: r["at"] for r in rows} == {text: [3, 60], "a b c": [], "": []}
    told = docs.select(quality_rules._repeat_words(quality_rules.words_of(F.col("text"))).alias("n")).collect()
    assert sorted(r.n for r in told) == [0, 0, 6]

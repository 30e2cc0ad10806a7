"""Findings of the round on what the suffix tree keeps."""

from pyspark.sql import functions as F

from framecat.llm import suffix_tree


def test_words_of_like_count_leave_symbols(spark):
    """Before, a step of more words than the bound left none of them, and ended the search."""
    like = spark.range(9000).select(F.col("id").cast("string").alias("key"), F.lit(7).cast("long").alias("n"))
    kept = suffix_tree._at_most(like, "n", 5000).count()
    assert 4900 <= kept <= 5000
    again = suffix_tree._at_most(like.repartition(5), "n", 5000).collect()
    assert sorted(again) == sorted(suffix_tree._at_most(like, "n", 5000).collect())
    more = like.unionByName(spark.range(100).select(F.concat(F.lit("x"), "id").alias("key"), (F.col("id") + 1000).alias("n")))
    assert suffix_tree._at_most(more, "n", 5000).filter("n > 7").count() == 100
    assert suffix_tree._at_most(like, "n", 9000).count() == 9000 and suffix_tree._at_most(like.limit(0), "n", 10).count() == 0


def test_finer_steps_keep_the_larger_values(spark):
    close = spark.range(1000).select("id", (F.col("id") + 1_000_000).alias("n"))  # one step of a sixteenth of an octave
    assert suffix_tree._at_most(close, "n", 400).agg(F.min("id")).first()[0] >= 500

"""Findings of round 3 on tables."""

from pyspark.sql import functions as F

from framecat.plans import tables
from framecat.session import scratch_path


def given(spark, sf_dir, orders):
    """The given tables with other orders."""
    path = scratch_path(spark, "given")
    orders.write.parquet(f"{path}/orders.parquet")
    for name in ("lineitem", "part"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path


def test_f12_childless_file_of_an_id_that_another_file_has(spark, sf_dir):
    """Two orders give the same path and time; only one of them has lines."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    one = orders.filter("o_orderkey % 10 < 7").join(lines, "o_orderkey").orderBy("o_orderkey").limit(1).select(orders.columns)
    twin = one.withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    found = tables.childless_files(spark, given(spark, sf_dir, one.unionByName(twin))).collect()
    assert len(found) == 1 and found[0].multipart_count == 0

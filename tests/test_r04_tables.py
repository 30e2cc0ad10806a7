"""Findings of the round on what the shared steps shuffle, sort and write."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from framecat.operators import ingest, sinks
from framecat.plans import base, tables, views
from framecat.session import scratch_path


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_rows_of_a_file_meet_without_a_shuffle(spark, sf_dir):
    """Before, every part, channel and attribute with its text was shuffled for its payload, and again for its structure."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        files = views.identified(views.files(spark, sf_dir)).repartition(base.buckets(spark, sf_dir), "file_key")
        lines = base.stored(spark, sf_dir, "lines")
        made = ingest.build_payload(files, base.stored(spark, sf_dir, "parts", base.FILE_KEY), base.file_channels(spark, sf_dir), views.attributes(lines))
        assert len(re.findall(r"Exchange hashpartitioning", plan(made))) == 1  # the files
        assert len(re.findall(r"Exchange hashpartitioning", plan(base.structures(spark, sf_dir)))) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_grow_with_the_order_lines(spark, sf_dir, monkeypatch):
    """Before, a bucket held a million lines, and lines were numbered in as many partitions as the session has, whatever their number."""
    path = scratch_path(spark, "given")
    for name in ("lineitem", "part", "orders"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    rows = spark.read.parquet(f"{path}/lineitem.parquet").count()
    monkeypatch.setattr(base, "BUCKET_ROWS", rows // 20)
    n = base.buckets(spark, path)
    assert 20 <= n <= 21
    assert views.part_lines(spark, path, True, n).rdd.getNumPartitions() == n
    assert base.stored(spark, path, "lines").count() == base.stored(spark, path, "parts").count() == rows


def test_places_count_order_lines_whatever_their_parts(spark):
    """A line without a part keeps its place, and one whose part comes twice gives two parts of one place."""
    path = scratch_path(spark, "odd")
    when = F.lit("1997-01-01").cast("timestamp")
    lines = [(1, p, 1, n, 5.0, 1.0, 0.1, "A", "O") for n, p in ((1, 10), (2, None), (3, 11), (4, 99), (5, 10))] + [(None, 10, 1, 1, 5.0, 1.0, 0.1, "R", "F")]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, names).withColumn("l_shipdate", when).write.parquet(f"{path}/lineitem.parquet")
    parts = [(10, "STANDARD", "a"), (11, "LARGE", "b"), (11, "LARGE", "c")]
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_brand string").write.parquet(f"{path}/part.parquet")
    told = sorted(((r.file_key, r.part_index, r.p_brand) for r in base.stored(spark, path, "lines").collect()), key=str)
    assert told == [(1, 0, "a"), (1, 2, "b"), (1, 2, "c"), (1, 4, "a"), (None, 0, "a")]
    assert told == sorted(((r.file_key, r.part_index, r.p_brand) for r in views.part_lines(spark, path, True).collect()), key=str)


def test_a_task_of_the_lines_step_sends_no_more_than_a_few_buckets(spark, sf_dir, monkeypatch):
    """Before, the given lines were read and joined in as many tasks as the session has, whose rows spilled when they were sent."""
    path = scratch_path(spark, "given")
    for name in ("lineitem", "part", "orders"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    monkeypatch.setattr(base, "BUCKET_ROWS", spark.read.parquet(f"{path}/lineitem.parquet").count() // 20)
    held, write = [], sinks.write_bucketed
    names = ("spark.sql.shuffle.partitions", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(x, None) for x in names]

    def told(*args, **kwargs):
        held.append([int(spark.conf.get(x)) for x in names])
        return write(*args, **kwargs)

    monkeypatch.setattr(sinks, "write_bucketed", told)
    base.stored(spark, path, "lines")
    assert held == [[base.buckets(spark, path)] * 2] and held[0][0] >= 20
    assert [spark.conf.get(x, None) for x in names] == before


def test_tables_are_written_without_a_shuffle(spark, sf_dir):
    """Before, the files were shuffled for every table, and order lines once more to count them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in tables._catalogue(spark, sf_dir).values():
            assert "Exchange" not in plan(df.filter(F.col("file_id") < "8"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

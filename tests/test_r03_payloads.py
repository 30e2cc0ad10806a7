"""Findings of round 3 on payloads and stored tables."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from framecat.functions import values
from framecat.operators import ingest, sinks
from framecat.plans import base, views
from framecat.session import scratch_path
from framecat.sources.payloads import parse_payloads


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_payloads_are_parsed_once(spark):
    """Before, the conditions of a good payload parsed the text again in a filter."""
    lines = spark.createDataFrame([('{"file": {"path": "a.exr"}}',)], "value string")
    prepared = ingest.prepare(ingest.route_errors(parse_payloads(lines))[0])
    assert plan(ingest.parts_rows(prepared)).count("from_json(") == 1


def test_payload_takes_texts_of_windows_as_they_are(spark, sf_dir):
    """Before, windows were parsed and told again: a float lost its point, and a text of other spacing its form."""
    window = '{"min":{"x":1.0,"y":0},"max":{"x":2.50,"y":3}}'
    parts = base.stored(spark, sf_dir, "parts").limit(1).withColumn("data_window", F.lit(window))
    key = [r.file_key for r in parts.collect()][0]
    tables = (views.identified(views.files(spark, sf_dir)), parts, base.stored(spark, sf_dir, "channels"), base.stored(spark, sf_dir, "attributes"))
    made = ingest.build_payload(*(t.filter(F.col("file_key") == key) for t in tables)).first()
    assert f'"data_window":{window}' in made.value


def test_kind_names_the_shape_once(spark):
    assert plan(spark.sql("SELECT '1' AS t").select(values.kind(F.try_parse_json("t")).alias("k"))).count("SchemaOfVariant") <= 2
    texts = ["null", "{}", '{"a":1}', "[]", "[1]", '"x"', "true", "1", "1.5", "1e3", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    told = [r.k for r in rows.select(values.kind(F.try_parse_json("t")).alias("k")).collect()]
    assert told == ["null", "object", "object", "array", "array", "string", "bool", "int", "float", "float", "null"]


def test_tables_that_follow_row_by_row_are_not_shuffled(spark):
    """Before, each table was dealt to its buckets again, though its source lies in them."""
    rows = spark.range(1000).select(F.col("id").alias("k"))
    first, second = (f"t_{scratch_path(spark, 'x')[-32:]}" for _ in range(2))
    sinks.write_bucketed(rows, first, scratch_path(spark, "first"), ["k"], 4)
    found = sinks.write_bucketed(spark.table(first).withColumn("v", F.col("k") * 2), second, scratch_path(spark, "second"), ["k"], 4, dealt=True)
    assert found.agg(F.sum("v")).first()[0] == 999_000
    assert len(found.inputFiles()) == 4  # one a bucket
    joined = plan(found.join(spark.table(first), "k").hint("merge"))
    assert not re.search(r"Exchange hashpartitioning", joined)

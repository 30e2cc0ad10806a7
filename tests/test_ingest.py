"""Payloads to tables: cases, errors, round trip, large headers, replay, streams."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from framecat.functions import structure
from framecat.operators import ingest, sinks, upsert
from framecat.plans import base, views
from framecat.session import materialise, scratch_path
from framecat.sources.payloads import parse_payloads, read_payloads
from framecat.streaming import arrivals

AT = "2024-01-01T00:00:00+00:00"


def payload(path="a/b.0001.exr", **more):
    file = {"path": path, "s3_key": path, "s3_bucket": "x", **more.pop("file", {})}
    return {"file": file, "parts": [], "channels": [], "attributes": {"parts": []}, **more}


def lines(spark, *payloads):
    return spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in payloads], "value string")


def rows(spark, *payloads, located=True):
    good, _ = ingest.route_errors(parse_payloads(lines(spark, *payloads)), located)
    prepared = ingest.prepare(good)
    return {name: make(prepared).collect() for name, make in ingest.FAN_OUT.items()}


def errors(spark, *payloads, located=True):
    told = ingest.with_errors(parse_payloads(lines(spark, *payloads)), located)
    return [r["error"] for r in told.select("error").collect()]


FULL = payload(
    parts=[
        {"part_index": 0, "compression": "piz", "is_tiled": True, "tile_width": 64, "multi_view": ["left", "right"]},
        {"part_index": 1, "compression": "PIZ", "is_tiled": True, "pixel_aspect_ratio": 2},
        {"part_index": 2, "compression": "zip", "is_deep": True},
    ],
    channels=[{"part_index": i % 3, "name": n, "type": "FLOAT"} for i, n in enumerate(["R", "G", "B", "A", "Z", "d.R", "d.G"])],
    attributes={
        "parts": [
            [{"name": "owner", "type": "STRING", "value": "me"}, {"name": "f", "type": "FLOAT", "value": 3.0}],
            [],
            [{"name": "n", "type": "INT", "value": 3}, {"name": "b", "type": "BOOL", "value": True}, {"name": "none"}],
        ]
    },
    file={"multipart_count": 3, "is_deep": True, "size_bytes": 5, "mtime": AT, "frame_number": 1},
)


def test_full_payload(spark):
    got = rows(spark, FULL)
    assert [len(got[n]) for n in ("files", "parts", "channels", "attributes")] == [1, 3, 7, 5]
    f = got["files"][0]
    assert (f.frame_number, f.multipart_count, f.is_deep, f.size_bytes, f.inspection_count) == (1, 3, True, 5, 1)
    assert len(f.metadata_embedding) == 384
    assert sum(v * v for v in f.metadata_embedding) == pytest.approx(1, abs=1e-5)
    p = got["parts"]
    assert [x.multi_view for x in p] == [True, False, False]
    assert [x.tile_width for x in p] == [64, 0, 0]
    assert [x.pixel_aspect_ratio for x in p] == [1.0, 2.0, 1.0]
    assert {x.data_window for x in p} == {"null"}
    c = got["channels"]
    assert sum(v * v for v in c[0].channel_fingerprint) == pytest.approx(1, abs=1e-5)
    assert all(set(x.channel_fingerprint) == {0.0} for x in c[1:])
    assert {x.x_sampling for x in c} == {1}
    a = {x.attr_name: x for x in got["attributes"]}
    assert (a["owner"].part_index, a["owner"].value_text) == (0, "me")
    assert (a["f"].value_json, a["f"].value_int, a["f"].value_float) == ("3.0", None, 3.0)
    assert (a["n"].part_index, a["n"].value_int, a["n"].value_float) == (2, 3, 3.0)
    assert (a["b"].value_json, a["b"].value_int, a["b"].value_float) == ("true", None, None)
    assert a["none"].value_json == "null"


def test_least_payload(spark):
    got = rows(spark, {"file": {"path": "/test.exr"}}, located=False)
    assert [len(got[n]) for n in ("files", "parts", "channels", "attributes")] == [1, 0, 0, 0]
    assert got["files"][0].frame_number is None


def test_attribute_lists_that_are_none_are_skipped(spark):
    odd = payload(attributes={"parts": ["oops", [{"name": "n", "value": 1}], None, [{"name": "m", "value": 2}]]})
    got = {r.attr_name: r.part_index for r in rows(spark, odd)["attributes"]}
    assert got == {"n": 1, "m": 3}


def test_errors(spark):
    no_path = payload()
    del no_path["file"]["path"]
    found = errors(
        spark, payload(), "{oops", '"text"', {**payload(), "channels": "oops"}, {"file": {"path": "a.exr"}},
        payload("a.jpg"), payload("A.EXR"), no_path, {**payload(), "channels": None}, {**payload(), "parts": None},
        {**payload(), "attributes": None},
    )
    assert found == [
        None, ingest.MALFORMED, ingest.MALFORMED, ingest.MALFORMED, ingest.NO_LOCATION, ingest.BAD_SUFFIX, None,
        ingest.NO_PATH, ingest.NULL_ARRAY, ingest.NULL_ARRAY, ingest.NULL_ARRAY,
    ]
    assert errors(spark, {"file": {"path": "a"}}, {"file": {}}, {}, located=False) == [None, ingest.NO_PATH, ingest.NO_PATH]


def test_identity(spark):
    changed = json.loads(json.dumps(FULL))
    changed["parts"][0]["compression"] = "zip"
    other_bucket = json.loads(json.dumps(FULL))
    other_bucket["file"]["s3_bucket"] = "y"
    a, b, c = (rows(spark, p)["files"][0] for p in (FULL, changed, other_bucket))
    assert a.file_id == b.file_id == c.file_id
    assert a.header_hash == c.header_hash != b.header_hash
    assert len({a.content_id, b.content_id, c.content_id}) == 3
    assert a.metadata_embedding == c.metadata_embedding != b.metadata_embedding


def test_part_order_is_of_no_matter(spark):
    turned = {**FULL, "parts": FULL["parts"][::-1]}
    assert rows(spark, FULL)["files"][0].header_hash == rows(spark, turned)["files"][0].header_hash


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    p = views.parts(spark, sf_dir, indexed=True)
    return {
        "files": views.identified(views.files(spark, sf_dir)),
        "parts": views.part_rows(p),
        "channels": views.channels(p),
        "attributes": views.attributes(p),
    }


def test_round_trip(spark, tables):
    prepared = ingest.prepare(parse_payloads(materialise(ingest.build_payload(**tables), "docs")))
    ids = tables["files"].select("file_key", "file_id")
    want = tables["parts"].join(ids, "file_key").drop("file_key")
    got = ingest.parts_rows(prepared).select(*want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    want = tables["attributes"].join(ids, "file_key").select("file_id", "part_index", "attr_name", "attr_type", "value_json")
    got = ingest.attributes_rows(prepared).select(*want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    want = tables["channels"].join(ids, "file_key").drop("file_key")
    got = ingest.channels_rows(prepared).select(*want.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    # One file row, whose hash and vector cover the whole header.
    told = structure.table_structure(tables["parts"], tables["channels"], "file_key", tables["files"])
    hashed = structure.header_hash(
        F.col("structure.part_count"), F.col("structure.is_deep"), F.col("structure.header_digest")
    )
    want = told.join(ids, "file_key").select("file_id", hashed.alias("header_hash"))
    got = ingest.files_rows(prepared).select("file_id", "header_hash")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def catalogue_rows(spark, root):
    found = sinks.read_catalogue(spark, root)
    files = found["files"].drop("inspection_timestamp", "last_inspected")
    return {
        "files": sorted(map(str, files.collect())),
        **{n: sorted(map(str, found[n].collect())) for n in sinks.CHILDREN},
    }


def test_batches_stream_and_replay_agree(spark, sf_dir):
    docs = base.payload_lines(spark, sf_dir).select("value").cache()
    early = F.xxhash64("value") % 2 == 0

    one = scratch_path(spark, "one")
    sinks.append_batch(docs, one, 0)
    assert sinks.merge_log(spark, one) == 1
    want = catalogue_rows(spark, one)
    assert want["files"]

    two = scratch_path(spark, "two")
    sinks.append_batch(docs.filter(~early), two, 0)
    sinks.append_batch(docs.filter(~early), two, 0)  # a replay replaces
    sinks.merge_log(spark, two)
    sinks.append_batch(docs.filter(early), two, 1)
    assert sinks.merge_log(spark, two) == 2
    assert sinks.merge_log(spark, two) == 2  # nothing due
    assert catalogue_rows(spark, two) == want

    source, three = scratch_path(spark, "source"), scratch_path(spark, "three")
    docs.repartition(12).write.text(source)
    lines = arrivals.payload_stream(spark, source, "*.txt", 5)
    query = arrivals.start_ingest(lines, three, scratch_path(spark, "state"), interval=None)
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= 2
    sinks.merge_log(spark, three)
    assert catalogue_rows(spark, three) == want
    assert sinks.read_errors(spark, three).count() == docs.count() - ingest.route_errors(parse_payloads(docs))[0].count()

    # Seen again: counts rise, nothing else changes, no child row is added.
    sinks.append_batch(docs, one, 1)
    sinks.merge_log(spark, one)
    again = sinks.read_catalogue(spark, one)
    assert [r[0] for r in again["files"].select("inspection_count").distinct().collect()] == [2]
    assert {n: again[n].count() for n in sinks.CHILDREN} == {n: len(want[n]) for n in sinks.CHILDREN}
    docs.unpersist()


def wide(count, codec="zip"):
    """A header with so many parts, each with one channel and one attribute."""
    return payload(
        parts=[{"part_index": i, "compression": codec, "width": i} for i in range(count)],
        channels=[{"part_index": i, "name": f"l{i}.R", "type": "HALF"} for i in range(count)],
        attributes={"parts": [[{"name": "n", "type": "int", "value": i}] for i in range(count)]},
    )


@pytest.mark.parametrize("count", [1, 64, 65, 1000])
def test_a_header_of_any_size_is_one_file(spark, count):
    got = rows(spark, wide(count))
    assert [len(got[n]) for n in ("files", "parts", "channels", "attributes")] == [1, count, count, count]
    marked = [x for x in got["channels"] if any(x.channel_fingerprint)]
    assert len(marked) == 1 and marked[0].part_index == 0
    root = scratch_path(spark, "wide")
    sinks.append_batch(lines(spark, wide(count)), root, 0)
    sinks.append_batch(lines(spark, wide(count + 70, "piz")), root, 1)
    sinks.merge_log(spark, root)
    sinks.append_batch(lines(spark, wide(count + 200, "piz")), root, 2)
    sinks.merge_log(spark, root)
    found = sinks.read_catalogue(spark, root)
    assert [(r.inspection_count, r.multipart_count) for r in found["files"].collect()] == [(3, 0)]
    assert found["parts"].count() in (count, count + 70)
    assert len({r.compression for r in found["parts"].collect()}) == 1


def test_batches_may_be_done_in_any_order(spark):
    root = scratch_path(spark, "order")
    sinks.append_batch(lines(spark, payload("a.exr")), root, 1)
    assert sinks.merge_log(spark, root) == 1
    sinks.append_batch(lines(spark, payload("b.exr")), root, 0)
    assert sinks.merge_log(spark, root) == 2
    assert sinks.read_catalogue(spark, root)["files"].count() == 2


def test_a_new_checkpoint_is_another_stream(spark):
    root = scratch_path(spark, "restart")
    for name in ("a.exr", "b.exr"):
        source = scratch_path(spark, "source")
        lines(spark, payload(name)).write.text(source)
        query = arrivals.start_ingest(arrivals.payload_stream(spark, source, "*.txt"), root, scratch_path(spark, "state"), interval=None)
        query.awaitTermination()
        sinks.merge_log(spark, root)
    assert sinks.read_catalogue(spark, root)["files"].count() == 2


def test_a_merge_writes_no_more_than_its_batch_brings(spark):
    root = scratch_path(spark, "cost")
    sinks.append_batch(lines(spark, *[payload(f"{i}.exr") for i in range(50)]), root, 0)
    sinks.merge_log(spark, root)
    sinks.append_batch(lines(spark, payload("late.exr"), payload("0.exr")), root, 1)
    version = sinks.merge_log(spark, root)
    counts = {n: spark.read.parquet(f"{root}/base/{n}/version={version}").count() for n in ("files", "known", "audit")}
    assert counts == {"files": 1, "known": 1, "audit": 2}


def test_half_done_merge_leaves_no_trace(spark, sf_dir):
    root = scratch_path(spark, "half")
    sinks.append_batch(lines(spark, FULL), root, 0)
    # What a merge that died before its commit leaves behind.
    spark.range(3).select(F.lit("junk").alias("file_id")).write.parquet(f"{root}/base/files/version=1")
    assert sinks.read_catalogue(spark, root)["files"].count() == 0
    assert sinks.merge_log(spark, root) == 1
    assert sinks.read_catalogue(spark, root)["files"].count() == 1
    # A batch whose data is there but not marked whole is left for later, also if a later one is done.
    sinks.append_batch(lines(spark, payload("c.exr")), root, 1)
    sinks.append_batch(lines(spark, payload("d.exr")), root, 2)
    shutil.rmtree(f"{root}/log/done/stream=batch/batch=1")
    assert sinks.merge_log(spark, root) == 2
    assert {r.file_path for r in sinks.read_catalogue(spark, root)["files"].collect()} == {FULL["file"]["path"], "d.exr"}


def test_upsert_is_order_independent(spark):
    ddl = "file_id string, header_hash string, last_inspected string, event_id long"
    batch = [("a", "1", "t1", 1), ("a", "2", "t0", 5), ("a", "3", "t0", 4), ("b", "4", "t2", 2), ("b", "5", "t3", 3)]
    existing = spark.createDataFrame(
        [("b", None, "s", 7, "s"), ("c", "9", "s", 1, "s")],
        "file_id string, header_hash string, inspection_timestamp string, inspection_count int, last_inspected string",
    )
    found = []
    for order in (batch, batch[::-1]):
        collapsed = upsert.collapse(spark.createDataFrame(order, ddl).repartition(3))
        found.append(sorted(map(tuple, upsert.upsert_files(existing, collapsed).collect())))
    assert found[0] == found[1] == [
        ("a", "3", "t0", 3, "t1"), ("b", None, "s", 9, "t3"), ("c", "9", "s", 1, "s"),
    ]


def test_read_payloads_keeps_bad_lines(spark):
    path = scratch_path(spark, "text")
    lines(spark, FULL, "{oops").coalesce(1).write.text(path)
    assert read_payloads(spark, path).count() == 2

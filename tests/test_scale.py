"""Hot keys, neighbours by brute force, plans, streams past their bounds."""

import io
import os
import pathlib
import subprocess
import sys
import time
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from framecat.operators import catalog, ingest, neighbours, quality, sinks, statistics, upsert
from framecat.plans import base, views
from framecat.session import scratch_path
from framecat.sources import objects, payloads
from framecat.streaming import arrivals


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def vectors_frame(spark, m):
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)


@pytest.fixture(scope="module")
def clustered():
    """Tight clusters, one of which holds a third of all rows as exact copies; a zero vector."""
    r = np.random.default_rng(7)
    centres = r.normal(size=(6, 12))
    m = centres[r.integers(0, 6, 240)] + r.normal(scale=0.15, size=(240, 12))
    m[:80] = m[0]
    m[100] = 0
    return m.astype(np.float32)


def brute_pairs(m, metric, bound):
    m = m.astype(np.float64)
    reps = {}
    for i, v in enumerate(m):
        reps.setdefault(v.tobytes(), []).append(i)
    out = {}
    keys = sorted((ids[0], len(ids)) for ids in reps.values())
    for x, (i, ni) in enumerate(keys):
        for j, nj in keys[x + 1:]:
            if metric == "euclidean":
                d = np.sqrt(((m[i] - m[j]) ** 2).sum())
            else:
                length = np.sqrt((m[i] ** 2).sum() * (m[j] ** 2).sum())
                d = 1 - m[i] @ m[j] / length if length else np.inf
            if d < bound:
                out[i, j] = (ni, nj, round(float(d), 6))
    return out


@pytest.mark.parametrize("metric, bound", [("cosine", 0.05), ("cosine", 0.9), ("euclidean", 0.6), ("euclidean", 3.0)])
@pytest.mark.parametrize("block_rows", [1000, 9])
def test_similar_pairs(spark, clustered, metric, bound, block_rows):
    found = neighbours.similar_pairs(vectors_frame(spark, clustered), metric, bound, block_rows=block_rows).collect()
    got = {(r.ref_id, r.similar_id): (r.ref_copies, r.similar_copies, round(r.distance, 6)) for r in found}
    assert len(got) == len(found)
    assert got == brute_pairs(clustered, metric, bound)


@pytest.mark.parametrize("metric, bound", [("cosine", 0.05), ("euclidean", 3.0)])
def test_similar_counts(spark, clustered, metric, bound):
    found = neighbours.similar_counts(vectors_frame(spark, clustered), metric, bound, block_rows=50).collect()
    m, want = clustered.astype(np.float64), {}
    pairs = brute_pairs(clustered, metric, bound)
    for i in range(len(m)):
        if metric == "cosine" and not m[i].any():
            continue
        same = [j for j in range(len(m)) if (m[j] == m[i]).all()]
        others = [(n[0] if b == same[0] else n[1], n[2]) for (a, b), n in pairs.items() if same[0] in (a, b)]
        nearest = 0.0 if len(same) > 1 else min((d for _, d in others), default=None)
        want[i] = (len(same) - 1 + sum(n for n, _ in others), nearest)
    got = {r.vec_id: r for r in found}
    assert len(found) == len(want) and {i: r.similar for i, r in got.items()} == {i: n for i, (n, _) in want.items()}
    assert {i: r.nearest for i, r in got.items()} == pytest.approx({i: d for i, (_, d) in want.items()}, abs=1e-6)


def far_clusters(n, clusters, seed=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, 16)) * 10
    return (centres[np.sort(r.integers(0, clusters, n))] + r.normal(scale=0.3, size=(n, 16))).astype(np.float32)


def test_blocks_that_cannot_meet_are_not_paired(spark):
    """On clustered data candidate pairs stay near those of the clusters, and their share falls as the table grows."""
    shares = []
    for n, clusters in ((2000, 20), (8000, 80)):
        copies = neighbours._keyed_copies(vectors_frame(spark, far_clusters(n, clusters)), "euclidean", "embedding", "vec_id")
        held = neighbours.vector_blocks(copies, "euclidean", 50)
        shares.append(neighbours.candidate_pairs(held, neighbours.meeting(held, "euclidean", 1.0)) / (n * (n - 1) / 2))
    assert shares[0] < 0.3 and shares[1] < shares[0] / 2


def test_lsh_finds_nine_pairs_in_ten(spark):
    m = far_clusters(1500, 60, 11)
    m[:400] = m[0]
    df = vectors_frame(spark, m)
    exact = {(r.ref_id, r.similar_id): r.distance for r in neighbours.similar_pairs(df, "cosine", 0.3).collect()}
    for rows in (1024, 20):
        found = neighbours.similar_pairs_lsh(df, "cosine", 0.3, block_rows=rows).collect()
        got = {(r.ref_id, r.similar_id): r.distance for r in found}
        assert len(got) == len(found) and got.items() <= {k: exact[k] for k in got}.items()
        assert len(got) >= 0.9 * len(exact) > 1000


def test_partners_unfold_copies(spark, clustered):
    df = vectors_frame(spark, clustered)
    pairs = neighbours.similar_pairs(df, "euclidean", 0.6)
    members = neighbours.copy_map(df, neighbours.vector_copies(df))
    asked = df.filter("vec_id in (3, 200)").select("vec_id")
    got = {(r.vec_id, r.similar_id) for r in neighbours.partners(pairs, members, asked).collect()}
    m = clustered.astype(np.float64)
    want = {
        (i, j) for i in (3, 200) for j in range(len(m)) if i != j and np.sqrt(((m[i] - m[j]) ** 2).sum()) < 0.6
    }
    assert got == want


@pytest.mark.parametrize("metric", neighbours.METRICS)
def test_batch_knn_in_blocks_of_any_size(spark, clustered, metric):
    df = vectors_frame(spark, clustered)
    asked = df.filter("vec_id % 4 = 0")
    few = neighbours.batch_knn(asked, df, 7, metric)
    many = neighbours.batch_knn(asked, df, 7, metric, block_rows=33)
    m = clustered.astype(np.float64)
    want = []
    for q in range(0, len(m), 4):
        scored = []
        for j in range(len(m)):
            dot, length = m[q] @ m[j], np.sqrt((m[q] ** 2).sum() * (m[j] ** 2).sum())
            d = {"dot_product": -dot, "euclidean": np.sqrt(((m[q] - m[j]) ** 2).sum())}.get(metric)
            if metric == "cosine":
                d = 1 - np.clip(dot / length, -1, 1) if length else None
            if d is not None:
                scored.append((round(float(d), 9), j))
        want += [(q, r + 1, d) for r, (d, _) in enumerate(sorted(scored)[:7])]
    for found in (few, many):
        got = sorted((r.query_id, r.rank, r.distance) for r in found.collect())
        assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in sorted(want)], abs=1e-7)


def test_knn_filters_first(spark, clustered):
    df = vectors_frame(spark, clustered)
    found = neighbours.knn(df, [1.0] * 12, "cosine", 5, where=F.col("vec_id") > 200)
    assert all(r.vec_id > 200 for r in found.collect())
    text = plan(found)
    assert "TakeOrderedAndProject" in text
    lines = text[: text.index("(1)")] if "(1)" in text else text
    assert lines.index("ArrowEvalPython") < lines.rindex("Filter")


def test_compression_summary_with_a_hot_file(spark):
    parts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("file_id"),
        F.when(F.col("id") % 2 == 0, "zip").otherwise("piz").alias("compression"),
    )
    files = spark.range(3000).select(F.col("id").alias("file_id"), F.lit(2**30).cast("bigint").alias("size_bytes"))
    got = {r.compression: (r.file_count, r.total_gb) for r in catalog.compression_summary(files, parts).collect()}
    assert got == {"zip": (1001, 1500.0), "piz": (1001, 1500.0)}
    once = {r.compression: r.total_gb for r in catalog.compression_summary_once(files, parts).collect()}
    assert once == {"zip": 1001.0, "piz": 1001.0}


def test_content_hash_tells_changes(spark):
    s = spark.range(100).select((F.col("id") % 2).alias("c"), F.col("id").alias("p"), (F.col("id") * 3).alias("v"))

    def hashes(df):
        return {r.c: r.pixel_hash_sampled for r in statistics.content_hash(df, "c", "p", "v").collect()}

    base = hashes(s)
    assert hashes(s.orderBy(F.desc("p")).repartition(5)) == base
    assert hashes(s.withColumn("v", F.when(F.col("p") == 4, 1).otherwise(F.col("v"))))[0] != base[0]
    assert hashes(s.unionByName(s.filter("p = 1")))[1] != base[1]
    assert hashes(s.filter("p <> 1"))[1] != base[1]


def test_scan_is_pruned_and_pushed_down(spark, sf_dir):
    text = plan(payloads.read_table(spark, f"{sf_dir}/orders.parquet", columns=["o_orderkey"], predicate=F.col("o_orderstatus") == "F"))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "o_orderpriority" not in text


def test_summary_needs_no_position_window(spark, sf_dir):
    text = plan(catalog.compression_summary(views.files(spark, sf_dir), views.parts(spark, sf_dir), "file_key"))
    assert "Window" not in text


def test_months_are_pruned(spark, sf_dir):
    path = scratch_path(spark, "months")
    sinks.write_partitioned(views.identified(views.files(spark, sf_dir)).drop("mtime_ts"), path)
    one = spark.read.parquet(path).filter("year_month = '1996-03'")
    assert "PartitionFilters: [isnotnull(year_month" in plan(one)
    names = one.select(F.input_file_name()).distinct().collect()
    assert names and all("year_month=1996-03" in r[0] for r in names)


def test_header_scan_reads_a_prefix_and_tells_errors(spark, sf_dir):
    listed = objects.list_objects(spark, sf_dir, ".PARQUET")

    def decode(head):
        if len(head) < 16:
            raise ValueError("short")
        return {"n": len(head), "magic": head[:4].decode()}

    full = objects.header_scan(listed, decode, "n bigint, magic string", n=16).collect()
    assert len(full) == 14 and {(r.n, r.magic, r.error) for r in full} == {(16, "PAR1", None)}
    bad = objects.header_scan(listed, decode, "n bigint, magic string", n=4).collect()
    assert {r.error for r in bad} == {"ValueError: short"}
    gone = listed.limit(1).select(F.lit("file:///tmp/no-such-object").alias("path"), "length")
    assert objects.header_scan(gone, decode, "n bigint").first().error.startswith("FileNotFoundError")


def test_names_of_objects_are_taken_as_they_are(spark, tmp_path):
    for name in ("a b.txt", "c%20d.txt", "e#f.txt"):
        (tmp_path / name).write_text("x" * 9)
    listed = objects.list_objects(spark, str(tmp_path), ".txt")
    assert {(r.n, r.error) for r in objects.header_scan(listed, lambda b: {"n": len(b)}, "n bigint", n=4).collect()} == {(4, None)}
    paths = {
        "s3a://b/k k/x%20.exr": ("s3://b", "b/k k/x%20.exr"), "s3n://b/x": ("s3://b", "b/x"), "gs://b/x": ("gs://b", "b/x"),
        "hdfs://h:1/d/x": ("hdfs://h:1/", "/d/x"), "dbfs:/d/x": ("", "/dbfs/d/x"), "file:/d/x": ("", "/d/x"), "file:///d/x": ("", "/d/x"),
    }
    assert {p: objects.store_and_name(p) for p in paths} == paths


def test_late_arrivals_are_left_out(spark):
    path, out, state = (scratch_path(spark, n) for n in ("late", "counts", "state"))
    ddl = "event_id long, ts timestamp"

    def arrive(*rows):
        df = spark.createDataFrame([(i, t) for i, t in rows], "event_id long, ts string")
        df.select("event_id", F.to_timestamp("ts").alias("ts")).coalesce(1).write.mode("append").parquet(path)

    def run():
        events = spark.readStream.schema(ddl).parquet(path)
        counted = arrivals.arrivals_per_minute(events, late="10 minutes")
        query = counted.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state)
        query.trigger(availableNow=True).start(out).awaitTermination()

    arrive((1, "2024-01-01 00:00:10"), (2, "2024-01-01 00:00:20"))
    run()
    arrive((3, "2024-01-01 01:00:00"))
    run()
    arrive((4, "2024-01-01 00:00:30"), (5, "2024-01-01 02:00:00"))
    run()
    got = {(str(r.minute), r.files) for r in spark.read.parquet(out).collect()}
    assert ("2024-01-01 00:00:00", 2) in got
    assert all(files <= 2 for _, files in got)


def test_shared_folder_is_named_by_the_session():
    class Context:
        master, applicationId = "spark://somewhere", "app"

        def __init__(self, **conf):
            self.conf = conf

        def getConf(self):
            return self.conf

    class Session:
        def __init__(self, **conf):
            self.conf, self.sparkContext = conf, Context(**conf)

    named = Session(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_path(named, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(ValueError):
        scratch_path(Session(), "x")


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "dot_product"])
def test_damaged_vectors_are_left_out_alike(spark, metric):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.5, 1.0]), (3, [nan, 1.0]), (4, None), (5, [1.0]), (6, [inf, 1.0]), (7, [1.0, None])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = {r.vec_id: r.distance for r in neighbours.knn(df, [1.0, 0.5], metric, 9).collect()}
    assert set(one) == {1, 2}
    asked = spark.createDataFrame([(9, [1.0, 0.5]), (10, [nan, 1.0]), (11, None)], df.schema)
    for rows in (1000, 1):
        got = neighbours.batch_knn(asked, df, 9, metric, block_rows=rows).collect()
        assert {(r.query_id, r.id): r.distance for r in got} == pytest.approx({(9, i): d for i, d in one.items()})


def test_a_payload_text_finds_files_like_it(spark, sf_dir):
    lines = base.payload_lines(spark, sf_dir).orderBy("file_key")
    stored = base.embedded_files(spark, sf_dir)
    one = lines.limit(1).select("value")
    found = neighbours.nearest_to(stored, ingest.payload_vectors(one).withColumnRenamed("metadata_embedding", "query"), k=3, vector="metadata_embedding", id="file_key")
    text = plan(found)
    assert "TakeOrderedAndProject" in text and "BroadcastNestedLoopJoin" in text
    rows = found.collect()
    assert rows[0].file_key == lines.first().file_key and rows[0].distance == pytest.approx(0, abs=1e-6)
    assert ingest.payload_vectors(spark.createDataFrame([("{broken",)], "value string")).count() == 0


def test_newest_version_is_one_row_also_on_ties(spark):
    rows = [("b", "p", "1", "x", 1), ("b", "p", "2", "y", 2), ("b", "p", "2", "y", 2), ("b", "p", "2", "y", 3), (None, "p", "1", "z", 4), (None, "p", "1", "z", 4)]
    df = spark.createDataFrame(rows, "s3_bucket string, file_path_normalized string, mtime string, file_id string, size int")
    assert sorted(map(tuple, upsert.latest_version(df).collect()), key=str) == sorted([("b", "p", "2", "y", 3), (None, "p", "1", "z", 4)], key=str)
    narrow = upsert.latest_version(df.drop("size"))
    assert "Join" not in plan(narrow) and narrow.count() == 2


def test_stored_parts_join_without_exchange_or_window(spark, sf_dir):
    held = [base.stored(spark, sf_dir, n) for n in ("channels", "parts")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalog.channels_with_parts(*held, "file_key"))
        assert "Exchange" not in text and "Window" not in text and "SortMergeJoin" in text
        hashed = plan(base.structures(spark, sf_dir))
        assert hashed.count("Scan parquet") / 2 <= 4 and "Window" not in hashed  # each is named twice
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_flushes_by_size_and_by_time(spark):
    """Five files arrive for flushes of two; the odd one leaves by time."""
    path, out, state = (scratch_path(spark, n) for n in ("flush-in", "flush-out", "state"))
    rows = spark.range(25).select((F.col("id") % 5).alias("n"), F.concat(F.lit("line "), F.col("id")).alias("value"))
    rows.repartition(5, "n").write.partitionBy("n").text(path)
    lines = spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(path)
    named = lines.select("value", F.input_file_name().alias("name"))
    query = arrivals.flushed(named, 2, "1 second").writeStream.format("parquet").option("checkpointLocation", state)
    query = query.trigger(processingTime="200 milliseconds").start(out)
    try:
        for _ in range(240):
            time.sleep(0.5)
            found = spark.read.schema("lane long, flush long, cause string, name string, value string").parquet(out).collect() if os.path.isdir(out) else []
            if len(found) == 25:
                break
    finally:
        query.stop()
    assert {r.value for r in found} == {f"line {i}" for i in range(25)} and len(found) == 25
    files = {}
    for r in found:
        files.setdefault((r.flush, r.cause), set()).add(r.name)
    assert sorted((len(v), cause) for (_, cause), v in files.items()) == [(1, "time"), (2, "size"), (2, "size")]
    assert sum(map(len, files.values())) == 5  # no file in two flushes


def test_running_audit_drops_idle_state_and_keeps_late_events(spark):
    path, out, state = (scratch_path(spark, n) for n in ("audit-in", "audit-out", "state"))
    seen = []

    def arrive(*rows):
        df = spark.createDataFrame(list(rows), "file_id string, ts string").select("file_id", F.to_timestamp("ts").alias("ts"))
        df.coalesce(1).write.mode("append").parquet(path)

    def keep(batch, number):
        batch.coalesce(1).write.mode("append").parquet(out)

    def run(idle):
        events = spark.readStream.schema("file_id string, ts timestamp").parquet(path)
        writer = arrivals.running_audit(events, idle=idle).writeStream.outputMode("update").foreachBatch(keep)
        query = writer.option("checkpointLocation", state).start()
        arrivals.stop_when_quiet(query)
        seen.append([p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]])

    arrive(("a", "2024-01-01 00:00:10"), ("a", "2024-01-01 00:00:20"), ("b", "2024-01-01 00:00:30"))
    run("1 millisecond")
    time.sleep(0.1)
    arrive(("c", "2024-01-02 00:00:00"))
    run("1 hour")  # a and b are over by now
    arrive(("a", "2023-12-31 00:00:00"))  # very late, after its state is gone
    run("1 hour")
    log = spark.read.parquet(out)
    got = {r.file_id: (str(r.first_seen), str(r.last_inspected), r.inspection_count) for r in arrivals.audit_of(log).collect()}
    assert got == {
        "a": ("2023-12-31 00:00:00", "2024-01-01 00:00:20", 3),
        "b": ("2024-01-01 00:00:30", "2024-01-01 00:00:30", 1),
        "c": ("2024-01-02 00:00:00", "2024-01-02 00:00:00", 1),
    }
    assert log.filter("closed").count() == 2 and seen[1][-1] == 1
    assert arrivals.audit_of(log.unionByName(log)).count() == 3


def test_upsert_writes_touched_buckets_only(spark):
    known = spark.range(2000).select(
        F.col("id").cast("string").alias("file_id"), F.lit("h").alias("header_hash"), F.lit("2024-01-01").alias("inspection_timestamp"),
        F.lit(1).alias("inspection_count"), F.lit("2024-01-01").alias("last_inspected"),
    )
    batch = spark.createDataFrame([("7", "x", "2024-02-01", 1), ("new", "y", "2024-02-02", 2)], "file_id string, header_hash string, last_inspected string, event_id long")
    folded = upsert.collapse(batch)
    for rows, buckets in ((500, 8), (2000, 64)):
        path = scratch_path(spark, "buckets")
        sinks.write_buckets(known.limit(rows), path, buckets)
        before = {str(f) for f in pathlib.Path(path).rglob("*.parquet")}
        touched = sinks.upsert_buckets(folded, path, known.schema, buckets)
        after = {str(f) for f in pathlib.Path(path).rglob("*.parquet")}
        assert touched <= 2 and len(after - before) <= 2 and len(before - after) <= 2
        back = {r.file_id: r for r in spark.read.schema(known.schema).parquet(path).collect()}
        assert len(back) == rows + 1 and back["7"].inspection_count == 2 and back["7"].header_hash == "h" and back["new"].header_hash == "y"
    assert sinks.upsert_buckets(folded.limit(0), path, known.schema, 64) == 0


def test_types_of_the_last_element_and_undeclared_fields_are_told(spark):
    lines = spark.createDataFrame(
        [('{"parts":[{"w":1},{"w":"2","extra":[1]}],"deep":[[{"n":1}],[{"n":"x"},{}]]}',), ('{"parts":null}',), ("{broken",), ('{"parts":[]}',)], "value string"
    )
    told = {r.field: (r.missing, r.wrong_type, r.expected) for r in quality.check_types(lines, {"$.parts[*].w": "int", "$.parts": "array", "$.deep[*][*].n": "string", "$.deep[*]": "array"}).collect()}
    assert told == {"$.parts[*].w": (0, 1, 2), "$.parts": (1, 1, 4), "$.deep[*][*].n": (1, 1, 3), "$.deep[*]": (0, 0, 2)}
    extra = quality.undeclared_fields(lines, {"$.parts[*]": ["w"], "$": ["parts"]}).collect()
    assert {(r.path, r.field, r.row_count) for r in extra} == {("$.parts[*]", "extra", 1), ("$", "deep", 1)}


def test_copies_that_differ_in_one_cell_are_told(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    wrong = df.withColumn("v", F.when(F.col("id") == 3, 9).otherwise(F.col("v")))
    told = {r.table_name: (r.rows, r.copied, r.same) for r in sinks.same_contents({"a": df, "b": df}, {"a": df.orderBy(F.desc("id")), "b": wrong}).collect()}
    assert told == {"a": (100, 100, True), "b": (100, 100, False)}


def test_backfill_of_variants_parses_no_text(spark, sf_dir):
    kept = base.payload_variants(spark, sf_dir)
    text = plan(ingest.backfill(kept, "$.file.frame_number", "int", "n"))
    assert "parse_json" not in text


def test_objects_are_listed_by_prefix_in_tasks(spark, tmp_path):
    for name, size in (("top.exr", 3), ("a/one.EXR", 5), ("a/deep/two.exr", 9), ("b/three.exr", 50), ("b/four.txt", 4), ("c d%/five.exr", 7)):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
    opened = str(tmp_path / "b" / "three.exr")

    def decode(head):
        if len(head) > 8:
            raise ValueError("long")
        return {"n": len(head)}

    for depth in (1, 2, 3):
        rows = objects.scan(spark, str(tmp_path), decode, "n bigint", 9, ".exr", depth).collect()
        got = {os.path.relpath(r.path, tmp_path): (r.length, r.n, r.error) for r in rows}
        assert got == {
            "top.exr": (3, 3, None), "a/one.EXR": (5, 5, None), "a/deep/two.exr": (9, None, "ValueError: long"),
            "b/three.exr": (50, None, "ValueError: long"), "c d%/five.exr": (7, 7, None),
        }
    assert objects.scan(spark, str(tmp_path), suffix=".exr").rdd.getNumPartitions() == 4  # the top, a, b, c
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        os.chmod(opened, 0)
        few = objects.scan(spark, str(tmp_path), decode, "n bigint", 9, ".exr").filter("length < 6 and length >= 4")
        assert [(r.length, r.n) for r in few.collect()] == [(5, 5)]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


@pytest.mark.parametrize("missing", ["framecat.llm", "xxhash"])
def test_other_queries_load_without_the_subpackage(missing):
    """As when its files are gone but their folder stays, or a library is not there."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op')])"
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=top, capture_output=True, text=True, check=True).stdout
    count, names = out.split(" ", 1)
    assert int(count) > 90 and names.strip() == "[]"

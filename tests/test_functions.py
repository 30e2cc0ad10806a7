"""Column functions on hand-made values."""

import math

import pytest
from pyspark.sql import functions as F

from framecat.functions import arrow_vectors, codecs, keys, structure, values, vectors
from framecat.sources.payloads import event_location


def one(spark, column, **given):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in given.items()]).select(column.alias("x"))
    return row.first()[0]


@pytest.mark.parametrize(
    "key, wanted",
    [
        ("shot/beauty.0001.exr", 1),
        ("shot/beauty_1001.EXR", 1001),
        ("shot/beauty.12.exr", None),
        ("shot/beauty.123456789.exr", None),
        ("shot/beauty.12345678.exr", 12345678),
        ("shot/beauty0001.exr", None),
        ("shot/beauty.0001.exr.bak", None),
    ],
)
def test_frame_number(spark, key, wanted):
    assert one(spark, keys.frame_number(F.col("k")), k=key) == wanted


@pytest.mark.parametrize(
    "path, wanted",
    [
        ("/data/test.exr", "/data/test.exr"),
        ("/Data/Test.EXR", "/data/test.exr"),
        ("data/test.exr", "data/test.exr"),
        ("A\\b\\..\\c//./D.exr", "a/c/d.exr"),
        ("A/b/../c//./D.exr", "a/c/d.exr"),
        ("./a/b/", "a/b"),
        ("/../a", "/a"),
        ("/a/.", "/a"),
        ("/a/b../c", "/a/b../c"),
    ],
)
def test_normalize_path(spark, path, wanted):
    assert one(spark, keys.normalize_path(F.col("p")), p=path) == wanted


@pytest.mark.parametrize(
    "key, wanted",
    [("a/b.exr", ".exr"), ("a/b.tar.EXR", ".exr"), ("a/.exr", ""), (".exr", ""), ("a.d/b", ""), ("b.", ".")],
)
def test_suffix(spark, key, wanted):
    assert one(spark, keys.suffix(F.col("k")), k=key) == wanted


def test_iso_text(spark):
    ts = F.lit("2024-01-01 00:00:07.170000").cast("timestamp_ntz")
    assert one(spark, keys.iso_utc(ts), k=1) == "2024-01-01T00:00:07.170000+00:00"
    assert one(spark, keys.iso_utc(F.lit("2024-01-01").cast("timestamp_ntz")), k=1) == "2024-01-01T00:00:00+00:00"
    assert one(spark, keys.iso_utc_from_epoch(F.lit(1.5)), k=1) == "1970-01-01T00:00:01.500000+00:00"


@pytest.mark.parametrize(
    "text, kind, whole, number, string",
    [
        ("3", "int", 3, 3.0, None),
        ("3.0", "float", None, 3.0, None),
        ("2.5", "float", None, 2.5, None),
        ("true", "bool", None, None, None),
        ('"x"', "string", None, None, "x"),
        ("null", "null", None, None, None),
        ("[1,2]", "array", None, None, None),
        ('{"a":1}', "object", None, None, None),
    ],
)
def test_attribute_values(spark, text, kind, whole, number, string):
    v = values.variant(F.col("t"))
    assert one(spark, values.kind(v), t=text) == kind
    shadows = values.attribute_values(v)
    assert one(spark, shadows["value_json"], t=text) == text
    assert one(spark, shadows["value_int"], t=text) == whole
    assert one(spark, shadows["value_float"], t=text) == number
    assert one(spark, shadows["value_text"], t=text) == string


@pytest.mark.parametrize(
    "text, wanted",
    [("null", False), ("false", False), ("0", False), ("0.0", False), ('""', False), ("[]", False), ("{}", False),
     ("true", True), ("1", True), ('"a"', True), ("[0]", True), ('{"a":0}', True)],
)
def test_truthy(spark, text, wanted):
    assert one(spark, values.truthy(values.variant(F.col("t"))), t=text) is wanted


@pytest.mark.parametrize(
    "text, wanted",
    [
        ('{"min":{"x":-1,"y":2},"max":{"x":3,"y":4}}', (-1, 2, 3, 4)),
        ('{"xMin":-1,"yMin":2,"xMax":3,"yMax":4}', (-1, 2, 3, 4)),
        ('{"min":{"x":1}}', (1, 0, 0, 0)),
        ("{}", (0, 0, 0, 0)),
        ('{"min":{"x":"a"}}', None),
        ('{"min":5}', None),
        ('{"min":null}', None),
        ('"oops"', None),
        ("[1,2]", None),
        ("null", None),
    ],
)
def test_window_ints(spark, text, wanted):
    found = one(spark, values.window_ints(values.variant(F.col("t"))), t=text)
    assert (tuple(found) if found else None) == wanted


def test_compression_score(spark):
    scores = {n: one(spark, codecs.compression_score(F.col("c")), c=n) for n in ("zip", "ZIP", "Zip", "odd")}
    assert scores["zip"] == scores["ZIP"] == scores["Zip"] == 0.5
    assert 0 < scores["odd"] < 1


def test_event_location(spark):
    def located(path, data):
        found = event_location(F.col("p"), F.col("d"))
        row = spark.createDataFrame([(path, data)], "p string, d string")
        return tuple(row.select(*[c.alias(n) for n, c in found.items()]).first())

    data = '{"s3_bucket":"b2","s3_key":"k2"}'
    assert located("b/k/x.exr", data) == ("b", "k/x.exr")
    assert located("b", data) == ("b2", "k2")
    assert located("b/", data) == ("b2", "k2")
    assert located(None, data) == ("b2", "k2")
    assert located(None, None) == (None, None)


def channels(spark, rows):
    ddl = "channels array<struct<name: string, type: string, x_sampling: int, y_sampling: int>>"
    return spark.createDataFrame([([tuple(r) for r in rows],)], ddl)


def test_channel_fingerprint(spark):
    def fp(rows, dim=128):
        return channels(spark, rows).select(vectors.channel_fingerprint(F.col("channels"), dim)).first()[0]

    rgb = [("R", "float", 1, 1), ("G", "float", 1, 1), ("B", "float", 1, 1)]
    v = fp(rgb)
    assert len(v) == 128 and v == fp(rgb)
    assert math.isclose(sum(x * x for x in v), 1, abs_tol=1e-9)
    assert fp([]) == [0.0] * 128
    assert fp([("R", "float", None, None)]) == fp([("R", "float", 1, 1)])
    assert fp([("R", "FLOAT", 1, 1)]) == fp([("R", "float", 1, 1)])
    other = fp([("R", "half", 2, 2), ("G", "float", 1, 1)])
    assert max(abs(a - b) for a, b in zip(v, other)) > 0.01
    assert len(fp(rgb, 5)) == 5
    # features before scaling: 3/64, no layers, samplings 1/2, all float
    ratio = [x / v[2] for x in v[:8]]
    assert ratio == pytest.approx([3 / 64 / 0.5, 0, 1, 1, 2, 0, 0, 0])


def structures(spark, n=3):
    ddl = f"structure struct<{'part_count: bigint, channel_count: bigint, is_deep: boolean, is_tiled: boolean, has_multiview: boolean, codec: string, header_digest: string, structure_digest: string'}>"
    rows = [((i, 2 * i, i == 1, True, False, "piz", "h", f"digest {i}"),) for i in range(n)]
    return spark.createDataFrame(rows, ddl)


@pytest.mark.parametrize("dim", [4, 6, 64, 128, 256, 384, 512])
def test_embedding_forms_agree(spark, dim):
    s = structures(spark)
    a = s.select(vectors.metadata_embedding(F.col("structure"), dim)).collect()
    b = s.select(arrow_vectors.metadata_embedding(F.col("structure"), dim)).collect()
    for x, y in zip(a, b):
        assert len(x[0]) == len(y[0]) == dim
        assert y[0] == pytest.approx(x[0], abs=1e-7)
        assert sum(v * v for v in x[0]) == pytest.approx(1)


def test_short_vector_becomes_uniform(spark):
    v = spark.createDataFrame([([0.0, 0.0, 0.0, 0.0],)], "v array<double>")
    assert v.select(vectors.l2_normalize(F.col("v"))).first()[0] == [0.5] * 4


def test_distances(spark):
    v = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, z array<double>")
    a, z, q = F.col("a"), F.col("z"), vectors.literal([4.0, 3.0])
    row = v.select(
        vectors.l2_distance(a, q), vectors.cosine_distance(a, q), vectors.inner_product(a, q),
        vectors.cosine_distance(z, q), arrow_vectors.distance_to("cosine", a, [4.0, 3.0]),
        arrow_vectors.distance_to("cosine", z, [4.0, 3.0]), arrow_vectors.distance_to("euclidean", a, [1.0]),
    ).first()
    assert row[0] == pytest.approx(2**0.5) and row[1] == pytest.approx(0.04) and row[2] == 24
    assert row[3] is None and row[4] == pytest.approx(0.04)
    assert row[5] is None and row[6] is None


def test_set_digest_forms_agree(spark):
    rows = spark.range(200).select((F.col("id") % 7).alias("k"), F.md5(F.col("id").cast("string")).alias("h"))
    gathered = rows.groupBy("k").agg(F.shuffle(F.collect_list("h")).alias("hs"))
    a = gathered.select("k", structure.set_digest(F.col("hs")).alias("d"))
    b = rows.groupBy("k").agg(structure.set_digest_agg(F.col("h")).alias("d"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_hashes_tell_rows_apart_whose_fields_join_to_one_text(spark):
    from framecat.functions import keys, structure

    pairs = spark.createDataFrame([("a", "b/c.exr", "x|y", ""), ("ab", "/c.exr", "x", "y|")], "bucket string, key string, p string, q string")
    ids = pairs.select(keys.content_id(F.col("bucket"), F.col("key"), F.lit("t"), F.lit("h")).alias("id")).collect()
    assert ids[0].id != ids[1].id
    texts = pairs.select(F.md5(structure._row_text(F.col, ("p", "q"))).alias("h")).collect()
    assert texts[0].h != texts[1].h

"""Queries of sources, projections and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framecat.functions import channels as ch
from framecat.functions import codecs, keys, structure, values
from framecat.operators import catalog
from framecat.plans import base, views
from framecat.session import scratch_path
from framecat.sources import objects, payloads

REFERENCE_TIME = "1998-08-01 00:00:00"


PREFIX = 200


SHARDS = 16


def _objects(spark: SparkSession, sf: str) -> str:
    """The documents' texts as one object each below some prefixes, a line end behind each."""
    path = scratch_path(spark, "objects")
    shard = F.pmod("doc_id", F.lit(SHARDS))
    folder, name = (F.coalesce(c.cast("string"), F.lit("none")) for c in (shard, F.col("doc_id")))
    key = F.concat(F.lit("shard="), folder, F.lit("/doc_id="), name, F.lit(".txt"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(key.alias("key"), F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).alias("text"))
    objects.put_objects(docs, path)
    return path


def _id_of(path: str) -> Column:
    return F.regexp_extract(path, r"doc_id=([0-9]+)\.txt$", 1).cast("bigint").alias("doc_id")


def list_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Listed twice, in tasks by prefix and by Spark; both have all objects."""
    path = _objects(spark, sf)
    by_prefix = objects.scan(spark, path, suffix=".txt").select(_id_of("path"), F.col("length").alias("size"))
    listed = objects.list_objects(spark, path, ".txt").select(_id_of("path"), F.col("length").alias("listed_size"))
    return by_prefix.join(listed, "doc_id", "full_outer")


def header_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """The first bytes of every object; some objects are shorter."""

    def decode(head: bytes) -> dict:
        return {"head": head.hex().upper(), "read": len(head)}

    scanned = objects.scan(spark, _objects(spark, sf), decode, "head string, read bigint", PREFIX, ".txt")
    return scanned.select(_id_of("path"), F.col("length").alias("size"), "head", "read", "error")


def read_payloads(spark: SparkSession, sf: str) -> DataFrame:
    parsed = payloads.parse_payloads(base.payload_lines(spark, sf))
    p = "payload."
    return parsed.select(
        "file_key",
        F.col(p + "file.path").alias("path"),
        F.col(p + "file.size_bytes").alias("size_bytes"),
        F.col(p + "file.frame_number").alias("frame_number"),
        F.size(p + "parts").alias("part_count"),
        F.size(p + "channels").alias("channel_count"),
        F.col(p + "_corrupt").isNotNull().alias("corrupt"),
    )


def suffix_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = payloads.suffix_filter(views.files(spark, sf))
    return kept.select("file_key", "s3_key", keys.suffix(F.col("s3_key")).alias("suffix"))


def event_location(spark: SparkSession, sf: str) -> DataFrame:
    """Even keys name their object in the element path, odd ones in the data."""
    f = views.files(spark, sf)
    even = F.col("file_key") % 2 == 0
    events = f.select(
        "file_key",
        F.when(even, F.concat_ws("/", "s3_bucket", "s3_key")).otherwise(F.lit("nowhere")).alias("path"),
        F.when(~even, F.to_json(F.struct("s3_bucket", "s3_key"))).alias("data"),
    )
    found = payloads.event_location(F.col("path"), F.col("data"))
    return events.select("file_key", *[c.alias(n) for n, c in found.items()])


def read_table(spark: SparkSession, sf: str) -> DataFrame:
    return payloads.read_table(
        spark,
        f"{sf}/orders.parquet",
        columns=["o_orderkey", "o_totalprice"],
        predicate=F.col("o_orderstatus") == "F",
    )


def frame_number(spark: SparkSession, sf: str) -> DataFrame:
    return views.files(spark, sf).select(
        "file_key", keys.frame_number(F.col("s3_key")).alias("frame_number")
    )


def split_channel(spark: SparkSession, sf: str) -> DataFrame:
    c = base.file_channels(spark, sf)
    name = F.col("channel_name")
    return c.select(
        "file_key", "part_index", "channel_name",
        ch.layer_name(name).alias("layer_name"), ch.component_name(name).alias("component_name"),
    )


def root_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Roots of the channel names as they are, and with a sub-layer put in."""
    c = base.file_channels(spark, sf)
    deeper = F.concat(F.lit("pass1."), F.col("channel_name"))
    return c.select(
        "file_key", "part_index", "channel_name",
        ch.root_layer(F.col("channel_name")).alias("root"),
        ch.layer_name(deeper).alias("deeper_layer"),
        ch.root_layer(deeper).alias("deeper_root"),
    )


def normalize_path(spark: SparkSession, sf: str) -> DataFrame:
    f = views.files(spark, sf)
    turn = F.col("file_key") % 3
    messy = (
        F.when(turn == 0, F.concat(F.lit("./"), F.col("s3_key")))
        .when(turn == 1, F.concat(F.translate("s3_key", "/", "\\"), F.lit("/")))
        .otherwise(F.replace(F.col("s3_key"), F.lit("/"), F.lit("//./")))
    )
    paths = f.select(messy.alias("path")).unionByName(
        views.table(spark, sf, "pages").select(F.col("url").alias("path"))
    )
    return paths.select("path", keys.normalize_path(F.col("path")).alias("normalized"))


def file_id(spark: SparkSession, sf: str) -> DataFrame:
    return views.identified(views.files(spark, sf)).select("file_key", "file_id", "mtime")


def header_hash(spark: SparkSession, sf: str) -> DataFrame:
    s = base.structures(spark, sf)
    hashed = structure.header_hash(
        F.col("structure.part_count"), F.col("structure.is_deep"), F.col("structure.header_digest")
    )
    return s.select("file_key", hashed.alias("header_hash"))


def content_id(spark: SparkSession, sf: str) -> DataFrame:
    h = base.hashed_files(spark, sf)
    found = keys.content_id(F.col("s3_bucket"), F.col("s3_key"), F.col("mtime"), F.col("header_hash"))
    return h.select("file_key", found.alias("content_id"))


def window_ints(spark: SparkSession, sf: str) -> DataFrame:
    p = base.indexed_parts(spark, sf)
    data = values.window_ints(values.variant(F.col("data_window_json")))
    display = values.window_ints(values.variant(F.col("display_window_json")))
    boxed = p.select("file_key", "part_index", data.alias("d"), display.alias("s"))
    return boxed.select(
        "file_key", "part_index",
        *[F.col(f"d.{n}").alias(f"data_{n}") for n in values.BOX_FIELDS],
        *[F.col(f"s.{n}").alias(f"display_{n}") for n in values.BOX_FIELDS],
    )


def display_dims(spark: SparkSession, sf: str) -> DataFrame:
    rows = base.stored(spark, sf, "parts", base.FILE_KEY)
    return rows.select(
        "file_key", "part_index", "display_width", "display_height", "data_x_offset", "data_y_offset"
    )


def file_flags(spark: SparkSession, sf: str) -> DataFrame:
    parsed = payloads.parse_payloads(base.payload_lines(spark, sf))
    parts = F.col("payload.parts")
    return parsed.select(
        "file_key",
        F.size(parts).alias("multipart_count"),
        F.exists(parts, lambda p: F.coalesce(p["is_deep"], F.lit(False))).alias("is_deep"),
    )


def compression_score(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the codecs, of their upper-case form, and of an unknown one."""
    p = base.indexed_parts(spark, sf)
    codec = F.col("compression")
    return p.select(
        "file_key", "part_index",
        codecs.compression_score(codec).alias("score"),
        codecs.compression_score(F.upper(codec)).alias("upper_score"),
        codecs.compression_score(F.concat(codec, F.lit("_x"))).alias("unknown_score"),
    )


def iso_utc(spark: SparkSession, sf: str) -> DataFrame:
    e = views.table(spark, sf, "events")
    return e.select("event_id", keys.iso_utc(F.col("ts")).alias("iso"))


def attribute_values(spark: SparkSession, sf: str) -> DataFrame:
    a = views.attributes(base.indexed_parts(spark, sf))
    found = values.attribute_values(values.variant(F.col("value_json")))
    return a.select(
        "file_key", "part_index", "attr_name", *[c.alias(n) for n, c in found.items()]
    )


def _nested(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as nested values with binary data, boxes, vectors and colours at several depths."""
    d = views.table(spark, sf, "documents")
    data, n, i = F.encode("text", "UTF-8"), F.col("n_chars").cast("long"), F.col("doc_id").cast("long")

    def corner(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    box = F.struct(corner(i, n).alias("min"), corner(i + 1, n + 1).alias("max"))
    value = F.struct(
        data.alias("raw"),
        F.array(F.struct(box.alias("box"), F.when(i % 2 == 0, F.encode("lang", "UTF-8")).alias("tag")), F.struct(box.alias("box"), data.alias("tag"))).alias("boxes"),
        F.create_map(F.lit("v"), F.struct(i.alias("x"), n.alias("y"), F.encode("source", "UTF-8").alias("z"))).alias("named"),
        F.struct(n.alias("r"), i.alias("g"), F.array(F.array(F.encode("lang", "UTF-8"))).alias("b")).alias("colour"),
        F.when(i % 3 == 0, F.lit(float("nan"))).otherwise(n / 4).alias("ratio"),
        F.when(i % 2 == 0, F.col("lang")).alias("word"),
    )
    return d.select("doc_id", value.alias("value"))


def json_safe(spark: SparkSession, sf: str) -> DataFrame:
    """All fields of the nested values, read back from their JSON."""
    made = _nested(spark, sf)
    text = values.json_safe_text(F.col("value"), made.schema["value"].dataType)
    read = made.select("doc_id", text.alias("j"))
    at = {
        "encoding": "$.raw.encoding", "data": "$.raw.data", "tag_0": "$.boxes[0].tag.data", "tag_1": "$.boxes[1].tag.data",
        "vector_z": "$.named.v.z.data", "colour_b": "$.colour.b[0][0].data", "ratio": "$.ratio", "word": "$.word",
    }
    numbers = {
        **{f"box_{k}_{side}_{axis}": f"$.boxes[{k}].box.{side}.{axis}" for k in (0, 1) for side in ("min", "max") for axis in "xy"},
        "vector_x": "$.named.v.x", "vector_y": "$.named.v.y", "colour_r": "$.colour.r", "colour_g": "$.colour.g",
    }
    return read.select(
        "doc_id",
        *[F.get_json_object("j", path).alias(n) for n, path in at.items() if n != "ratio"],
        F.get_json_object("j", "$.ratio").cast("double").alias("ratio"),
        *[F.get_json_object("j", path).cast("bigint").alias(n) for n, path in numbers.items()],
    )


def defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with fields taken out, filled in again."""
    rows = base.stored(spark, sf, "parts", base.FILE_KEY)
    lost = F.col("width") % 3 == 0

    def field(name: str):
        if name == "multi_view":
            return F.parse_json(F.col(name).cast("string"))
        if name in ("data_window", "display_window"):
            return F.parse_json(F.when(F.col(name) != "null", F.col(name)))
        if name == "part_index":
            return F.col(name)
        return F.when(~lost, F.col(name))

    part = F.struct(*[field(n).alias(n) for n in structure.PART_COLUMNS])
    return rows.select("file_key", part.alias("p")).select(
        "file_key", F.inline(F.array(structure.filled_part(F.col("p"))))
    )


def deep_files(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.deep_files(base.catalogue_files(spark, sf))
    return found.select("file_key", "file_path", "size_bytes", "multipart_count")


def uncompressed_or_oversized(spark: SparkSession, sf: str) -> DataFrame:
    f = views.files(spark, sf).withColumnRenamed("s3_key", "file_path")
    return catalog.uncompressed_or_oversized(f, views.parts(spark, sf), "file_key")


def overscan_parts(spark: SparkSession, sf: str) -> DataFrame:
    rows = base.stored(spark, sf, "parts", base.FILE_KEY)
    return catalog.overscan_parts(rows).select("file_key", "part_index", "data_x_offset", "data_y_offset")


def modified_within(spark: SparkSession, sf: str) -> DataFrame:
    at = F.lit(REFERENCE_TIME).cast("timestamp_ntz")
    return catalog.modified_within(views.files(spark, sf), 7, at).select("file_key", "size_bytes")


def _attributed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    f = views.files(spark, sf).withColumnRenamed("s3_key", "file_path")
    return f, base.stored(spark, sf, "attributes", base.FILE_KEY)


def attribute_like(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.attribute_like(*_attributed(spark, sf), "software", "#2", "file_key")


def attribute_named(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.attribute_named(*_attributed(spark, sf), "chromaticities", "file_key")


def find_file(spark: SparkSession, sf: str) -> DataFrame:
    """The file of the smallest id, looked up again by its path and hash."""
    h = base.hashed_files(spark, sf)
    want = h.select("file_path_normalized", "header_hash", "file_key").orderBy("file_key").first()
    found = catalog.find_file(h, want["file_path_normalized"], want["header_hash"])
    return found.select("file_key", "file_id", "header_hash")


QUERIES = {
    "list_objects_a1": list_objects,
    "header_prefix_scan_a2": header_prefix,
    "read_payloads_a3": read_payloads,
    "suffix_filter_a4": suffix_filter,
    "event_location_a5": event_location,
    "read_table_a6": read_table,
    "frame_number_b1": frame_number,
    "split_channel_b2": split_channel,
    "root_layer_b3": root_layer,
    "normalize_path_b4": normalize_path,
    "file_id_b5": file_id,
    "header_hash_b6": header_hash,
    "content_id_b7": content_id,
    "window_ints_b8": window_ints,
    "display_dims_b9": display_dims,
    "file_flags_b10": file_flags,
    "compression_score_b11": compression_score,
    "iso_utc_b12": iso_utc,
    "attribute_values_b13": attribute_values,
    "json_safe_b14": json_safe,
    "defaults_b15": defaults,
    "deep_files_b16": deep_files,
    "uncompressed_or_oversized_b17": uncompressed_or_oversized,
    "overscan_parts_b18": overscan_parts,
    "modified_within_b19": modified_within,
    "attribute_like_b20": attribute_like,
    "attribute_named_b21": attribute_named,
    "find_file_b22": find_file,
}

_F, _P, _C, _A = (views.sql_views(n) for n in ("files", "parts", "channels", "attributes"))
_FC = views.sql_views("files", "parts", "channels")
_FA = views.sql_views("files", "attributes")
_FRAME = "cast(nullif(regexp_extract({}, '(?i)[._]([0-9]{{3,8}})\\.exr$', 1), '') AS int)"
_SCORE = """CASE {} WHEN 'none' THEN 0.0 WHEN 'rle' THEN 0.2 WHEN 'zips' THEN 0.4 WHEN 'zip' THEN 0.5
  WHEN 'piz' THEN 0.6 WHEN 'pxr24' THEN 0.7 WHEN 'b44' THEN 0.8 WHEN 'b44a' THEN 0.85
  WHEN 'dwaa' THEN 0.9 WHEN 'dwab' THEN 0.95 ELSE 0.5 END::double"""

ORACLES = {
    "read_payloads_a3": base.structure_views()
    + """ SELECT file_key, s3_key AS path, size_bytes, cast(frame_digits AS int) AS frame_number,
          cast(part_count AS int) AS part_count, cast(channel_count AS int) AS channel_count,
          false AS corrupt FROM fx_structures""",
    "suffix_filter_a4": _F
    + " SELECT file_key, s3_key, '.exr' AS suffix FROM fx_files WHERE lower(s3_key) LIKE '%.exr'",
    "event_location_a5": _F + " SELECT file_key, s3_bucket, s3_key FROM fx_files",
    "read_table_a6": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
    "frame_number_b1": _F + f" SELECT file_key, {_FRAME.format('s3_key')} AS frame_number FROM fx_files",
    "split_channel_b2": _C
    + " SELECT file_key, part_index, channel_name, layer_name, component_name FROM fx_channels",
    "root_layer_b3": _C
    + """ SELECT file_key, part_index, channel_name, split_part(channel_name, '.', 1) AS root,
          CASE WHEN contains(channel_name, '.') THEN 'pass1.' || layer_name ELSE 'pass1' END AS deeper_layer,
          'pass1' AS deeper_root FROM fx_channels""",
    "normalize_path_b4": _F
    + """, paths AS (
          SELECT CASE file_key % 3 WHEN 0 THEN './' || s3_key WHEN 1 THEN replace(s3_key, '/', chr(92)) || '/'
                 ELSE replace(s3_key, '/', '//./') END AS path FROM fx_files
          UNION ALL SELECT url FROM pages)
        SELECT path, regexp_replace(regexp_replace(regexp_replace(lower(replace(path, chr(92), '/')),
               '/(\\.?/)+', '/', 'g'), '^\\./', ''), '(.)/\\.?$', '\\1') AS normalized FROM paths""",
    "file_id_b5": _F + " SELECT file_key, file_id, mtime FROM fx_ids",
    "header_hash_b6": base.structure_views() + " SELECT file_key, header_hash FROM fx_hashed",
    "list_objects_a1": "SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, strlen(coalesce(text, '')) + 1 AS listed_size FROM documents",
    "header_prefix_scan_a2": f"""SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
          substr(hex(coalesce(text, '') || chr(10)), 1, {2 * PREFIX}) AS head,
          least({PREFIX}, strlen(coalesce(text, '')) + 1) AS read, NULL::varchar AS error FROM documents""",
    "content_id_b7": base.structure_views()
    + " SELECT file_key, sha256(concat_ws(chr(10), s3_bucket, s3_key, mtime, header_hash)) AS content_id FROM fx_hashed",
    "window_ints_b8": _P
    + """ SELECT file_key, part_index, x0 AS data_min_x, x0 AS data_min_y, x0 + width - 1 AS data_max_x,
          x0 + height - 1 AS data_max_y,
          CASE WHEN is_tiled AND NOT broken THEN 0 END AS display_min_x,
          CASE WHEN is_tiled AND NOT broken THEN 0 END AS display_min_y,
          CASE WHEN is_tiled AND NOT broken THEN width + 9 END AS display_max_x,
          CASE WHEN is_tiled AND NOT broken THEN height + 9 END AS display_max_y FROM fx_parts""",
    "display_dims_b9": _P
    + """ SELECT file_key, part_index, display_width, display_height, data_x_offset, data_y_offset
          FROM fx_part_rows""",
    "file_flags_b10": views.sql_views("files", "parts")
    + """ SELECT file_key, cast(count(part_index) AS int) AS multipart_count,
          coalesce(bool_or(is_deep), false) AS is_deep
          FROM fx_files LEFT JOIN fx_part_rows USING (file_key) GROUP BY file_key""",
    "compression_score_b11": _P
    + f""" SELECT file_key, part_index, {_SCORE.format('compression')} AS score,
          {_SCORE.format('compression')} AS upper_score, 0.5::double AS unknown_score FROM fx_parts""",
    "iso_utc_b12": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S')
          || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END
          || '+00:00' AS iso FROM events""",
    "attribute_values_b13": _A
    + """ SELECT file_key, part_index, attr_name, value_json, value_text, value_int, value_float
          FROM fx_attributes""",
    "json_safe_b14": """SELECT doc_id, 'base64' AS encoding, base64(encode(text)) AS data,
          CASE WHEN doc_id % 2 = 0 THEN base64(encode(lang)) END AS tag_0, base64(encode(text)) AS tag_1,
          base64(encode(source)) AS vector_z, base64(encode(lang)) AS colour_b,
          CASE WHEN doc_id % 2 = 0 THEN lang END AS word, CASE WHEN doc_id % 3 <> 0 THEN n_chars / 4.0::double END AS ratio,
          doc_id AS box_0_min_x, n_chars AS box_0_min_y, doc_id + 1 AS box_0_max_x, n_chars + 1 AS box_0_max_y,
          doc_id AS box_1_min_x, n_chars AS box_1_min_y, doc_id + 1 AS box_1_max_x, n_chars + 1 AS box_1_max_y,
          doc_id AS vector_x, n_chars AS vector_y, n_chars AS colour_r, doc_id AS colour_g FROM documents""",
    "defaults_b15": _P
    + """ SELECT file_key, part_index,
          CASE WHEN lost THEN 0 ELSE width END AS width, CASE WHEN lost THEN 0 ELSE height END AS height,
          CASE WHEN lost THEN 0 ELSE display_width END AS display_width,
          CASE WHEN lost THEN 0 ELSE display_height END AS display_height,
          CASE WHEN lost THEN 0 ELSE data_x_offset END AS data_x_offset,
          CASE WHEN lost THEN 0 ELSE data_y_offset END AS data_y_offset,
          CASE WHEN NOT lost THEN part_name END AS part_name,
          CASE WHEN NOT lost THEN view_name END AS view_name, multi_view, data_window, display_window,
          pixel_aspect_ratio, CASE WHEN NOT lost THEN line_order END AS line_order,
          CASE WHEN NOT lost THEN compression END AS compression, color_space,
          CASE WHEN NOT lost THEN render_software END AS render_software,
          is_tiled AND NOT lost AS is_tiled, CASE WHEN lost THEN 0 ELSE tile_width END AS tile_width,
          CASE WHEN lost THEN 0 ELSE tile_height END AS tile_height, tile_depth,
          is_deep AND NOT lost AS is_deep
          FROM (SELECT *, width % 3 = 0 AS lost FROM fx_part_rows)""",
    "deep_files_b16": views.sql_views("files", "parts")
    + """ SELECT file_key, s3_key AS file_path, size_bytes, cast(count(*) AS int) AS multipart_count
          FROM fx_files JOIN fx_parts USING (file_key) GROUP BY ALL HAVING bool_or(is_deep)
          ORDER BY size_bytes DESC""",
    "uncompressed_or_oversized_b17": views.sql_views("files", "parts")
    + """ SELECT file_key, s3_key AS file_path, cast(size_bytes AS double) / (1024 * 1024) AS size_mb, compression
          FROM fx_files JOIN fx_parts USING (file_key)
          WHERE lower(compression) = 'none' OR size_bytes > 500 * 1024 * 1024""",
    "overscan_parts_b18": _P
    + """ SELECT file_key, part_index, data_x_offset, data_y_offset FROM fx_part_rows
          WHERE data_x_offset <> 0 OR data_y_offset <> 0""",
    "modified_within_b19": _F
    + f""" SELECT file_key, size_bytes FROM fx_files
          WHERE mtime_ts >= timestamp '{REFERENCE_TIME}' - INTERVAL 7 DAY""",
    "attribute_like_b20": _FA
    + """ SELECT file_key, s3_key AS file_path, part_index, value_text
          FROM fx_files JOIN fx_attributes USING (file_key)
          WHERE attr_name = 'software' AND value_text LIKE '%#2%'""",
    "attribute_named_b21": _FA
    + """ SELECT file_key, s3_key AS file_path, part_index, value_json
          FROM fx_files JOIN fx_attributes USING (file_key) WHERE attr_name = 'chromaticities'""",
    "find_file_b22": base.structure_views()
    + """ SELECT h.file_key, h.file_id, h.header_hash FROM fx_hashed h
          JOIN (SELECT file_path_normalized AS p, header_hash AS x FROM fx_hashed ORDER BY file_key LIMIT 1)
          ON file_path_normalized = p AND header_hash = x""",
}

"""A media catalogue derived from the given tables.

Orders become files, their lines the parts; channels and attributes follow from
the parts. Each view exists twice: as DataFrame code here, and as SQL text that
the checking engine runs on the same tables (``sql_views``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from framecat.functions import channels as ch
from framecat.functions import keys, values

# The codec of a part by the last digit of its part key.
CODECS = ("none", "rle", "zips", "zip", "piz", "pxr24", "b44", "b44a", "dwaa", "dwab")
COMPONENTS = ("R", "G", "B", "A")
COMPONENT_COUNT = {"A": 4, "N": 3, "R": 1}
ATTRIBUTES = (
    ("software", "STRING"),
    ("tileCount", "INT"),
    ("exposure", "FLOAT"),
    ("isFinal", "BOOL"),
    ("chromaticities", "V2F"),
)
#: Above so many rows the part table is hashed by partition, which sorts no order lines; below, Spark decides.
HASHED_PARTS = 1_000_000
MULTI_VIEWS = ('["left","right"]', '""', "0", "[]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    last = F.col("o_orderkey") % 10
    frame = F.lpad((F.col("o_orderkey") % 10000).cast("string"), 4, "0")
    ending = (
        F.when(last == 7, F.lit(".exr"))
        .when(last == 8, _text(".", frame, ".EXR"))
        .when(last == 9, _text(".", frame, ".jpg"))
        .otherwise(_text(".", frame, ".exr"))
    )
    job = F.lower(F.translate(F.expr("substr(o_orderpriority, 3)"), " ", "_"))
    return o.select(
        F.col("o_orderkey").alias("file_key"),
        _text("bucket_", F.col("o_orderkey") % 3).alias("s3_bucket"),
        _text(
            "renders/shot_", F.lpad(F.col("o_custkey").cast("string"), 5, "0"), "/", job, ending
        ).alias("s3_key"),
        (F.round(F.col("o_totalprice") * 100).cast("bigint") * 14).alias("size_bytes"),
        F.col("o_orderdate").alias("mtime_ts"),
    )


def identified(f: DataFrame) -> DataFrame:
    """Files with their catalogue identity: mtime text, file_id, normalised path."""
    mtime = keys.iso_utc(F.col("mtime_ts"))
    return f.select(
        "*",
        mtime.alias("mtime"),
        keys.file_id(F.col("s3_key"), mtime).alias("file_id"),
        keys.normalize_path(F.col("s3_key")).alias("file_path_normalized"),
    )


def parts(spark: SparkSession, sf_dir: str, indexed: bool = False) -> DataFrame:
    """One part per order line; ``indexed`` ones with their place in the file, which needs a window.

    Queries read the indexed parts that ``base.stored`` keeps.
    """
    return image_fields(part_lines(spark, sf_dir, indexed))


def part_lines(spark: SparkSession, sf_dir: str, indexed: bool = False, partitions: int | None = None) -> DataFrame:
    """What parts take from the given tables, without what follows from it row by row.

    With ``partitions`` the indexed lines lie in so many by file. They meet their part before that,
    so that a large part table does not move them away again; a part's rows are gathered first,
    as the place in the file counts order lines.
    """
    line = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    if indexed:
        order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
        line = line.select("l_orderkey", *order, "l_discount", "l_returnflag", "l_linestatus")
        place = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*order))
        if partitions:
            found = part.groupBy("p_partkey").agg(F.collect_list(F.struct("p_type", "p_brand")).alias("of_part"))
            line = line.join(found.hint("shuffle_hash") if part.count() > HASHED_PARTS else found, F.col("l_partkey") == F.col("p_partkey"), "left")
            line = line.repartition(partitions, "l_orderkey").withColumn("part_index", place - 1)
            joined = line.select("*", F.inline("of_part"))
        else:
            line = line.withColumn("part_index", place - 1)
    if not (indexed and partitions):
        joined = line.join(part, F.col("l_partkey") == F.col("p_partkey"))
    codec = F.element_at(
        F.array(*[F.lit(c) for c in CODECS]), (F.col("l_partkey") % 10 + 1).cast("int")
    )
    index = [F.col("part_index").cast("int").alias("part_index")] if indexed else []
    return joined.select(
        F.col("l_orderkey").alias("file_key"),
        *index,
        F.lower("p_type").alias("part_name"),
        codec.alias("compression"),
        (F.col("l_linestatus") == "O").alias("is_tiled"),
        (F.col("l_partkey") % 17 == 0).alias("is_deep"),
        F.col("l_quantity").cast("int").alias("quantity"),
        "l_discount",
        "l_returnflag",
        "p_brand",
        (F.col("l_partkey") % 13 == 0).alias("broken"),
    )


def image_fields(p: DataFrame) -> DataFrame:
    """Sizes, windows and views that follow from quantity and flags."""
    q, tiled = F.col("quantity"), F.col("is_tiled")
    p = p.select(
        "*",
        (q * 8 + 1000).alias("width"),
        (q * 4 + 500).alias("height"),
        F.when(F.col("l_returnflag") == "R", -q).otherwise(0).alias("x0"),
    )
    x0, width, height = F.col("x0"), F.col("width"), F.col("height")
    data = _text(
        '{"max":{"x":', x0 + width - 1, ',"y":', x0 + height - 1,
        '},"min":{"x":', x0, ',"y":', x0, "}}",
    )
    display = _text('{"xMax":', width + 9, ',"xMin":0,"yMax":', height + 9, ',"yMin":0}')
    view = reduce(
        lambda acc, iv: acc.when(q % 5 == iv[0], iv[1]),
        enumerate(MULTI_VIEWS[1:], start=1),
        F.when(q % 5 == 0, MULTI_VIEWS[0]),
    )
    return p.select(
        "*",
        F.when(F.col("l_returnflag") == "R", "right").otherwise("left").alias("view_name"),
        view.alias("multi_view_json"),
        data.alias("data_window_json"),
        F.when(F.col("broken"), '"oops"').when(tiled, display).alias("display_window_json"),
        F.when(tiled, 64).alias("tile_width"),
        F.when(tiled, "RANDOM_Y").otherwise("INCREASING_Y").alias("line_order"),
    )


def channels(p: DataFrame) -> DataFrame:
    """Channels of the given parts: one to four components, layered unless standard."""
    count = reduce(
        lambda acc, kv: acc.when(F.col("l_returnflag") == kv[0], kv[1]), COMPONENT_COUNT.items(), F
    )
    names = F.slice(F.array(*[F.lit(c) for c in COMPONENTS]), F.lit(1), count)
    flag = F.col("l_returnflag")
    out = p.select("*", F.explode(names).alias("component"))
    name = F.when(F.col("part_name") == "standard", F.col("component")).otherwise(
        _text(F.col("part_name"), ".", F.col("component"))
    )
    index = ["part_index"] if "part_index" in p.columns else []
    return out.select(
        "file_key",
        *index,
        name.alias("channel_name"),
        ch.layer_name(name).alias("layer_name"),
        ch.component_name(name).alias("component_name"),
        F.when(flag == "N", "HALF").otherwise("FLOAT").alias("channel_type"),
        F.when(flag == "R", 2).otherwise(1).alias("x_sampling"),
        F.lit(1).alias("y_sampling"),
    )


def attributes(p: DataFrame) -> DataFrame:
    """Attributes of the given parts: one of each JSON kind."""
    texts = {
        "software": _text('"', F.col("p_brand"), '"'),
        "tileCount": F.col("quantity").cast("string"),
        "exposure": F.col("l_discount").cast("string"),
        "isFinal": F.col("is_tiled").cast("string"),
        "chromaticities": F.when(F.col("l_returnflag") == "R", "[0.64,0.33]"),
    }
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("attr_name"), F.lit(t).alias("attr_type"), texts[n].alias("value_json"))
            for n, t in ATTRIBUTES
        ]
    )
    index = ["part_index"] if "part_index" in p.columns else []
    return p.select("file_key", *index, F.inline(rows)).filter(F.col("value_json").isNotNull())


def part_rows(p: DataFrame) -> DataFrame:
    """Parts in the shape of the catalogue table, keyed by file_key."""
    data = values.window_ints(values.variant(F.col("data_window_json")))
    display = values.window_ints(values.variant(F.col("display_window_json")))
    p = p.select("*", data.alias("data_box"), display.alias("display_box"))
    dims = values.display_dims(F.col("data_box"), F.col("display_box"), F.col("width"), F.col("height"))
    return p.select(
        "file_key", "part_index", "width", "height",
        *[c.cast("int").alias(n) for n, c in dims.items()],
        "part_name", "view_name",
        values.truthy(values.variant(F.col("multi_view_json"))).alias("multi_view"),
        F.coalesce("data_window_json", F.lit("null")).alias("data_window"),
        F.coalesce("display_window_json", F.lit("null")).alias("display_window"),
        F.lit(1.0).cast("float").alias("pixel_aspect_ratio"),
        "line_order", "compression",
        F.lit(None).cast("string").alias("color_space"),
        F.col("p_brand").alias("render_software"),
        "is_tiled",
        F.coalesce("tile_width", F.lit(0)).alias("tile_width"),
        F.coalesce("tile_width", F.lit(0)).alias("tile_height"),
        F.lit(0).alias("tile_depth"),
        "is_deep",
    )


# The same views for the checking engine.
_FILES = """
fx_files AS (
  SELECT o_orderkey AS file_key,
         'bucket_' || cast(o_orderkey % 3 AS varchar) AS s3_bucket,
         'renders/shot_' || lpad(cast(o_custkey AS varchar), 5, '0') || '/'
           || lower(replace(substr(o_orderpriority, 3), ' ', '_'))
           || CASE WHEN o_orderkey % 10 = 7 THEN '.exr'
                   WHEN o_orderkey % 10 = 8 THEN '.' || lpad(cast(o_orderkey % 10000 AS varchar), 4, '0') || '.EXR'
                   WHEN o_orderkey % 10 = 9 THEN '.' || lpad(cast(o_orderkey % 10000 AS varchar), 4, '0') || '.jpg'
                   ELSE '.' || lpad(cast(o_orderkey % 10000 AS varchar), 4, '0') || '.exr' END AS s3_key,
         cast(round(o_totalprice * 100) AS bigint) * 14 AS size_bytes,
         o_orderdate AS mtime_ts
  FROM orders),
fx_ids AS (
  SELECT *, substr(sha256(s3_key || mtime || md5(s3_key)), 1, 16) AS file_id,
         lower(s3_key) AS file_path_normalized
  FROM (SELECT *, strftime(mtime_ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS mtime FROM fx_files))"""

_PARTS = """
fx_raw AS (
  SELECT l_orderkey AS file_key,
         cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
              l_suppkey, l_extendedprice, l_quantity, l_shipdate) - 1 AS int) AS part_index,
         lower(p_type) AS part_name,
         CASE l_partkey % 10 WHEN 0 THEN 'none' WHEN 1 THEN 'rle' WHEN 2 THEN 'zips'
              WHEN 3 THEN 'zip' WHEN 4 THEN 'piz' WHEN 5 THEN 'pxr24' WHEN 6 THEN 'b44'
              WHEN 7 THEN 'b44a' WHEN 8 THEN 'dwaa' ELSE 'dwab' END AS compression,
         l_linestatus = 'O' AS is_tiled,
         l_partkey % 17 = 0 AS is_deep,
         cast(l_quantity AS int) AS quantity, l_discount, l_returnflag, p_brand,
         l_partkey % 13 = 0 AS broken
  FROM lineitem JOIN part ON l_partkey = p_partkey),
fx_parts AS (
  SELECT *, quantity * 8 + 1000 AS width, quantity * 4 + 500 AS height,
         CASE WHEN l_returnflag = 'R' THEN -quantity ELSE 0 END AS x0,
         CASE WHEN l_returnflag = 'R' THEN 'right' ELSE 'left' END AS view_name,
         CASE WHEN is_tiled THEN 64 END AS tile_width,
         CASE WHEN is_tiled THEN 'RANDOM_Y' ELSE 'INCREASING_Y' END AS line_order
  FROM fx_raw),
fx_part_rows AS (
  SELECT file_key, part_index, width, height,
         CASE WHEN is_tiled AND NOT broken THEN width + 10 ELSE width END AS display_width,
         CASE WHEN is_tiled AND NOT broken THEN height + 10 ELSE height END AS display_height,
         x0 AS data_x_offset, x0 AS data_y_offset, part_name, view_name,
         quantity % 5 = 0 AS multi_view,
         '{"max":{"x":' || (x0 + width - 1) || ',"y":' || (x0 + height - 1)
           || '},"min":{"x":' || x0 || ',"y":' || x0 || '}}' AS data_window,
         CASE WHEN broken THEN '"oops"' WHEN is_tiled
              THEN '{"xMax":' || (width + 9) || ',"xMin":0,"yMax":' || (height + 9) || ',"yMin":0}'
              ELSE 'null' END AS display_window,
         cast(1.0 AS float) AS pixel_aspect_ratio, line_order, compression,
         cast(NULL AS varchar) AS color_space, p_brand AS render_software, is_tiled,
         coalesce(tile_width, 0) AS tile_width, coalesce(tile_width, 0) AS tile_height,
         0 AS tile_depth, is_deep
  FROM fx_parts)"""

_CHANNELS = """
fx_channels AS (
  SELECT *, CASE WHEN contains(channel_name, '.')
                 THEN regexp_extract(channel_name, '^(.*)\\.([^.]*)$', 1) ELSE '' END AS layer_name,
         CASE WHEN contains(channel_name, '.')
              THEN regexp_extract(channel_name, '^(.*)\\.([^.]*)$', 2) ELSE channel_name END AS component_name
  FROM (SELECT file_key, part_index,
               CASE WHEN part_name = 'standard' THEN comp ELSE part_name || '.' || comp END AS channel_name,
               CASE WHEN l_returnflag = 'N' THEN 'HALF' ELSE 'FLOAT' END AS channel_type,
               CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS x_sampling, 1 AS y_sampling
        FROM fx_parts CROSS JOIN (VALUES (0, 'R'), (1, 'G'), (2, 'B'), (3, 'A')) AS t(ord, comp)
        WHERE ord < CASE l_returnflag WHEN 'A' THEN 4 WHEN 'N' THEN 3 ELSE 1 END))"""

_ATTRIBUTES = """
fx_attributes AS (
  SELECT file_key, part_index, attr_name, attr_type,
         CASE ord WHEN 0 THEN '"' || p_brand || '"'
                  WHEN 1 THEN cast(quantity AS varchar)
                  WHEN 2 THEN cast(l_discount AS varchar)
                  WHEN 3 THEN CASE WHEN is_tiled THEN 'true' ELSE 'false' END
                  ELSE '[0.64,0.33]' END AS value_json,
         CASE WHEN ord = 0 THEN p_brand END AS value_text,
         CASE WHEN ord = 1 THEN cast(quantity AS bigint) END AS value_int,
         CASE ord WHEN 1 THEN cast(quantity AS double) WHEN 2 THEN l_discount END AS value_float
  FROM fx_parts CROSS JOIN (VALUES (0, 'software', 'STRING'), (1, 'tileCount', 'INT'),
       (2, 'exposure', 'FLOAT'), (3, 'isFinal', 'BOOL'), (4, 'chromaticities', 'V2F'))
       AS t(ord, attr_name, attr_type)
  WHERE ord < 4 OR l_returnflag = 'R')"""

_VIEWS = {
    "files": _FILES,
    "parts": _PARTS,
    "channels": _CHANNELS,
    "attributes": _ATTRIBUTES,
}
_NEEDS = {"channels": "parts", "attributes": "parts"}


def sql_views(*names: str) -> str:
    """WITH clause giving the named views (and those they need) to a checking query."""
    wanted = {*names, *[_NEEDS[n] for n in names if n in _NEEDS]}
    return "WITH " + ",".join(text for name, text in _VIEWS.items() if name in wanted)


def sql_only(name: str) -> str:
    """The text of one view, to go on a WITH clause that has those it needs."""
    return _VIEWS[name]

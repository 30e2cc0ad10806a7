"""Queries of joins, aggregations, ordering and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framecat.functions import keys, structure, values
from framecat.operators import catalog, neighbours, quality, sinks, statistics
from framecat.plans import base, views
from framecat.plans.tables import _damaged
from framecat.session import scratch_path

POLICY = quality.Policy(max_bytes=500 * 1024 * 1024, max_tile=32)
EXPECTED_TYPES = {
    "$.file": "object",
    "$.file.path": "string",
    "$.file.s3_bucket": "string",
    "$.file.size_bytes": "int",
    "$.file.frame_number": "int",
    "$.file.is_deep": "bool",
    "$.parts": "array",
    "$.parts[*].width": "int",
    "$.parts[*].compression": "string",
    "$.parts[*].pixel_aspect_ratio": "int",
    "$.parts[*].display_window": "object",
    "$.channels": "array",
    "$.channels[*].name": "string",
    "$.attributes.parts": "array",
    "$.attributes.parts[*]": "array",
    "$.attributes.parts[*][*].name": "string",
    "$.attributes.parts[*][*].value": "string",
}
DECLARED = {
    "$.file": ("path", "s3_key", "s3_bucket", "size_bytes", "mtime", "frame_number", "multipart_count"),
    "$.parts[*]": tuple(n for n in structure.PART_COLUMNS if n != "render_software"),
    "$.channels[*]": ("part_index", "name", "layer_name", "component_name", "type", "x_sampling"),
}


def _files(spark: SparkSession, sf: str) -> DataFrame:
    return views.files(spark, sf).withColumnRenamed("s3_key", "file_path")


def channels_with_parts(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.channels_with_parts(base.stored(spark, sf, "channels"), base.stored(spark, sf, "parts"), "file_key")


def files_with_channels(spark: SparkSession, sf: str) -> DataFrame:
    """Files joined to their channels: rows and bytes per bucket and channel type."""
    c = views.channels(views.parts(spark, sf))
    folded = c.groupBy("file_key", "channel_type").agg(F.count("*").alias("n"))
    joined = _files(spark, sf).join(folded, "file_key")
    return joined.groupBy("s3_bucket", "channel_type").agg(
        F.sum("n").alias("channels"), F.count("*").alias("files")
    )


def files_with_codec(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.files_with_codec(_files(spark, sf), views.parts(spark, sf), "DWAA", "file_key")
    return found.select("file_key", "file_path", "size_bytes", "matching_parts")


def files_having_codec(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.files_having_codec(_files(spark, sf), views.parts(spark, sf), "DWAA", "file_key")
    return found.select("file_key", "file_path")


def files_without_parts(spark: SparkSession, sf: str) -> DataFrame:
    parts = views.parts(spark, sf).select("file_key")
    return _files(spark, sf).join(parts, "file_key", "left_anti").select("file_key", "file_path")


def near_pairs(spark: SparkSession, sf: str) -> DataFrame:
    e = views.table(spark, sf, "embeddings")
    pairs = neighbours.similar_pairs(e, "euclidean", 1.1)
    return pairs.select("ref_id", "similar_id", base.rounded(F.col("distance")).alias("distance"))


def compression_summary(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.compression_summary(views.files(spark, sf), views.parts(spark, sf), "file_key")


def compression_summary_once(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.compression_summary_once(views.files(spark, sf), views.parts(spark, sf), "file_key")


def many_channels(spark: SparkSession, sf: str) -> DataFrame:
    c = views.channels(views.parts(spark, sf))
    f = base.catalogue_files(spark, sf)
    return catalog.many_channels(f, c, 20, "file_key")


def file_features(spark: SparkSession, sf: str) -> DataFrame:
    p = views.parts(spark, sf)
    p = p.withColumn("multi_view", values.truthy(values.variant(F.col("multi_view_json"))))
    return catalog.file_features(views.files(spark, sf), p, views.channels(p), "file_key")


def channel_features(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.channel_features(views.channels(views.parts(spark, sf)), "file_key")
    return found.select(
        "file_key", "channel_count",
        *[base.rounded(F.col(c)).alias(c) for c in found.columns if c not in ("file_key", "channel_count")],
    )


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    p = views.parts(spark, sf)
    return catalog.row_counts(
        {
            "files": views.files(spark, sf),
            "parts": p,
            "channels": views.channels(p),
            "attributes": views.attributes(p),
        }
    )


def layers(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.layers(views.channels(views.parts(spark, sf)), "file_key")


def _samples(spark: SparkSession, sf: str) -> DataFrame:
    """Vector components as channel samples, with NaN and infinite values put in."""
    e = views.table(spark, sf, "embeddings")
    s = e.select("vec_id", F.posexplode("embedding").alias("channel", "value"))
    odd = (F.col("vec_id") * 64 + F.col("channel")) % 97
    value = (
        F.when(odd == 0, float("nan"))
        .when(odd == 1, float("inf"))
        .when(odd == 2, float("-inf"))
        .otherwise(F.col("value").cast("double"))
    )
    return s.select("channel", F.col("vec_id").alias("pos"), value.alias("value"))


def _rounded_statistics(df: DataFrame) -> DataFrame:
    measured = ("min_value", "max_value", "mean_value", "stddev_value")
    return df.select(
        *[base.rounded(F.col(c)).alias(c) if c in measured else F.col(c) for c in df.columns]
    )


def _keyed_samples(spark: SparkSession, sf: str) -> DataFrame:
    """The samples as those of channels of parts of files."""
    s = _samples(spark, sf)
    text = lambda c: c.cast("string")
    return s.select(text(F.col("pos") % 7).alias("file_id"), text(F.col("pos") % 3).alias("part_id"), text(F.col("channel")).alias("channel_id"), "pos", "value")


def channel_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_statistics(statistics.channel_statistics(_keyed_samples(spark, sf), "file_id", "part_id", "channel_id"))


def _stored_rows(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Rows written to their declared table in two halves, and read back."""
    root = scratch_path(spark, name)
    half = F.pmod(F.xxhash64("file_id"), F.lit(2)) == 0
    for part in (half, ~half):
        sinks.write_tables({name: rows.filter(part)}, root)
    return sinks.read_tables(spark, root, (name,))[name]


def stats_table(spark: SparkSession, sf: str) -> DataFrame:
    """The statistics table of every second sample: of positions 0, 2, 4, ..."""
    samples = _keyed_samples(spark, sf)
    stored = _stored_rows(spark, "stats", statistics.stats_rows(samples, stride=2)).drop("computed_at")
    return _rounded_statistics(stored).drop("pixel_hash_sampled")


def validation_table(spark: SparkSession, sf: str) -> DataFrame:
    """The table of policy results."""
    results = _validated(spark, sf).withColumn("file_id", F.col("file_key").cast("string")).drop("file_key")
    return _stored_rows(spark, "validation_results", results).drop("validated_at")


def strided_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded_statistics(statistics.strided_statistics(_samples(spark, sf), "channel", 10))


def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    e = views.table(spark, sf, "events")
    value = F.get_json_object("props", "$.k").cast("bigint")
    samples = e.select(F.col("user_id").alias("channel"), F.col("event_id").alias("pos"), value.alias("value"))
    return statistics.content_hash(samples, "channel", "pos", "value")


def ordered_files(spark: SparkSession, sf: str) -> DataFrame:
    """All files, largest first, then by key."""
    return views.files(spark, sf).select("file_key", "size_bytes").orderBy(F.desc("size_bytes"), "file_key")


def concatenated(spark: SparkSession, sf: str) -> DataFrame:
    """Files of each bucket as separate batches, put together again."""
    f = views.identified(views.files(spark, sf)).select("file_key", "s3_bucket", "file_id")
    return catalog.concatenated([f.filter(F.col("s3_bucket") == f"bucket_{i}") for i in range(3)])


def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    p = views.parts(spark, sf)
    return catalog.distinct_values(p, "part_name", "compression", "line_order")


def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    f = views.files(spark, sf).withColumn("frame_number", keys.frame_number(F.col("s3_key")))
    kept = f.withColumn("size_bytes", F.when(F.col("file_key") % 7 != 0, F.col("size_bytes")))
    return quality.check_not_null(kept, ["file_key", "s3_key", "size_bytes", "frame_number"])


def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_unique(views.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_foreign_key(spark: SparkSession, sf: str) -> DataFrame:
    """Parts against files of which the .jpg ones were removed."""
    parents = views.files(spark, sf).filter(keys.has_suffix(F.col("s3_key")))
    return quality.check_foreign_key(views.parts(spark, sf), parents, ["file_key"])


def check_enum(spark: SparkSession, sf: str) -> DataFrame:
    """Codecs against a list that lacks the two newest."""
    allowed = [c for c in quality.ENUMS["compression"] if not c.startswith("DW")]
    return quality.check_enum(views.parts(spark, sf), "compression", allowed)


def _retyped(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged payloads, and some whose last part has a text for its width."""
    lines = _damaged(spark, sf)
    turned = F.regexp_replace("value", r'^(.*"width":)(\d+)(.*)$', '$1"$2"$3')
    return lines.select("file_key", F.when(F.col("file_key") % 16 == 4, turned).otherwise(F.col("value")).alias("value"))


def check_types(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_types(_retyped(spark, sf), EXPECTED_TYPES)


def undeclared_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields beyond lists from which some were left out."""
    return quality.undeclared_fields(_damaged(spark, sf), DECLARED)


def check_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Embeddings of which some are cut, scaled, zeroed or hold a NaN."""
    e = views.table(spark, sf, "embeddings")
    turn, v = F.col("vec_id") % 10, F.col("embedding")
    damaged = (
        F.when(turn == 1, F.slice(v, 1, 63))
        .when(turn == 2, F.transform(v, lambda x: (x * 2).cast("float")))
        .when(turn == 3, F.transform(v, lambda x: (x * 0).cast("float")))
        .when(turn == 4, F.concat(F.slice(v, 1, 63), F.array(F.lit(float("nan")).cast("float"))))
        .otherwise(v)
    )
    return quality.check_vectors(e.select(damaged.alias("embedding")), "embedding", 64)


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    f = views.files(spark, sf).withColumn("frame_number", keys.frame_number(F.col("s3_key")))
    return quality.validate(f, views.parts(spark, sf), POLICY, "file_key")


def validate(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf).drop("validated_at")


def file_severity(spark: SparkSession, sf: str) -> DataFrame:
    return quality.file_severity(_validated(spark, sf), "file_key")


QUERIES = {
    "channels_with_parts_e1": channels_with_parts,
    "files_with_channels_e2": files_with_channels,
    "files_with_codec_e3": files_with_codec,
    "files_having_codec_e3_semi": files_having_codec,
    "files_without_parts_e4": files_without_parts,
    "near_pairs_e5": near_pairs,
    "compression_summary_g1": compression_summary,
    "compression_summary_once_g2": compression_summary_once,
    "many_channels_g3": many_channels,
    "file_features_g4": file_features,
    "channel_features_g5": channel_features,
    "row_counts_g6": row_counts,
    "layers_g7": layers,
    "channel_statistics_g8": channel_statistics,
    "stats_table_g8": stats_table,
    "strided_statistics_g9": strided_statistics,
    "content_hash_g10": content_hash,
    "ordered_files_h1": ordered_files,
    "concatenated_h3": concatenated,
    "distinct_values_h4": distinct_values,
    "check_not_null_q1": check_not_null,
    "check_unique_q2": check_unique,
    "check_foreign_key_q3": check_foreign_key,
    "check_enum_q4": check_enum,
    "check_types_q5": check_types,
    "undeclared_fields_q5": undeclared_fields,
    "check_vectors_q6": check_vectors,
    "validate_q7": validate,
    "validation_table_q7": validation_table,
    "file_severity_q7_rollup": file_severity,
}

_F, _P, _C = (views.sql_views(n) for n in ("files", "parts", "channels"))
_FP = views.sql_views("files", "parts")
_FC = views.sql_views("files", "parts", "channels")
_ALL = views.sql_views("files", "parts", "channels", "attributes")
_GIB = "(1024 * 1024 * 1024)"
_SAMPLES = """WITH s AS (
  SELECT vec_id, unnest(range(len(embedding))) AS channel, unnest(embedding)::double AS v FROM embeddings),
samples AS (
  SELECT cast(channel AS int) AS channel, vec_id AS pos,
         CASE (vec_id * 64 + channel) % 97 WHEN 0 THEN 'nan'::double WHEN 1 THEN 'inf'::double
              WHEN 2 THEN '-inf'::double ELSE v END AS value FROM s)"""
_STATISTICS = """round(min(value) FILTER (isfinite(value)), 6) + 0.0::double AS min_value,
  round(max(value) FILTER (isfinite(value)), 6) + 0.0::double AS max_value,
  round(avg(value) FILTER (isfinite(value)), 6) + 0.0::double AS mean_value,
  round(stddev_pop(value) FILTER (isfinite(value)), 6) + 0.0::double AS stddev_value,
  count(*) FILTER (isnan(value)) AS nan_count, count(*) FILTER (isinf(value)) AS inf_count"""
_CODECS = ",".join(POLICY.codecs)
_CODEC_LIST = ", ".join(f"'{c}'" for c in POLICY.codecs)
_RESULTS = (
    _FP
    + f""", facts AS (
  SELECT f.file_key, f.size_bytes,
         cast(nullif(regexp_extract(s3_key, '(?i)[._]([0-9]{{3,8}})\\.exr$', 1), '') AS int) AS frame,
         p.bad, p.tile
  FROM fx_files f LEFT JOIN (
    SELECT file_key, min(compression) FILTER (compression NOT IN ({_CODEC_LIST})) AS bad,
           max(coalesce(tile_width, NULL)) AS tile FROM fx_parts GROUP BY file_key) p USING (file_key)),
results AS (
  SELECT file_key, '{POLICY.policy_id}' AS policy_id, '{POLICY.version}' AS policy_version,
         'compression_check' AS rule_id, CASE WHEN bad IS NULL THEN 'PASS' ELSE 'WARN' END AS severity,
         CASE WHEN bad IS NULL THEN 'OK' ELSE 'SUBOPTIMAL_COMPRESSION' END AS status,
         '{_CODECS}' AS expected_value, bad AS actual_value,
         CASE WHEN bad IS NOT NULL THEN 'Re-render with an allowed compression' END AS suggested_fix FROM facts
  UNION ALL
  SELECT file_key, '{POLICY.policy_id}', '{POLICY.version}', 'size_check',
         CASE WHEN size_bytes > {POLICY.max_bytes} THEN 'FAIL' ELSE 'PASS' END,
         CASE WHEN size_bytes > {POLICY.max_bytes} THEN 'OVERSIZED' ELSE 'OK' END,
         '{POLICY.max_bytes}', cast(size_bytes AS varchar),
         CASE WHEN size_bytes > {POLICY.max_bytes} THEN 'Split parts or compress' END FROM facts
  UNION ALL
  SELECT file_key, '{POLICY.policy_id}', '{POLICY.version}', 'frame_check',
         CASE WHEN frame IS NULL THEN 'WARN' ELSE 'PASS' END,
         CASE WHEN frame IS NULL THEN 'NO_FRAME_NUMBER' ELSE 'OK' END,
         '3 to 8 digits before the suffix', cast(frame AS varchar),
         CASE WHEN frame IS NULL THEN 'Rename with a frame number' END FROM facts
  UNION ALL
  SELECT file_key, '{POLICY.policy_id}', '{POLICY.version}', 'tile_check',
         CASE WHEN tile > {POLICY.max_tile} THEN 'FAIL' ELSE 'PASS' END,
         CASE WHEN tile > {POLICY.max_tile} THEN 'TILE_TOO_LARGE' ELSE 'OK' END,
         '{POLICY.max_tile}', cast(tile AS varchar),
         CASE WHEN tile > {POLICY.max_tile} THEN 'Re-tile' END FROM facts)"""
)
_TYPES = (
    _ALL
    + f""", f AS (SELECT *, file_key % 16 AS turn, regexp_extract(s3_key, '(?i)[._]([0-9]{{3,8}})\\.exr$', 1) = '' AS no_frame FROM fx_files),
told AS (
  SELECT count(*) AS n, count(*) FILTER (turn = 0) AS cut, count(*) FILTER (turn = 1) AS no_bucket,
         count(*) FILTER (turn = 2) AS no_path, count(*) FILTER (turn = 0 OR no_frame) AS no_frame,
         count(*) FILTER (turn = 3) AS null_channels FROM f),
p AS (SELECT r.*, part_index = max(part_index) OVER (PARTITION BY file_key) AS last, turn
      FROM fx_part_rows r JOIN f USING (file_key) WHERE turn <> 0),
parts AS (SELECT count(*) AS n, count(*) FILTER (last AND turn = 4) AS texts, count(*) FILTER (display_window = 'null') AS unseen,
                 count(*) FILTER (display_window = '"oops"') AS odd FROM p),
c AS (SELECT count(*) AS n FROM fx_channels JOIN f USING (file_key) WHERE turn NOT IN (0, 3)),
a AS (SELECT count(*) AS n, count(*) FILTER (value_text IS NULL) AS others FROM fx_attributes JOIN f USING (file_key) WHERE turn <> 0),
lists AS (SELECT count(*) AS n FROM p)
SELECT '$.file' AS field, cut AS missing, 0::bigint AS wrong_type, n AS expected FROM told
UNION ALL SELECT '$.file.path', cut + no_path, 0, n FROM told
UNION ALL SELECT '$.file.s3_bucket', cut + no_bucket, 0, n FROM told
UNION ALL SELECT '$.file.size_bytes', cut, 0, n FROM told
UNION ALL SELECT '$.file.frame_number', no_frame, 0, n FROM told
UNION ALL SELECT '$.file.is_deep', cut, 0, n FROM told
UNION ALL SELECT '$.parts', cut, 0, n FROM told
UNION ALL SELECT '$.parts[*].width', 0, texts, n FROM parts
UNION ALL SELECT '$.parts[*].compression', 0, 0, n FROM parts
UNION ALL SELECT '$.parts[*].pixel_aspect_ratio', 0, n, n FROM parts
UNION ALL SELECT '$.parts[*].display_window', unseen, odd, n FROM parts
UNION ALL SELECT '$.channels', cut, null_channels, n FROM told
UNION ALL SELECT '$.channels[*].name', 0, 0, n FROM c
UNION ALL SELECT '$.attributes.parts', cut, 0, n FROM told
UNION ALL SELECT '$.attributes.parts[*]', 0, 0, n FROM lists
UNION ALL SELECT '$.attributes.parts[*][*].name', 0, 0, n FROM a
UNION ALL SELECT '$.attributes.parts[*][*].value', 0, others, n FROM a"""
)
_UNDECLARED = (
    _FC
    + """, f AS (SELECT *, file_key % 16 AS turn FROM fx_files WHERE file_key % 16 <> 0)
SELECT '$.file' AS path, 'is_deep' AS field, count(*) AS row_count FROM f
UNION ALL SELECT '$.parts[*]', 'render_software', count(*) FROM fx_part_rows JOIN f USING (file_key)
UNION ALL SELECT '$.channels[*]', 'y_sampling', count(*) FROM fx_channels JOIN f USING (file_key) WHERE turn <> 3"""
)

ORACLES = {
    "channels_with_parts_e1": _C
    + """ SELECT file_key, part_index, channel_name, channel_type, part_name, compression
          FROM fx_channels JOIN fx_part_rows USING (file_key, part_index)""",
    "files_with_channels_e2": _FC
    + """ SELECT s3_bucket, channel_type, count(*) AS channels, count(DISTINCT file_key) AS files
          FROM fx_files JOIN fx_channels USING (file_key) GROUP BY ALL""",
    "files_with_codec_e3": _FP
    + """ SELECT file_key, s3_key AS file_path, size_bytes, count(*) AS matching_parts
          FROM fx_files JOIN fx_parts USING (file_key) WHERE compression = 'dwaa' GROUP BY ALL""",
    "files_having_codec_e3_semi": _FP
    + """ SELECT file_key, s3_key AS file_path FROM fx_files
          WHERE file_key IN (SELECT file_key FROM fx_parts WHERE compression = 'dwaa')""",
    "files_without_parts_e4": _FP
    + """ SELECT file_key, s3_key AS file_path FROM fx_files
          WHERE file_key NOT IN (SELECT file_key FROM fx_parts)""",
    "near_pairs_e5": """WITH d AS (SELECT min(vec_id) AS id, embedding::double[] AS v FROM embeddings GROUP BY embedding)
          SELECT a.id AS ref_id, b.id AS similar_id, round(list_distance(a.v, b.v), 6) + 0.0::double AS distance
          FROM d a JOIN d b ON a.id < b.id WHERE list_distance(a.v, b.v) < 1.1""",
    "compression_summary_g1": _FP
    + f""" SELECT compression, count(DISTINCT file_key) AS file_count,
          cast(sum(size_bytes) AS double) / {_GIB} AS total_gb
          FROM fx_parts JOIN fx_files USING (file_key) GROUP BY compression ORDER BY file_count DESC""",
    "compression_summary_once_g2": _FP
    + f""" SELECT compression, count(*) AS file_count, cast(sum(size_bytes) AS double) / {_GIB} AS total_gb
          FROM (SELECT DISTINCT file_key, compression, size_bytes FROM fx_parts JOIN fx_files USING (file_key))
          GROUP BY compression""",
    "many_channels_g3": _FC
    + """ SELECT file_key, s3_key AS file_path, channel_count,
          cast((SELECT count(*) FROM fx_parts p WHERE p.file_key = f.file_key) AS int) AS multipart_count
          FROM fx_files f JOIN (SELECT file_key, count(*) AS channel_count FROM fx_channels
                                GROUP BY file_key HAVING count(*) > 20) USING (file_key)""",
    "file_features_g4": base.structure_views()
    + """ SELECT file_key, channel_count, part_count, is_deep, is_tiled, has_multiview,
          codec AS compression_type FROM fx_structures""",
    "channel_features_g5": _C
    + """ SELECT file_key, count(*) AS channel_count,
          round(count(DISTINCT CASE WHEN contains(channel_name, '.') THEN split_part(channel_name, '.', 1) END) / count(*)::double, 6) AS layer_share,
          round(sum(x_sampling) / (count(*) * 2)::double, 6) AS half_mean_x_sampling,
          round(sum(y_sampling) / (count(*) * 2)::double, 6) AS half_mean_y_sampling,
          round(count(*) FILTER (lower(channel_type) = 'float') / count(*)::double, 6) AS float_share,
          round(count(*) FILTER (lower(channel_type) = 'half') / count(*)::double, 6) AS half_share,
          0.0::double AS uint32_share, 0.0::double AS uint8_share FROM fx_channels GROUP BY file_key""",
    "row_counts_g6": _ALL
    + """ SELECT 'files' AS table_name, count(*) AS row_count FROM fx_files
          UNION ALL SELECT 'parts', count(*) FROM fx_parts
          UNION ALL SELECT 'channels', count(*) FROM fx_channels
          UNION ALL SELECT 'attributes', count(*) FROM fx_attributes""",
    "layers_g7": _C
    + """ SELECT file_key, layer_name, count(*) AS channel_count,
          string_agg(DISTINCT component_name, ',' ORDER BY component_name) AS components
          FROM fx_channels GROUP BY file_key, layer_name""",
    "channel_statistics_g8": f"""{_SAMPLES} SELECT cast(pos % 7 AS varchar) AS file_id, cast(pos % 3 AS varchar) AS part_id,
          cast(channel AS varchar) AS channel_id, {_STATISTICS} FROM samples GROUP BY ALL""",
    "stats_table_g8": f"""{_SAMPLES} SELECT cast(pos % 7 AS varchar) AS file_id, cast(pos % 3 AS varchar) AS part_id,
          cast(channel AS varchar) AS channel_id, {_STATISTICS}, 2 AS sample_stride, count(*) AS sampled_pixel_count
          FROM samples WHERE pos % 2 = 0 GROUP BY ALL""",
    "strided_statistics_g9": f"""{_SAMPLES} SELECT channel, {_STATISTICS}, 10 AS sample_stride,
          count(*) AS sampled_pixel_count FROM samples WHERE pos % 10 = 0 GROUP BY channel""",
    "content_hash_g10": f"""SELECT user_id AS channel, count(*) AS sampled_pixel_count,
          sha256({base.sql_set_digest('h')}) AS pixel_hash_sampled
          FROM (SELECT user_id, md5(event_id || ':' || json_extract_string(props, '$.k')) AS h FROM events)
          GROUP BY user_id""",
    "ordered_files_h1": _F + " SELECT file_key, size_bytes FROM fx_files ORDER BY size_bytes DESC, file_key",
    "concatenated_h3": _F + " SELECT file_key, s3_bucket, file_id FROM fx_ids",
    "distinct_values_h4": _P + " SELECT DISTINCT part_name, compression, line_order FROM fx_parts",
    "check_not_null_q1": _F
    + """ SELECT 'file_key' AS column_name, count(*) - count(file_key) AS null_count FROM fx_files
          UNION ALL SELECT 's3_key', count(*) - count(s3_key) FROM fx_files
          UNION ALL SELECT 'size_bytes', count(*) FILTER (file_key % 7 = 0) FROM fx_files
          UNION ALL SELECT 'frame_number', count(*) FILTER (regexp_extract(s3_key, '(?i)[._]([0-9]{3,8})\\.exr$', 1) = '') FROM fx_files""",
    "check_unique_q2": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
          GROUP BY ALL HAVING count(*) > 1""",
    "check_foreign_key_q3": _FP
    + """ SELECT file_key, count(*) AS row_count FROM fx_parts
          WHERE file_key NOT IN (SELECT file_key FROM fx_files WHERE lower(s3_key) LIKE '%.exr') GROUP BY file_key""",
    "check_enum_q4": _P
    + """ SELECT compression AS bad_value, count(*) AS row_count FROM fx_parts
          WHERE compression LIKE 'dw%' GROUP BY compression""",
    "check_types_q5": _TYPES,
    "undeclared_fields_q5": _UNDECLARED,
    "check_vectors_q6": """SELECT count(*) AS vectors, count(*) FILTER (vec_id % 10 = 1) AS wrong_length,
          count(*) FILTER (vec_id % 10 = 4) AS not_finite, count(*) FILTER (vec_id % 10 = 3) AS zero,
          count(*) FILTER (CASE vec_id % 10 WHEN 4 THEN false WHEN 3 THEN false
            WHEN 2 THEN 2 * sqrt(list_inner_product(e, e)) NOT BETWEEN 0.99 AND 1.01
            WHEN 1 THEN sqrt(list_inner_product(e[1:63], e[1:63])) NOT BETWEEN 0.99 AND 1.01
            ELSE sqrt(list_inner_product(e, e)) NOT BETWEEN 0.99 AND 1.01 END) AS not_unit
          FROM (SELECT vec_id, embedding::double[] AS e FROM embeddings)""",
    "validate_q7": _RESULTS
    + """ SELECT *, CASE WHEN severity <> 'PASS' THEN rule_id || ': ' || coalesce(actual_value, 'nothing') || ' where '
               || expected_value || ' is expected' END AS message FROM results""",
    "validation_table_q7": _RESULTS
    + """ SELECT * EXCLUDE (file_key), cast(file_key AS varchar) AS file_id,
          CASE WHEN severity <> 'PASS' THEN rule_id || ': ' || coalesce(actual_value, 'nothing') || ' where '
               || expected_value || ' is expected' END AS message FROM results""",
    "file_severity_q7_rollup": _RESULTS
    + """ SELECT file_key, CASE WHEN bool_or(severity = 'FAIL') THEN 'FAIL' WHEN bool_or(severity = 'WARN') THEN 'WARN'
          ELSE 'PASS' END AS severity, count(*) FILTER (severity <> 'PASS') AS broken_rules
          FROM results GROUP BY file_key""",
}

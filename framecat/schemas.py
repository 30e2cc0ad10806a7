"""Table and payload schemas as DDL text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

METADATA_DIM = 384
FINGERPRINT_DIM = 128

# Column names and types of the catalogue tables.
TABLES = {
    "files": """
        file_id string, file_path string, file_path_normalized string,
        header_hash string, size_bytes bigint, mtime string,
        multipart_count int, is_deep boolean, metadata_embedding array<float>,
        frame_number int, inspection_timestamp string, inspection_count int,
        last_inspected string, s3_bucket string, content_id string,
        raw_output string""",
    "parts": """
        file_id string, file_path string, part_index int, width int, height int,
        display_width int, display_height int, data_x_offset int,
        data_y_offset int, part_name string, view_name string,
        multi_view boolean, data_window string, display_window string,
        pixel_aspect_ratio float, line_order string, compression string,
        color_space string, render_software string, is_tiled boolean,
        tile_width int, tile_height int, tile_depth int, is_deep boolean""",
    "channels": """
        file_id string, file_path string, part_index int, channel_name string,
        layer_name string, component_name string, channel_type string,
        x_sampling int, y_sampling int, channel_fingerprint array<float>""",
    "attributes": """
        file_id string, file_path string, part_index int, attr_name string,
        attr_type string, value_json string, value_text string,
        value_int bigint, value_float double""",
    "stats": """
        file_id string, part_id string, channel_id string, min_value double,
        max_value double, mean_value double, stddev_value double,
        nan_count bigint, inf_count bigint, sample_stride int,
        sampled_pixel_count bigint, pixel_hash_sampled string,
        computed_at timestamp""",
    "validation_results": """
        file_id string, policy_id string, policy_version string, rule_id string,
        severity string, status string, message string, expected_value string,
        actual_value string, suggested_fix string, validated_at timestamp""",
}

# The inspection payload. Every key but file.path may be absent.
PART_FIELDS = """
    part_index: int, width: int, height: int, display_width: int,
    display_height: int, data_x_offset: int, data_y_offset: int,
    part_name: string, view_name: string, multi_view: variant,
    data_window: variant, display_window: variant, pixel_aspect_ratio: float,
    line_order: string, compression: string, color_space: string,
    render_software: string, is_tiled: boolean, tile_width: int,
    tile_height: int, tile_depth: int, is_deep: boolean"""
CHANNEL_FIELDS = """
    part_index: int, name: string, layer_name: string, component_name: string,
    type: string, x_sampling: int, y_sampling: int"""
CORRUPT = "_corrupt"
PAYLOAD = f"""
    schema_version int,
    file struct<path: string, s3_key: string, s3_bucket: string,
        size_bytes: bigint, mtime: string, frame_number: int,
        multipart_count: int, is_deep: boolean>,
    parts array<struct<{PART_FIELDS}>>,
    channels array<struct<{CHANNEL_FIELDS}>>,
    attributes variant, stats variant, validation variant, errors array<string>,
    {CORRUPT} string"""


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def conform(df: DataFrame, name: str, *extra: str) -> DataFrame:
    """Cast to the declared table, absent columns as NULL, others but ``extra`` left out."""
    have = set(df.columns)

    def column(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in have else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in table_schema(name)], *extra)

"""Summary of one header's structure, from its payload or from its table rows.

Both forms give the same values. The hashes are built from per-row digests that
are added up (an additive set hash), so a header's rows need not meet in one
task: the table form is a plain mergeable aggregation, the payload form stays
inside its own row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.functions import values
from framecat.functions.values import bind

LANES = 4
LANE_DIGITS = 6  # hex digits: sums of 24-bit numbers fit a bigint for 2^39 rows

# What a part or channel falls back to when the payload leaves a field out.
PART_DEFAULTS = {
    "part_index": 0,
    "width": 0,
    "height": 0,
    "display_width": 0,
    "display_height": 0,
    "data_x_offset": 0,
    "data_y_offset": 0,
    "pixel_aspect_ratio": 1.0,
    "is_tiled": False,
    "tile_width": 0,
    "tile_height": 0,
    "tile_depth": 0,
    "is_deep": False,
}
CHANNEL_DEFAULTS = {
    "part_index": 0,
    "name": "",
    "layer_name": "",
    "component_name": "",
    "type": "",
    "x_sampling": 1,
    "y_sampling": 1,
}
PART_COLUMNS = (
    "part_index",
    "width",
    "height",
    "display_width",
    "display_height",
    "data_x_offset",
    "data_y_offset",
    "part_name",
    "view_name",
    "multi_view",
    "data_window",
    "display_window",
    "pixel_aspect_ratio",
    "line_order",
    "compression",
    "color_space",
    "render_software",
    "is_tiled",
    "tile_width",
    "tile_height",
    "tile_depth",
    "is_deep",
)
_PART_SHAPE = ("part_index", "width", "height", "compression", "is_tiled", "is_deep")
_CHANNEL_SHAPE = ("part_index", "name", "type", "x_sampling", "y_sampling")

Field = Callable[[str], Column]


def filled_part(part: Column) -> Column:
    """Part of a payload as the parts table holds it, defaults filled in."""

    def column(name: str) -> Column:
        if name == "multi_view":
            return values.truthy(part[name])
        if name in ("data_window", "display_window"):
            return values.json_text(part[name])
        if name in PART_DEFAULTS:
            return F.coalesce(part[name], F.lit(PART_DEFAULTS[name]).cast(_type_of(name)))
        return part[name]

    return F.struct(*[column(n).alias(n) for n in PART_COLUMNS])


def filled_channel(channel: Column) -> Column:
    return F.struct(
        *[F.coalesce(channel[n], F.lit(d)).alias(n) for n, d in CHANNEL_DEFAULTS.items()]
    )


def _type_of(name: str) -> str:
    if name == "pixel_aspect_ratio":
        return "float"
    return "boolean" if isinstance(PART_DEFAULTS[name], bool) else "int"


def _row_text(field: Field, names: tuple[str, ...]) -> Column:
    """The fields' texts, each behind its length, so that no two rows share a text; NULL is an empty text."""
    texts = [F.coalesce(field(n).cast("string"), F.lit("")) for n in names]
    return F.concat(*[x for t in texts for x in (F.char_length(t), F.lit(":"), t)])


def _shape_field(field: Field) -> Field:
    return lambda n: F.lower(field(n)) if n in ("compression", "type") else field(n)


def part_hash(field: Field) -> Column:
    return F.md5(_row_text(field, PART_COLUMNS))


def part_shape_hash(field: Field) -> Column:
    return F.md5(_row_text(_shape_field(field), _PART_SHAPE))


def channel_shape_hash(field: Field) -> Column:
    return F.md5(_row_text(_shape_field(field), _CHANNEL_SHAPE))


def lane(hex_text: Column, j: int) -> Column:
    digits = F.substring(hex_text, 1 + LANE_DIGITS * j, LANE_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def digest_of_sums(count: Column, sums: list[Column]) -> Column:
    """Text of a set's digest: how many members, and the sum of each lane."""
    return F.concat_ws(",", *[x.cast("string") for x in (count, *sums)])


def set_digest(hashes: Column) -> Column:
    """Digest of an array of hex hashes, whatever their order."""

    def of(bound: Column) -> Column:
        return digest_of_sums(F.size(bound), [lane_sum(bound, j) for j in range(LANES)])

    def lane_sum(bound: Column, j: int) -> Column:
        return F.aggregate(bound, F.lit(0).cast("bigint"), lambda acc, h: acc + lane(h, j))

    return bind(hashes, of)


def set_digest_agg(hex_text: Column) -> Column:
    """The same digest as an aggregate over rows; rows with NULL do not count."""
    sums = [F.coalesce(F.sum(lane(hex_text, j)), F.lit(0)) for j in range(LANES)]
    return digest_of_sums(F.count(hex_text), sums)


def header_hash(multipart_count: Column, is_deep: Column, header_digest: Column) -> Column:
    """Hash of part count, deep flag and every field of every part."""
    return F.sha2(F.concat_ws("|", multipart_count, is_deep.cast("string"), header_digest), 256)


def payload_structure(payload: Callable[[str], Column]) -> Column:
    """Structure struct of a payload row whose parts and channels are filled in."""
    parts, channels = payload("parts"), payload("channels")
    codecs = F.filter(
        F.transform(parts, lambda p: F.lower(p["compression"])), lambda c: F.length(c) > 0
    )
    header = set_digest(F.transform(parts, lambda p: part_hash(lambda n: p[n])))
    part_shape = set_digest(F.transform(parts, lambda p: part_shape_hash(lambda n: p[n])))
    channel_shape = set_digest(F.transform(channels, lambda c: channel_shape_hash(lambda n: c[n])))
    return F.struct(
        F.size(parts).cast("bigint").alias("part_count"),
        F.size(channels).cast("bigint").alias("channel_count"),
        F.exists(parts, lambda p: p["is_deep"]).alias("is_deep"),
        F.exists(parts, lambda p: p["is_tiled"]).alias("is_tiled"),
        F.exists(parts, lambda p: p["multi_view"]).alias("has_multiview"),
        F.coalesce(F.array_min(codecs), F.lit("none")).alias("codec"),
        header.alias("header_digest"),
        F.concat_ws(";", part_shape, channel_shape).alias("structure_digest"),
    )


def table_structure(parts: DataFrame, channels: DataFrame, key: str, files: DataFrame) -> DataFrame:
    """The same struct from table rows, one per key of ``files``, as column ``structure``.

    Two mergeable aggregations; the joins reuse their partitioning on the key, so that what
    comes after them is spread over tasks however few partitions the files are read in.
    """
    hashed_parts = parts.select(
        key, "is_deep", "is_tiled", "multi_view",
        F.when(F.length("compression") > 0, F.lower("compression")).alias("codec"),
        part_hash(F.col).alias("hash"),
        part_shape_hash(F.col).alias("shape"),
    )
    p = hashed_parts.groupBy(key).agg(
        F.count("*").alias("part_count"),
        F.bool_or("is_deep").alias("is_deep"),
        F.bool_or("is_tiled").alias("is_tiled"),
        F.bool_or("multi_view").alias("has_multiview"),
        F.min("codec").alias("codec"),
        set_digest_agg(F.col("hash")).alias("header_digest"),
        set_digest_agg(F.col("shape")).alias("part_shape"),
    )
    names = {"name": "channel_name", "type": "channel_type"}
    shape = channel_shape_hash(lambda n: F.col(names.get(n, n)))
    c = channels.select(key, shape.alias("shape")).groupBy(key).agg(
        F.count("*").alias("channel_count"),
        set_digest_agg(F.col("shape")).alias("channel_shape"),
    )
    empty = digest_of_sums(F.lit(0), [F.lit(0)] * LANES)
    no = F.lit(False)
    return (
        files.select(key)
        .join(p.hint("merge"), key, "left")
        .join(c.hint("merge"), key, "left")
        .select(
            key,
            F.struct(
                F.coalesce("part_count", F.lit(0)).cast("bigint").alias("part_count"),
                F.coalesce("channel_count", F.lit(0)).cast("bigint").alias("channel_count"),
                F.coalesce("is_deep", no).alias("is_deep"),
                F.coalesce("is_tiled", no).alias("is_tiled"),
                F.coalesce("has_multiview", no).alias("has_multiview"),
                F.coalesce("codec", F.lit("none")).alias("codec"),
                F.coalesce("header_digest", empty).alias("header_digest"),
                F.concat_ws(
                    ";", F.coalesce("part_shape", empty), F.coalesce("channel_shape", empty)
                ).alias("structure_digest"),
            ).alias("structure"),
        )
    )

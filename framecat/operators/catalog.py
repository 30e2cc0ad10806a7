"""Queries on the catalogue tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.functions import vectors
from framecat.schemas import FINGERPRINT_DIM

GIB = 1024 * 1024 * 1024
MIB = 1024 * 1024
OVERSIZED = 500 * MIB


def deep_files(files: DataFrame) -> DataFrame:
    """Deep files, largest first."""
    return files.filter("is_deep").orderBy(F.desc("size_bytes"), "file_id")


def uncompressed_or_oversized(files: DataFrame, parts: DataFrame, key: str = "file_id", max_bytes: int = OVERSIZED) -> DataFrame:
    """Files with an uncompressed part or above a size: one row per such part, with MB."""
    bound = F.lit(max_bytes).cast("bigint")
    joined = files.select(key, "file_path", "size_bytes").join(parts.select(key, "compression"), key)
    odd = joined.filter((F.lower("compression") == "none") | (F.col("size_bytes") > bound))
    return odd.select(
        key, "file_path", (F.col("size_bytes").cast("double") / MIB).alias("size_mb"), "compression"
    )


def overscan_parts(parts: DataFrame) -> DataFrame:
    """Parts whose data window does not start at the origin."""
    return parts.filter((F.col("data_x_offset") != 0) | (F.col("data_y_offset") != 0))


def modified_within(files: DataFrame, days: int, reference: Column, mtime: str = "mtime_ts") -> DataFrame:
    """Files modified in the ``days`` before a reference time or later; the time itself is no upper bound."""
    return files.filter(F.col(mtime) >= reference - F.make_dt_interval(F.lit(days)))


def attribute_like(files: DataFrame, attributes: DataFrame, name: str, text: str, key: str = "file_id") -> DataFrame:
    """Files whose attribute's text contains ``text``."""
    hit = attributes.filter((F.col("attr_name") == name) & F.col("value_text").contains(text))
    return files.select(key, "file_path").join(hit.select(key, "part_index", "value_text"), key)


def attribute_named(files: DataFrame, attributes: DataFrame, name: str, key: str = "file_id") -> DataFrame:
    """JSON value of an attribute, per file and part that has it."""
    hit = attributes.filter(F.col("attr_name") == name)
    return files.select(key, "file_path").join(hit.select(key, "part_index", "value_json"), key)


def find_file(files: DataFrame, normalized_path: str | Column, header_hash: str | Column) -> DataFrame:
    """Point lookup by normalised path and header hash."""
    return files.filter(
        (F.col("file_path_normalized") == normalized_path) & (F.col("header_hash") == header_hash)
    )


def channels_with_parts(channels: DataFrame, parts: DataFrame, key: str = "file_id", path: str | None = None) -> DataFrame:
    """Each channel with its part's name and codec; sorted when asked for one file."""
    rows = channels if path is None else channels.filter(F.col("file_path") == path)
    joined = rows.join(parts.select(key, "part_index", "part_name", "compression"), [key, "part_index"])
    out = joined.select(key, "part_index", "channel_name", "channel_type", "part_name", "compression")
    return out if path is None else out.orderBy("part_index", "channel_name")


def files_with_codec(files: DataFrame, parts: DataFrame, codec: str, key: str = "file_id") -> DataFrame:
    """Files having a part of the codec, and how many such parts; parts fold before the join."""
    hits = (
        parts.filter(F.lower("compression") == codec.lower())
        .groupBy(key)
        .agg(F.count("*").alias("matching_parts"))
    )
    return files.join(hits, key)


def files_having_codec(files: DataFrame, parts: DataFrame, codec: str, key: str = "file_id") -> DataFrame:
    """Files having a part of the codec."""
    hits = parts.filter(F.lower("compression") == codec.lower()).select(key)
    return files.join(hits, key, "left_semi")


def _per_file_codec(files: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """One row per file and codec with its number of parts and the file's size."""
    folded = parts.groupBy(key, "compression").agg(F.count("*").alias("parts"))
    size = F.col("size_bytes").cast("decimal(20,0)").alias("size")
    return folded.join(files.select(key, size), key)


def compression_summary(files: DataFrame, parts: DataFrame, key: str = "file_id") -> DataFrame:
    """Distinct files and total GB per codec, a file's size counted once per part.

    Parts fold to one row per file and codec first: the distinct count becomes a
    plain one and a file with very many parts is one row in the join.
    """
    total = F.sum(F.col("size") * F.col("parts")).cast("double") / GIB
    return (
        _per_file_codec(files, parts, key)
        .groupBy("compression")
        .agg(F.count("*").alias("file_count"), total.alias("total_gb"))
        .orderBy(F.desc("file_count"), "compression")
    )


def compression_summary_once(files: DataFrame, parts: DataFrame, key: str = "file_id") -> DataFrame:
    """The same with a file's size counted once per codec."""
    total = F.sum("size").cast("double") / GIB
    return (
        _per_file_codec(files, parts, key)
        .groupBy("compression")
        .agg(F.count("*").alias("file_count"), total.alias("total_gb"))
        .orderBy(F.desc("file_count"), "compression")
    )


def many_channels(files: DataFrame, channels: DataFrame, more_than: int = 20, key: str = "file_id") -> DataFrame:
    """Files with more channels than so many, most first. Counting comes before the join."""
    counts = channels.groupBy(key).agg(F.count("*").alias("channel_count"))
    busy = counts.filter(F.col("channel_count") > more_than)
    return (
        files.select(key, "file_path", "multipart_count")
        .join(busy, key)
        .orderBy(F.desc("channel_count"), key)
    )


def file_features(files: DataFrame, parts: DataFrame, channels: DataFrame, key: str = "file_id") -> DataFrame:
    """Counts, flags and one codec per file."""
    p = parts.groupBy(key).agg(
        F.count("*").alias("part_count"),
        F.bool_or("is_deep").alias("is_deep"),
        F.bool_or("is_tiled").alias("is_tiled"),
        F.bool_or("multi_view").alias("has_multiview"),
        F.min(F.lower("compression")).alias("compression_type"),
    )
    c = channels.groupBy(key).agg(F.count("*").alias("channel_count"))
    no, zero = F.lit(False), F.lit(0)
    return (
        files.select(key)
        .join(p, key, "left")
        .join(c, key, "left")
        .select(
            key,
            F.coalesce("channel_count", zero).alias("channel_count"),
            F.coalesce("part_count", zero).alias("part_count"),
            F.coalesce("is_deep", no).alias("is_deep"),
            F.coalesce("is_tiled", no).alias("is_tiled"),
            F.coalesce("has_multiview", no).alias("has_multiview"),
            F.coalesce("compression_type", F.lit("none")).alias("compression_type"),
        )
    )


def channel_features(channels: DataFrame, key: str = "file_id") -> DataFrame:
    """Count, layers per channel, half mean samplings, and share of each type per file.

    Folded per (file, root layer) first, so the distinct count is a plain one.
    """
    kind = F.lower("channel_type")
    dotted = F.col("channel_name").contains(".")
    folded = (
        channels.withColumn("root", F.when(dotted, F.substring_index("channel_name", ".", 1)))
        .groupBy(key, "root")
        .agg(
            F.count("*").alias("n"),
            F.sum("x_sampling").alias("xs"),
            F.sum("y_sampling").alias("ys"),
            F.count_if(kind == "float").alias("floats"),
            F.count_if(kind == "half").alias("halves"),
            F.count_if(kind.isin("uint32", "uint")).alias("uint32s"),
            F.count_if(kind == "uint8").alias("uint8s"),
        )
    )
    n = F.sum("n")
    return folded.groupBy(key).agg(
        n.alias("channel_count"),
        (F.count("root") / n).alias("layer_share"),
        (F.sum("xs") / (n * 2)).alias("half_mean_x_sampling"),
        (F.sum("ys") / (n * 2)).alias("half_mean_y_sampling"),
        (F.sum("floats") / n).alias("float_share"),
        (F.sum("halves") / n).alias("half_share"),
        (F.sum("uint32s") / n).alias("uint32_share"),
        (F.sum("uint8s") / n).alias("uint8_share"),
    )


def fingerprints(channels: DataFrame, files: DataFrame, key: str = "file_id", dim: int = FINGERPRINT_DIM) -> DataFrame:
    """Channel fingerprint of every file from its channel rows; the rows of one header meet in one row, as in its payload."""
    row = F.struct("part_index", F.col("channel_name").alias("name"), F.col("channel_type").alias("type"), "x_sampling", "y_sampling")
    gathered = channels.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("channels"))
    # Joined by its partitioning, which spreads the vectors' work over tasks.
    all_files = files.select(key).join(gathered.hint("merge"), key, "left")
    own = F.coalesce("channels", F.array().cast(gathered.schema["channels"].dataType))
    return all_files.select(key, vectors.channel_fingerprint(own, dim).alias("channel_fingerprint"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def layers(channels: DataFrame, key: str = "file_id") -> DataFrame:
    """Layers of each file with their distinct components, sorted, and channel count.

    Folded to distinct components first; what is gathered is one name per
    component of a layer, however many channels carry it.
    """
    folded = channels.groupBy(key, "layer_name", "component_name").agg(F.count("*").alias("n"))
    return folded.groupBy(key, "layer_name").agg(
        F.sum("n").alias("channel_count"),
        F.array_join(F.array_sort(F.collect_list("component_name")), ",").alias("components"),
    )


def concatenated(tables: Sequence[DataFrame]) -> DataFrame:
    """Many batches' rows as one table."""
    return reduce(DataFrame.unionByName, tables)


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()

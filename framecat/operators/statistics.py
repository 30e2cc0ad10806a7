"""Statistics over channel samples: one row per sample, key, position, value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.functions import structure


def is_infinite(value: Column) -> Column:
    return F.abs(value) == F.lit(float("inf"))


def _measures(value: str) -> list[Column]:
    v = F.col(value)
    finite = F.when(~F.isnan(v) & ~is_infinite(v), v)
    return [
        F.min(finite).alias("min_value"),
        F.max(finite).alias("max_value"),
        F.avg(finite).alias("mean_value"),
        F.stddev_pop(finite).alias("stddev_value"),
        F.count_if(F.isnan(v)).alias("nan_count"),
        F.count_if(is_infinite(v)).alias("inf_count"),
    ]


def channel_statistics(samples: DataFrame, *key: str, value: str = "value") -> DataFrame:
    """By the key columns (file, part, channel): minimum, maximum, mean and deviation of finite values; counts of NaN and infinite ones."""
    return samples.groupBy(*key).agg(*_measures(value))


def strided(samples: DataFrame, stride: int, position: str = "pos") -> DataFrame:
    """Every stride-th value of each channel, with the stride used."""
    return samples.filter(F.col(position) % stride == 0).withColumn("sample_stride", F.lit(stride))


def strided_statistics(samples: DataFrame, key: str, stride: int, value: str = "value", position: str = "pos") -> DataFrame:
    """Channel statistics over every stride-th value, with how many were taken."""
    return (
        strided(samples, stride, position)
        .groupBy(key)
        .agg(
            *_measures(value),
            F.first("sample_stride").alias("sample_stride"),
            F.count("*").alias("sampled_pixel_count"),
        )
    )


def content_hash(samples: DataFrame, key: str, position: str, value: str) -> DataFrame:
    """Hash of each channel's (position, value) pairs, whatever order they arrive in.

    Per-pair hashes are added up, so a channel of any size is folded map-side and
    never gathered. A changed, moved, lost or doubled value changes the hash.
    """
    pair = F.md5(F.concat_ws(":", F.col(position).cast("string"), F.col(value).cast("string")))
    return samples.groupBy(key).agg(
        F.count("*").alias("sampled_pixel_count"),
        F.sha2(structure.set_digest_agg(pair), 256).alias("pixel_hash_sampled"),
    )


def stats_rows(samples: DataFrame, key: Sequence[str] = ("file_id", "part_id", "channel_id"), stride: int = 1, at: Column | None = None) -> DataFrame:
    """Rows of the declared ``stats`` table from samples (key, pos, value): measures of every stride-th value, and their hash."""
    pair = F.md5(F.concat_ws(":", F.col("pos").cast("string"), F.col("value").cast("string")))
    return (
        strided(samples, stride)
        .groupBy(*key)
        .agg(
            *_measures("value"),
            F.first("sample_stride").alias("sample_stride"),
            F.count("*").alias("sampled_pixel_count"),
            F.sha2(structure.set_digest_agg(pair), 256).alias("pixel_hash_sampled"),
        )
        .withColumn("computed_at", F.current_timestamp() if at is None else at)
    )

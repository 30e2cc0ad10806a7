"""Idempotent upsert, audit trail, versions and change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUDIT = ("inspection_timestamp", "inspection_count", "last_inspected")

# The messages of an upsert.
INSERTED = "File persisted: %s"
UPDATED = "File already exists, updated audit (count=%d): %s"


def collapse(
    batch: DataFrame,
    key: Sequence[str] = ("file_id",),
    at: str = "last_inspected",
    event: str = "event_id",
) -> DataFrame:
    """One row per key: the row of the earliest (time, event), plus deliveries, first_at, last_at.

    Mergeable, so copies fold before the shuffle and the order of delivery is of no matter.
    """
    rest = [c for c in batch.columns if c not in key]
    return (
        batch.groupBy(*key)
        .agg(
            F.min_by(F.struct(*rest), F.struct(at, event)).alias("_row"),
            F.count("*").alias("deliveries"),
            F.min(at).alias("first_at"),
            F.max(at).alias("last_at"),
        )
        .select(*key, "_row.*", "deliveries", "first_at", "last_at")
    )


def upsert_files(existing: DataFrame, collapsed: DataFrame) -> DataFrame:
    """The next state of the files table.

    New ids come in with their deliveries as count; known ids get the later time
    and a higher count and keep everything else. One shuffle on file_id.
    """
    e = existing.select(F.col("file_id"), F.struct(*existing.columns).alias("e"))
    b = collapsed.select(F.col("file_id"), F.struct(*collapsed.columns).alias("b"))
    have = set(collapsed.columns)

    def column(name: str):
        old = F.col(f"e.{name}")
        kind = existing.schema[name].dataType
        if name == "inspection_count":
            new = F.coalesce(old, F.lit(0)) + F.coalesce(F.col("b.deliveries"), F.lit(0))
        elif name == "last_inspected":
            new = F.greatest(old, F.col("b.last_at"))
        elif name == "inspection_timestamp":
            new = F.coalesce(old, F.col("b.first_at"))
        else:
            added = F.col(f"b.{name}") if name in have else F.lit(None)
            new = F.when(F.col("e").isNotNull(), old).otherwise(added)
        return new.cast(kind).alias(name)

    joined = e.join(b, "file_id", "full_outer")
    return joined.select(
        "file_id", *[column(c) for c in existing.columns if c != "file_id"]
    ).select(*existing.columns)


def insert_children(existing: DataFrame, rows: DataFrame, key: Sequence[str] = ("file_id",)) -> DataFrame:
    """Child rows of files not known yet."""
    return rows.join(existing.select(*key), list(key), "left_anti")


def upsert_outcome(existing: DataFrame, collapsed: DataFrame) -> DataFrame:
    """Per file of the batch: status, inserted, message."""
    known = existing.select("file_id", F.col("inspection_count").alias("old_count"))
    told = collapsed.select("file_id", "deliveries").join(known, "file_id", "left")
    count = F.col("old_count") + F.col("deliveries")
    return told.select(
        "file_id",
        F.lit("success").alias("status"),
        F.col("old_count").isNull().alias("inserted"),
        F.when(F.col("old_count").isNull(), F.format_string(INSERTED, "file_id"))
        .otherwise(F.format_string(UPDATED, count, F.col("file_id")))
        .alias("message"),
    )


def inspection_audit(log: DataFrame, key: str = "file_id", at: str = "ts") -> DataFrame:
    """First seen, last inspected and count per file, from an append-only log."""
    return log.groupBy(key).agg(
        F.min(at).alias("first_seen"), F.max(at).alias("last_inspected"), F.count("*").alias("inspection_count")
    )


def latest_version(files: DataFrame) -> DataFrame:
    """Newest record per bucket and normalised path: largest mtime, then largest file_id.

    One row per path, also where records are equal: of equal mtime and id the largest by the
    other columns. One mergeable aggregate, so a path with very many versions folds before the
    shuffle.
    """
    key = ["s3_bucket", "file_path_normalized"]
    rest = [c for c in files.columns if c not in (*key, "mtime", "file_id")]
    newest = F.max(F.struct("mtime", "file_id", *rest)).alias("_newest")
    return files.groupBy(*key).agg(newest).select(*key, "_newest.*").select(*files.columns)


def detect_changes(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Each batch row as new, changed or unchanged against the newest known header of its path.

    Of known headers of equal time and id the largest counts, so reruns agree.
    """
    key = ["s3_bucket", "file_path_normalized"]
    newest = F.max_by("header_hash", F.struct("mtime", "file_id", "header_hash"))
    known = existing.groupBy(*key).agg(newest.alias("known_hash"))
    change = (
        F.when(F.col("known_hash").isNull(), "new")
        .when(F.col("known_hash") == F.col("header_hash"), "unchanged")
        .otherwise("changed")
    )
    return batch.join(known, key, "left").select(*batch.columns, change.alias("change"))

"""Object keys, paths, identifiers and times."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a media file, and where its frame number stands.
SUPPORTED_SUFFIXES = (".exr",)
FRAME_PATTERN = r"(?i)[._](\d{3,8})\.exr$"


def suffix(key: Column) -> Column:
    """Last dot of the file name and what follows, lower-cased; '' without one.

    A name that only starts with dots has no suffix.
    """
    return F.lower(F.regexp_extract(key, r"[^/.][^/]*(\.[^./]*)$", 1))


def has_suffix(key: Column, suffixes: Iterable[str] = SUPPORTED_SUFFIXES) -> Column:
    return suffix(key).isin([s.lower() for s in suffixes])


def frame_number(key: Column) -> Column:
    digits = F.regexp_extract(key, FRAME_PATTERN, 1)
    return F.when(digits != "", digits.cast("int"))


def normalize_path(path: Column) -> Column:
    """Lower-cased path with '/' separators, without '//', '/./', 'x/..' or a last '/'."""
    slashed = F.lower(F.translate(path, "\\", "/"))
    merged = F.regexp_replace(slashed, r"/(\.?/)+", "/")
    merged = F.regexp_replace(merged, r"^\./", "")
    merged = F.regexp_replace(merged, r"(.)/\.?$", "$1")
    return F.when(merged.contains(".."), _without_parents(merged)).otherwise(merged)


def _without_parents(path: Column) -> Column:
    names = F.filter(F.split(path, "/"), lambda n: n != "")
    kept = F.aggregate(
        names,
        F.array().cast("array<string>"),
        lambda acc, n: F.when(
            n == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        ).otherwise(F.concat(acc, F.array(n))),
    )
    root = F.when(path.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(root, F.array_join(kept, "/"))


def file_id(path: Column, mtime: Column) -> Column:
    text = F.concat(path, F.coalesce(mtime, F.lit("")), F.md5(path))
    return F.substring(F.sha2(text, 256), 1, 16)


def content_id(bucket: Column, key: Column, mtime: Column, header_hash: Column) -> Column:
    """Identity that also changes with the bucket and the header; a line end, which no field holds, parts them."""
    blank = F.lit("")
    return F.sha2(
        F.concat_ws("\n", F.coalesce(bucket, blank), key, F.coalesce(mtime, blank), header_hash), 256
    )


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text of a zone-less UTC timestamp: six fraction digits, or none if zero."""
    text = F.translate(ts.cast("timestamp_ntz").cast("string"), " ", "T")
    text = F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
    return F.concat(text, F.lit("+00:00"))


def iso_utc_from_epoch(seconds: Column) -> Column:
    micros = F.round(seconds * 1_000_000).cast("bigint")
    utc = F.convert_timezone(None, F.lit("UTC"), F.timestamp_micros(micros).cast("timestamp_ntz"))
    return iso_utc(utc)

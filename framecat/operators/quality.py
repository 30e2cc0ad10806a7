"""Data-quality checks and policy rules, as jobs over tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framecat.functions import values, vectors
from framecat.operators.statistics import is_infinite

# Allowed norm of a unit vector, and policy severities.
NORM_RANGE = (0.99, 1.01)
SEVERITIES = ("PASS", "WARN", "FAIL")
ENUMS = {
    "line_order": ("INCREASING_Y", "DECREASING_Y", "RANDOM_Y"),
    "compression": ("NONE", "RLE", "ZIPS", "ZIP", "PIZ", "PXR24", "B44", "B44A", "DWAA", "DWAB"),
    "channel_type": ("HALF", "FLOAT", "UINT"),
}


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, in one scan: column_name, null_count."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    )
    return counts.select(F.inline(pairs))


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*key).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def check_foreign_key(child: DataFrame, parent: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of child rows without a parent, and how many rows have them.

    The child folds to its keys first, so a key with very many rows is one row in the join.
    """
    keys = child.groupBy(*key).agg(F.count("*").alias("row_count"))
    return keys.join(parent.select(*key), list(key), "left_anti")


def check_enum(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed ones (upper-cased), and how often they occur; NULLs pass."""
    upper = F.upper(column)
    return (
        df.filter(~upper.isin(list(allowed)))
        .groupBy(F.col(column).alias("bad_value"))
        .agg(F.count("*").alias("row_count"))
    )


def check_types(lines: DataFrame, expected: dict[str, str], text: str = "value") -> DataFrame:
    """Per JSON path: how many values are missing, are of another kind, and how many there should be.

    ``expected`` maps a path such as ``$.file.size_bytes`` or ``$.parts[*].width`` to a kind of
    ``values.kind``; ``[*]`` stands for every element of a list, at any depth. A text is parsed once: its
    lists are taken apart level by level, and the elements of all levels fold to one row in one aggregation.
    """
    by_level: dict[str, list[tuple[str, str, str]]] = {}
    for path, wanted in expected.items():
        prefix, mark, rest = path.rpartition("[*]")
        by_level.setdefault(prefix + mark, []).append((path, "$" + rest if mark else rest, wanted))
    levels = _levels(by_level)
    rows = lines.select(F.lit(0).alias("level"), F.try_parse_json(F.col(text)).alias("v"))
    for depth in range(1, max((p.count("[*]") for p in levels), default=0) + 1):
        # The elements of each list of this depth, behind the row that holds it.
        own, below = [F.array("v")], [p for p in levels if p.count("[*]") == depth]
        for prefix in below:
            outer, _, last = prefix.removesuffix("[*]").rpartition("[*]")
            at = levels.index(f"{outer}[*]" if outer else "")
            own.append(F.when(F.col("level") == at, F.try_variant_get(F.col("v"), f"${last}" if outer else last, "array<variant>")))
        held = rows.select("level", F.posexplode(F.array(*own)).alias("pos", "list"))
        at = F.element_at(F.array("level", *[F.lit(levels.index(p)) for p in below]), F.col("pos") + 1)
        rows = held.select(at.alias("level"), F.explode("list").alias("v"))
    shapes, counts, told = [], [F.count_if(F.col("level") == i).alias(f"n{i}") for i in range(len(levels))], []
    for prefix, fields in by_level.items():
        here, n = F.col("level") == levels.index(prefix), f"n{levels.index(prefix)}"
        for path, inner, wanted in fields:
            i, shape = len(shapes), F.col(f"s{len(shapes)}")
            shapes.append(F.when(here, values.shape(F.col("v"), inner, wanted)).alias(f"s{i}"))
            counts += [F.count_if(here & shape.isNull()).alias(f"m{i}"), F.count_if(here & ~values.is_kind(shape, wanted)).alias(f"w{i}")]
            told_of = (F.lit(path).alias("field"), F.col(f"m{i}").alias("missing"), F.col(f"w{i}").alias("wrong_type"))
            told.append(F.struct(*told_of, F.col(n).alias("expected")))
    return rows.select("level", *shapes).agg(*counts).select(F.inline(F.array(*told)))


def _levels(prefixes: Iterable[str]) -> list[str]:
    """The prefixes, and those of the lists that hold their lists, outermost first."""
    every = {""}
    for prefix in prefixes:
        pieces = prefix.split("[*]")
        every |= {"".join(f"{p}[*]" for p in pieces[:k]) for k in range(1, len(pieces))}
    return sorted(every, key=lambda p: (p.count("[*]"), p))


def undeclared_fields(lines: DataFrame, declared: dict[str, Sequence[str]], text: str = "value") -> DataFrame:
    """Fields that objects have beyond the declared ones: path, field, row_count.

    ``declared`` maps the path of an object, or of a list of objects (ending with ``[*]``), to its fields.
    A text is parsed once; only the names of its objects' fields are taken out of it.
    """
    parsed = lines.select(F.try_parse_json(F.col(text)).alias("v"))
    one = f"map<string, {values.UNREAD}>"  # what is no object is NULL
    many = f"array<{one}>"
    objects = [
        F.try_variant_get(F.col("v"), p.removesuffix("[*]"), many) if p.endswith("[*]") else F.array(F.try_variant_get(F.col("v"), p, one))
        for p in declared
    ]
    held = parsed.select(F.posexplode(F.array(*objects)).alias("pos", "objects")).select("pos", F.explode("objects").alias("o"))
    fields = held.select("pos", F.explode(F.map_keys("o")).alias("field"))
    beyond = [(F.col("pos") == i) & ~F.col("field").isin(list(names)) for i, names in enumerate(declared.values())]
    path = F.element_at(F.array(*[F.lit(p) for p in declared]), F.col("pos") + 1)
    counted = fields.filter(reduce(or_, beyond)).groupBy("pos", "field").agg(F.count("*").alias("row_count"))
    return counted.select(path.alias("path"), "field", "row_count")


def check_vectors(df: DataFrame, column: str, dim: int) -> DataFrame:
    """Counts of vectors by fault; a zero vector is no fault of norm."""
    vector = vectors.as_double(F.col(column))
    told = df.select(
        F.size(vector).alias("d"),
        F.exists(vector, lambda x: F.isnan(x) | is_infinite(x)).alias("odd"),
        vectors.norm(F.col(column)).alias("length"),
    )
    finite = ~F.col("odd")
    low, high = NORM_RANGE
    return told.agg(
        F.count("*").alias("vectors"),
        F.count_if(F.col("d") != dim).alias("wrong_length"),
        F.count_if("odd").alias("not_finite"),
        F.count_if(finite & (F.col("length") == 0)).alias("zero"),
        F.count_if(finite & (F.col("length") != 0) & ~F.col("length").between(low, high)).alias("not_unit"),
    )


@dataclass(frozen=True)
class Policy:
    """What a house expects of its files."""

    policy_id: str = "house"
    version: str = "1"
    codecs: tuple[str, ...] = ("zip", "zips", "piz", "dwaa", "dwab")
    max_bytes: int = 500 * 1024 * 1024
    max_tile: int = 64


BROKEN = "%s: %s where %s is expected"


def validate(files: DataFrame, parts: DataFrame, policy: Policy, key: str = "file_id", at: Column | None = None) -> DataFrame:
    """One row per file and rule, as the declared table has it. Parts fold to one row per file before the join."""
    bad = ~F.lower("compression").isin(list(policy.codecs))
    folded = parts.groupBy(key).agg(
        F.count_if(bad).alias("bad_codecs"),
        F.min(F.when(bad, F.lower("compression"))).alias("bad_codec"),
        F.max("tile_width").alias("max_tile"),
    )
    facts = files.select(key, "size_bytes", "frame_number").join(folded, key, "left")

    def rule(name: str, broken: Column, severity: str, status: str, expected: str, actual: Column, fix: str) -> Column:
        failed = F.coalesce(broken, F.lit(False))
        return F.struct(
            F.lit(name).alias("rule_id"),
            F.when(failed, severity).otherwise("PASS").alias("severity"),
            F.when(failed, status).otherwise("OK").alias("status"),
            F.when(failed, F.format_string(BROKEN, F.lit(name), F.coalesce(actual.cast("string"), F.lit("nothing")), F.lit(expected))).alias("message"),
            F.lit(expected).alias("expected_value"),
            actual.cast("string").alias("actual_value"),
            F.when(failed, fix).alias("suggested_fix"),
        )

    size, tile, frame = F.col("size_bytes"), F.col("max_tile"), F.col("frame_number")
    rules = F.array(
        rule("compression_check", F.col("bad_codecs") > 0, "WARN", "SUBOPTIMAL_COMPRESSION",
             ",".join(policy.codecs), F.col("bad_codec"), "Re-render with an allowed compression"),
        rule("size_check", size > F.lit(policy.max_bytes).cast("bigint"), "FAIL", "OVERSIZED",
             str(policy.max_bytes), size, "Split parts or compress"),
        rule("frame_check", frame.isNull(), "WARN", "NO_FRAME_NUMBER",
             "3 to 8 digits before the suffix", frame, "Rename with a frame number"),
        rule("tile_check", tile > policy.max_tile, "FAIL", "TILE_TOO_LARGE",
             str(policy.max_tile), tile, "Re-tile"),
    )
    return facts.select(
        key,
        F.lit(policy.policy_id).alias("policy_id"),
        F.lit(policy.version).alias("policy_version"),
        F.inline(rules),
    ).withColumn("validated_at", F.current_timestamp() if at is None else at)


def file_severity(results: DataFrame, key: str = "file_id") -> DataFrame:
    """Worst severity per file and number of broken rules."""
    rank = reduce(
        lambda acc, iv: acc.when(F.col("severity") == iv[1], iv[0]), enumerate(SEVERITIES), F
    )
    return (
        results.groupBy(key)
        .agg(F.max(rank).alias("worst"), F.count_if(F.col("severity") != "PASS").alias("broken_rules"))
        .select(
            key,
            F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("worst") + 1).alias("severity"),
            "broken_rules",
        )
    )

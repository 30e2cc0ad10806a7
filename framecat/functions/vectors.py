"""Deterministic structure vectors and vector distances, all in double."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from framecat.functions.channels import root_layer
from framecat.functions.codecs import compression_score
from framecat.functions.values import bind
from framecat.schemas import FINGERPRINT_DIM, METADATA_DIM

# Feature scales, channel types in feature order, and the zero bound.
CHANNEL_SCALE = 64.0
PART_SCALE = 16.0
TYPE_ORDER = ("float", "half", "uint32", "uint8")
TYPE_ALIASES = {"uint": "uint32"}
DEGENERATE = 1e-9

WORDS_PER_HASH = 8
ZERO = 0.0


def word(hex_text: Column, j: Column | int) -> Column:
    """j-th group of eight hex digits as a number in [0, 1)."""
    at = F.lit(1) + F.lit(8) * (F.lit(j) if isinstance(j, int) else j)
    return F.conv(F.substr(hex_text, at, F.lit(8)), 16, 10).cast("double") / 4294967296.0


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def _sum_of(vector: Column, term) -> Column:
    return F.aggregate(vector, F.lit(ZERO), lambda acc, v: acc + term(v))


def norm(vector: Column) -> Column:
    return F.sqrt(_sum_of(as_double(vector), lambda v: v * v))


def l2_normalize(vector: Column) -> Column:
    """Unit vector; one too short to have a direction becomes the uniform vector."""

    def scaled(v: Column) -> Column:
        def by(length: Column) -> Column:
            return F.when(
                length < DEGENERATE,
                F.transform(v, lambda _: F.lit(1.0) / F.sqrt(F.size(v).cast("double"))),
            ).otherwise(F.transform(v, lambda x: x / length))

        return bind(norm(v), by)

    return bind(as_double(vector), scaled)


def metadata_features(structure: Column) -> Column:
    """Six scaled features of a structure struct."""

    def flag(name: str) -> Column:
        return structure[name].cast("double")

    return F.array(
        structure["channel_count"].cast("double") / CHANNEL_SCALE,
        structure["part_count"].cast("double") / PART_SCALE,
        flag("is_deep"),
        flag("is_tiled"),
        flag("has_multiview"),
        compression_score(structure["codec"]),
    )


def metadata_embedding(structure: Column, dim: int = METADATA_DIM, tail_weight: float = 1.0) -> Column:
    """Features, then hash words of the structure digest, as a unit vector.

    A small tail weight ranks neighbours by features, a weight of 1 mostly tells
    equal structures from different ones.
    """
    features = metadata_features(structure)
    blocks = math.ceil(max(0, dim - 6) / WORDS_PER_HASH)
    if blocks:
        def words(seed: Column) -> Column:
            return F.flatten(
                F.transform(
                    F.sequence(F.lit(0), F.lit(blocks - 1)),
                    lambda i: bind(
                        F.sha2(F.concat(seed, F.lit("#"), i.cast("string")), 256),
                        lambda h: F.array(
                            *[word(h, j) * tail_weight for j in range(WORDS_PER_HASH)]
                        ),
                    ),
                )
            )

        features = F.concat(features, bind(structure["structure_digest"], words))
    return l2_normalize(F.slice(features, 1, dim))


def channel_fingerprint(channels: Column, dim: int = FINGERPRINT_DIM) -> Column:
    """Unit vector of a channel array; zeros when there is no channel.

    Counts, layers, samplings and type shares, hash words of the names in array
    order, then a closed-form padding.
    """

    def of(chs: Column) -> Column:
        n = F.size(chs).cast("double")
        names = F.transform(chs, lambda c: F.coalesce(c["name"], F.lit("")))
        roots = F.array_distinct(F.transform(F.filter(names, lambda x: x.contains(".")), root_layer))
        types = F.transform(chs, lambda c: F.lower(c["type"]))

        def sampling(name: str) -> Column:
            return F.aggregate(
                chs, F.lit(0).cast("bigint"), lambda acc, c: acc + F.coalesce(c[name], F.lit(1))
            ) / (n * 2)

        def share(kind: str) -> Column:
            spellings = [kind, *[a for a, k in TYPE_ALIASES.items() if k == kind]]
            return F.size(F.filter(types, lambda t: t.isin(spellings))) / n

        shape = F.array(
            n / CHANNEL_SCALE,
            F.size(roots) / n,
            sampling("x_sampling"),
            sampling("y_sampling"),
            *[share(k) for k in TYPE_ORDER],
        )
        hashed = bind(F.md5(F.array_join(names, "|")), lambda h: F.array(*[word(h, j) for j in range(3)]))
        return F.when(F.size(chs) > 0, bind(F.concat(shape, hashed), lambda v: _padded(v, dim)))

    zeros = F.array_repeat(F.lit(ZERO), dim)
    return F.coalesce(bind(channels, of), zeros)


def _padded(head: Column, dim: int) -> Column:
    if dim > 11:
        def pad(total: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(11), F.lit(dim - 1)), lambda i: F.abs(total * (i + 1)) % 1.0
            )

        head = F.concat(head, bind(head[0] + head[1] + head[2] + head[3], pad))
    return l2_normalize(F.slice(head, 1, dim))


def inner_product(a: Column, b: Column) -> Column:
    return _sum_of(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), lambda v: v)


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(
        _sum_of(F.zip_with(as_double(a), as_double(b), lambda x, y: x - y), lambda d: d * d)
    )


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine, between 0 and 2; NULL when either vector is zero."""
    lengths = norm(a) * norm(b)
    cosine = inner_product(a, b) / lengths
    return F.when(lengths != 0, 1 - F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def literal(vector: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in vector])


DISTANCES = {
    "cosine": cosine_distance,
    "euclidean": l2_distance,
    # Larger products are nearer, so the order is by the negative product.
    "dot_product": lambda a, b: -inner_product(a, b),
}


def distance(metric: str, a: Column, b: Column) -> Column:
    if metric not in DISTANCES:
        raise ValueError(f"metric must be one of {sorted(DISTANCES)}, not {metric!r}")
    return DISTANCES[metric](a, b)

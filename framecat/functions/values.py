"""Attribute values and windows, held as VARIANT."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOX_FIELDS = ("min_x", "min_y", "max_x", "max_y")

# The two spellings of a bounding box, {min: {x, y}, max: {x, y}} and flat.
_OUTER = "struct<min: variant, max: variant, xMin: variant, yMin: variant, xMax: variant, yMax: variant>"
_INNER = "struct<x: variant, y: variant>"
_CORNERS = (("min", "x", "xMin"), ("min", "y", "yMin"), ("max", "x", "xMax"), ("max", "y", "yMax"))


_KINDS = {"VOID": "null", "OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "bool", "BIGINT": "int"}
#: A type that hardly a value fits, so that reading one as it costs next to nothing (as a scalar, each is cast).
UNREAD = "array<array<boolean>>"
#: Kinds that hold others: their names, and a type that only they fit and that leaves their content out.
_HOLDERS = {"object": ("OBJECT", f"struct<x: {UNREAD}>"), "array": ("ARRAY", f"array<{UNREAD}>")}


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate a column once and use it many times, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def variant(text: Column) -> Column:
    return F.try_parse_json(text)


def kind(value: Column) -> Column:
    """One of object, array, string, bool, int, float, null."""
    shape = F.substring_index(F.schema_of_variant(value), "<", 1)  # named once, so told once
    named = F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair])
    return F.coalesce(F.try_element_at(named, shape), F.when(value.isNull(), "null").otherwise("float"))


def shape(value: Column, path: str, wanted: str) -> Column:
    """What ``is_kind`` needs of the value at a path, NULL where there is none.

    Whether a value is a list or an object, where one is wanted, is told without a look at all it holds.
    """
    at = value if path == "$" else F.try_variant_get(value, path, "variant")
    if wanted not in _HOLDERS:
        return F.substring_index(F.schema_of_variant(at), "<", 1)
    name, held = _HOLDERS[wanted]
    return F.when(F.try_variant_get(value, path, held).isNotNull(), name).when(at.isNotNull(), "OTHER")


def is_kind(shape: Column, wanted: str) -> Column:
    """Whether a ``shape`` is of a kind of ``kind``; NULL if it is."""
    named = [s for s, k in _KINDS.items() if k == wanted]
    return shape.isin(named) if named else ~shape.isin(list(_KINDS))


def json_text(value: Column) -> Column:
    """Canonical JSON text of a VARIANT; an absent value is the text null.

    A float without fraction keeps its point, so that reading it again gives a float.
    """
    text = F.coalesce(F.to_json(value), F.lit("null"))
    whole = (kind(value) == "float") & text.rlike(r"^-?\d+$")
    return F.when(whole, F.concat(text, F.lit(".0"))).otherwise(text)


def attribute_values(value: Column) -> dict[str, Column]:
    """JSON text and the typed shadows. Booleans are neither number, floats not ints."""
    of_kind = kind(value)
    return {
        "value_json": json_text(value),
        "value_text": F.when(of_kind == "string", F.try_variant_get(value, "$", "string")),
        "value_int": F.when(of_kind == "int", F.try_variant_get(value, "$", "bigint")),
        "value_float": F.when(
            of_kind.isin("int", "float"), F.try_variant_get(value, "$", "double")
        ),
    }


def truthy(value: Column) -> Column:
    """False for null, false, zero, and empty text, list or object."""
    of_kind = kind(value)
    number = F.try_variant_get(value, "$", "double")
    return (
        F.when(of_kind == "null", False)
        .when(of_kind.isin("int", "float"), number != 0)
        .otherwise(~F.to_json(value).isin("false", '""', "[]", "{}"))
    )


def window_ints(box: Column) -> Column:
    """Struct min_x, min_y, max_x, max_y of a box; NULL when it is not one.

    A missing corner counts as 0; a corner that is no number makes the box NULL.
    """

    def from_outer(outer: Column) -> Column:
        sides = [F.try_variant_get(outer[n], "$", _INNER).alias(n) for n in ("min", "max")]
        return bind(F.struct(*sides), lambda inner: from_sides(outer, inner))

    def from_sides(outer: Column, inner: Column) -> Column:
        present = [F.coalesce(inner[side][axis], outer[flat]) for side, axis, flat in _CORNERS]
        read = F.struct(
            *[c.isNotNull().alias(f"has_{n}") for n, c in zip(BOX_FIELDS, present)],
            *[F.try_variant_get(c, "$", "int").alias(n) for n, c in zip(BOX_FIELDS, present)],
        )
        no_side = [outer[n].isNotNull() & inner[n].isNull() for n in ("min", "max")]

        def checked(r: Column) -> Column:
            broken = no_side + [r[f"has_{n}"] & r[n].isNull() for n in BOX_FIELDS]
            found = F.struct(*[F.coalesce(r[n], F.lit(0)).alias(n) for n in BOX_FIELDS])
            return F.when(outer.isNotNull() & ~reduce(or_, broken), found)

        return bind(read, checked)

    return bind(F.try_variant_get(box, "$", _OUTER), from_outer)  # NULL unless an object


def display_dims(data: Column, display: Column, width: Column, height: Column) -> dict[str, Column]:
    """Display size from its window, else the data size; offset from the data window, else 0."""
    return {
        "display_width": F.coalesce(display["max_x"] - display["min_x"] + 1, width),
        "display_height": F.coalesce(display["max_y"] - display["min_y"] + 1, height),
        "data_x_offset": F.coalesce(data["min_x"], F.lit(0)),
        "data_y_offset": F.coalesce(data["min_y"], F.lit(0)),
    }


def binary_json(value: Column) -> Column:
    """JSON object carrying binary data as base64."""
    # Some sessions cut base64 text into lines.
    text = F.translate(F.base64(value), "\r\n", "")
    body = F.struct(F.lit("base64").alias("encoding"), text.alias("data"))
    return F.when(value.isNotNull(), F.to_json(body))


def json_safe(value: Column, kind: T.DataType) -> Column:
    """A value of any type as one that JSON can hold, however deep: binary data as base64 objects, keys as text.

    Boxes, vectors and colours are structs already and become objects of their fields. Numbers
    that JSON lacks (NaN, infinite) become null.
    """
    if isinstance(kind, T.BinaryType):
        text = F.translate(F.base64(value), "\r\n", "")
        return F.when(value.isNotNull(), F.struct(F.lit("base64").alias("encoding"), text.alias("data")))
    if isinstance(kind, T.StructType):
        inner = F.struct(*[json_safe(value[f.name], f.dataType).alias(f.name) for f in kind])
        return F.when(value.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: json_safe(x, kind.elementType))
    if isinstance(kind, T.MapType):
        told = F.transform_values(value, lambda k, v: json_safe(v, kind.valueType))
        return told if isinstance(kind.keyType, T.StringType) else F.transform_keys(told, lambda k, v: k.cast("string"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.abs(value) < float("inf"), value)
    return value


def json_safe_text(value: Column, kind: T.DataType) -> Column:
    """JSON text of ``json_safe``; NULL is the text null."""
    options = {"ignoreNullFields": "false"}
    inside = F.to_json(F.array(json_safe(value, kind)), options)
    return F.substring(inside, F.lit(2), F.length(inside) - 2)


def box_json(min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    low = F.struct(min_x.alias("x"), min_y.alias("y"))
    high = F.struct(max_x.alias("x"), max_y.alias("y"))
    return F.to_json(F.struct(low.alias("min"), high.alias("max")))


def vector_json(*parts: Column) -> Column:
    return F.to_json(F.struct(*[p.alias(n) for n, p in zip("xyzw", parts)]))


def colour_json(*parts: Column) -> Column:
    return F.to_json(F.struct(*[p.alias(n) for n, p in zip("rgba", parts)]))

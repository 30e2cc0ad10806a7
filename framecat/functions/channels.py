"""Channel names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def layer_name(name: Column) -> Column:
    """What stands before the last dot; '' for a flat name."""
    return F.regexp_extract(name, r"(?s)^(.*)\.[^.]*$", 1)


def component_name(name: Column) -> Column:
    """What stands after the last dot; the whole of a flat name."""
    return F.substring_index(name, ".", -1)


def root_layer(name: Column) -> Column:
    """What stands before the first dot: the grouping used by the fingerprint."""
    return F.substring_index(name, ".", 1)

"""Helpers for nested columns and topic-keyed records.

Topic names are data, so they may hold dots or blanks.  Fields named after topics are
therefore always reached with ``getField`` and never through a dotted path string.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


def has_field(frame: DataFrame, path: str) -> bool:
    """True when the dotted ``path`` exists in the schema of ``frame``."""
    level = frame.schema
    for name in path.split("."):
        if not isinstance(level, StructType) or name not in level.fieldNames():
            return False
        level = level[name].dataType
    return True


def topic_struct(values: Mapping[str, Column], name: str) -> Column:
    """One struct with a field per topic, in the order of ``values``."""
    return F.struct(*[value.alias(topic) for topic, value in values.items()]).alias(name)


def zero_if_null(value: Column, kind: str = "double") -> Column:
    return F.coalesce(value, F.lit(0).cast(kind))

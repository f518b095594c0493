"""Checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(
    side: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    measured: tuple[int, int] | None = None,
) -> DataFrame:
    """The side with a broadcast hint when it is measured to be small; else unchanged.

    The measure is one aggregate over the side.  Beyond the bound the join shuffles both sides and
    adaptive execution splits skewed partitions.
    """
    rows, size = measured or measure(side)
    return F.broadcast(side) if rows <= max_rows and size <= max_bytes else side


def measure(side: DataFrame) -> tuple[int, int]:
    """Rows and bytes, about."""
    width = sum((_width(field) for field in side.schema.fields), F.lit(0))
    return tuple(side.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first())


def _width(field: T.StructField) -> Column:
    """Bytes of a value, about."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        value = F.to_json(F.struct(value))
    elif not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(16)
    return F.coalesce(F.octet_length(value), F.lit(0)) + 16

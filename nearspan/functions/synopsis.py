"""What a group of rows can hold: smallest and largest value, hash marks and missing values of each column.

A synopsis tells for a filter tree whether any row of the group can match.  It may say yes for nothing, never no for
a row that matches.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.functions.filters import COMPARE, FilterGroup, MetaFilter, _align
from nearspan.schema import TableConfig

MARKS = 256


def summarised(fields: Iterable[T.StructField]) -> list[T.StructField]:
    """The fields that get a synopsis: those whose values have an order."""
    kinds = (T.StringType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    return [f for f in fields if isinstance(f.dataType, kinds)]


def mark(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(MARKS)).cast("int")


def aggregates(fields: Sequence[T.StructField]) -> list[Column]:
    """Synopsis columns of a group of rows; a mark set has at most ``MARKS`` entries."""
    out = []
    for f in fields:
        value = F.col(f"`{f.name}`")
        out += [F.min(value).alias(f"min_{f.name}"), F.max(value).alias(f"max_{f.name}")]
        out += [F.collect_set(F.when(value.isNotNull(), mark(value))).alias(f"marks_{f.name}")]
        out += [F.count_if(value.isNull()).alias(f"nulls_{f.name}")]
    return out


def combined(fields: Sequence[T.StructField]) -> list[Column]:
    """The synopsis of several groups from theirs."""
    out = []
    for f in fields:
        out += [F.min(f"min_{f.name}").alias(f"min_{f.name}"), F.max(f"max_{f.name}").alias(f"max_{f.name}")]
        out += [F.array_distinct(F.flatten(F.collect_list(f"marks_{f.name}"))).alias(f"marks_{f.name}")]
        out += [F.sum(f"nulls_{f.name}").alias(f"nulls_{f.name}")]
    return out


def possible(filters: MetaFilter | FilterGroup | None, config: TableConfig, fields: Sequence[T.StructField]) -> Column:
    """Whether a row of the group can match, on synopsis columns and ``n_rows``."""
    if filters is None:
        return F.lit(True)
    if isinstance(filters, MetaFilter):
        return _possible(filters, config, {f.name: f.dataType for f in fields})
    parts = [possible(p, config, fields) for p in filters.filters if not _empty(p)]
    if not parts:
        return F.lit(True)
    return reduce((lambda a, b: a & b) if filters.condition == "and" else (lambda a, b: a | b), parts)


def _empty(part: MetaFilter | FilterGroup) -> bool:
    return isinstance(part, FilterGroup) and all(_empty(p) for p in part.filters)


def _possible(item: MetaFilter, config: TableConfig, kinds: dict[str, T.DataType]) -> Column:
    if item.key not in kinds or config.promoted_type(item.key) is None:
        return F.lit(True)
    nulls = F.col(f"nulls_{item.key}")
    if item.value is None:
        return nulls > 0 if item.operator == "==" else nulls < F.col("n_rows")
    if item.operator == "in":
        return reduce(lambda a, b: a | b, [_holds(item.key, kinds[item.key], "==", v) for v in item.value])
    if item.operator == "nin":
        return nulls < F.col("n_rows")
    return _holds(item.key, kinds[item.key], item.operator, item.value)


def _holds(key: str, dtype: T.DataType, operator: str, value) -> Column:
    """Whether a value between the smallest and the largest can compare so; an unknown comparison holds nowhere."""
    if value is None:
        return F.lit(False)
    # Texts have the order of texts; compared with another kind they are converted, which keeps no order.
    if isinstance(dtype, T.StringType) and not isinstance(value, str):
        return F.lit(True)
    low, right = _align(F.col(f"min_{key}"), dtype, value)
    high, _ = _align(F.col(f"max_{key}"), dtype, value)
    if operator == "==":
        found = (low <= right) & (high >= right)
        if isinstance(dtype, T.StringType):
            found = found & F.array_contains(f"marks_{key}", mark(F.lit(value)))
        elif isinstance(dtype, T.IntegralType) and type(value) is int:
            found = found & F.coalesce(F.array_contains(f"marks_{key}", mark(F.lit(str(value)).try_cast(dtype))), F.lit(False))
    elif operator == "!=":
        found = (low != right) | (high != right)
    else:
        found = COMPARE[operator](high if operator in (">", ">=") else low, right)
    return F.coalesce(found, F.lit(False))

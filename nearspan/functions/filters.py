"""Metadata filters: a tree of comparisons folded to one boolean column.

Comparisons follow SQL's three-valued logic: a row whose key is missing matches neither ``=``
nor ``!=``, ``in`` nor ``nin``.  A key with a promoted column is compared there, in the column's
type, so the predicate can reach the Parquet scan; any other key is read from the JSON column.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Any, Union

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.functions.metadata import read_key
from nearspan.schema import TableConfig, check_key

COMPARE = {
    "==": lambda left, right: left == right,
    "!=": lambda left, right: left != right,
    ">": lambda left, right: left > right,
    ">=": lambda left, right: left >= right,
    "<": lambda left, right: left < right,
    "<=": lambda left, right: left <= right,
}
LISTS = ("in", "nin")
WIDE = "decimal(38,10)"


@dataclass(frozen=True)
class MetaFilter:
    """One comparison; ``None`` with ``==`` or ``!=`` asks for missing or present."""

    key: str
    value: Any
    operator: str = "=="

    def __post_init__(self):
        check_key(self.key)
        several = isinstance(self.value, (list, tuple, set, frozenset))
        if self.operator not in COMPARE and self.operator not in LISTS:
            raise ValueError(f"operator {self.operator!r} must be one of {[*COMPARE, *LISTS]}")
        if self.operator in LISTS:
            if not several or not self.value:
                raise ValueError(f"operator {self.operator!r} on {self.key!r} needs a list with values")
        elif several:
            raise ValueError(f"operator {self.operator!r} on {self.key!r} takes one value, not a list")
        elif self.value is None and self.operator not in ("==", "!="):
            raise ValueError(f"operator {self.operator!r} on {self.key!r} cannot compare with None")


@dataclass(frozen=True)
class FilterGroup:
    """Filters and groups joined by ``and`` or ``or``; empty inner groups are skipped."""

    filters: tuple[Union[MetaFilter, "FilterGroup"], ...] = ()
    condition: str = "and"

    def __init__(self, filters: Iterable[Union[MetaFilter, "FilterGroup"]] = (), condition: str = "and"):
        object.__setattr__(self, "filters", tuple(filters))
        object.__setattr__(self, "condition", condition)
        if condition not in ("and", "or"):
            raise ValueError(f"condition {condition!r} must be 'and' or 'or'")
        for part in self.filters:
            if not isinstance(part, (MetaFilter, FilterGroup)):
                raise ValueError(f"{part!r} is neither a filter nor a group of filters")


def predicate(filters: MetaFilter | FilterGroup | None, config: TableConfig) -> Column | None:
    """One boolean column for a filter tree, or None when the tree holds no filter."""
    if filters is None:
        return None
    if isinstance(filters, MetaFilter):
        return _comparison(filters, config)
    parts = [p for p in (predicate(part, config) for part in filters.filters) if p is not None]
    if not parts:
        return None
    return reduce((lambda a, b: a & b) if filters.condition == "and" else (lambda a, b: a | b), parts)


def _comparison(item: MetaFilter, config: TableConfig) -> Column:
    dtype = config.promoted_type(item.key)
    if dtype is not None:
        left = F.col(item.key)
    elif config.metadata_column is not None:
        left, dtype = read_key(F.col(config.metadata_column), item.key), T.StringType()
    else:
        raise ValueError(f"cannot filter on {item.key!r}: no column of that name and no JSON metadata column")
    return compared(left, dtype, item)


def compared(left: Column, dtype: T.DataType, item: MetaFilter) -> Column:
    """The comparison of one filter, on the column that holds its key's value."""
    if item.value is None:
        return left.isNull() if item.operator == "==" else left.isNotNull()
    if item.operator in LISTS:
        found = _member(left, dtype, item.value)
        return found if item.operator == "in" else ~found
    left, right = _align(left, dtype, item.value)
    return COMPARE[item.operator](left, right)


def _member(left: Column, dtype: T.DataType, values: Iterable[Any]) -> Column:
    """Membership, comparing each value by its own kind; with None listed, a miss is NULL as in SQL."""
    values = list(values)
    kinds: dict[type, list[Any]] = {}
    for value in values:
        if value is not None:
            kinds.setdefault(_kind(value), []).append(value)
    if not kinds:
        return F.lit(None).cast("boolean")
    found = []
    for group in kinds.values():
        pairs = [_align(left, dtype, value) for value in group]
        found.append(pairs[0][0].isin([right for _, right in pairs]))
    if len(found) == 1 and None not in values:
        # A plain IN reaches the scan; a missing key is unknown by itself.
        return found[0]
    # A value that does not convert must not hide a match of another kind.
    if len(found) > 1:
        found = [F.coalesce(part, F.lit(False)) for part in found]
    matched = reduce(lambda a, b: a | b, found)
    if None in values:
        return F.when(matched, F.lit(True))
    return F.when(left.isNotNull(), matched)


def _exact(value: int | decimal.Decimal) -> Column:
    return F.lit(str(value)).try_cast(WIDE)


def _kind(value: Any) -> type:
    if isinstance(value, bool):
        return bool
    if isinstance(value, (int, decimal.Decimal)):
        return decimal.Decimal
    if isinstance(value, float):
        return float
    if isinstance(value, str):
        return str
    if isinstance(value, (datetime.date, datetime.datetime)):
        return datetime.date
    raise ValueError(f"cannot compare metadata with a {type(value).__name__}")


def _align(left: Column, dtype: T.DataType, value: Any) -> tuple[Column, Column]:
    """Both sides in a common type.  Conversions never fail; what does not convert is NULL.

    Integers and decimals compare exactly, with up to 28 digits before the point; floats as doubles.
    """
    kind = _kind(value)
    if isinstance(dtype, T.StringType):
        if kind is decimal.Decimal:
            return left.try_cast(WIDE), _exact(value)
        if kind is float:
            return left.try_cast("double"), F.lit(value)
        if kind is bool:
            return left, F.lit("true" if value else "false")
        if kind is datetime.date:
            return left.try_cast("timestamp"), F.lit(value).cast("timestamp")
        return left, F.lit(value)
    if isinstance(dtype, T.NumericType):
        if kind in (float, decimal.Decimal):
            fits = isinstance(value, float) or -(1 << 63) <= value < 1 << 63
            return left, F.lit(value) if fits else _exact(value)
        if kind is bool:
            return left, F.lit(int(value))
        whole = isinstance(dtype, (T.IntegralType, T.DecimalType))
        return left, F.lit(str(value)).try_cast(WIDE if whole else "double")
    if isinstance(dtype, T.BooleanType):
        return left, F.lit(value if kind is bool else str(value)).try_cast("boolean")
    return left, F.lit(value if kind is datetime.date else str(value)).try_cast(dtype)

"""Declared layout of a vector table.

A vector table is a DataFrame with an id, a node id, a text, an embedding, optionally a JSON
column for free-form metadata, and any number of promoted metadata columns.  ``TableConfig``
holds the names and types; nothing is inferred from data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Fixed values of the interface: patterns of names and keys, the longest name, the default dimension.
NAME_PATTERN = re.compile(r"[a-zA-Z_][a-zA-Z0-9_]*")
KEY_PATTERN = re.compile(r"[a-zA-Z_][a-zA-Z0-9_.]*")
MAX_NAME_LENGTH = 64
DEFAULT_DIM = 1536
METRICS = ("cosine", "euclidean", "inner_product")

# Spark type of each declared SQL type name.
SQL_TYPES = {
    "bigint": T.LongType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "char": T.StringType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "double": T.DoubleType(),
    "enum": T.StringType(),
    "float": T.FloatType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "json": T.StringType(),
    "longtext": T.StringType(),
    "mediumint": T.IntegerType(),
    "mediumtext": T.StringType(),
    "smallint": T.ShortType(),
    "string": T.StringType(),
    "text": T.StringType(),
    "timestamp": T.TimestampType(),
    "tinyint": T.ByteType(),
    "tinytext": T.StringType(),
    "varchar": T.StringType(),
}
DECIMAL_TYPES = ("decimal", "numeric")


def check_name(name: str, what: str = "name") -> str:
    if not isinstance(name, str) or not NAME_PATTERN.fullmatch(name):
        raise ValueError(f"{what} {name!r} must match [a-zA-Z_][a-zA-Z0-9_]*")
    if len(name) > MAX_NAME_LENGTH:
        raise ValueError(f"{what} {name!r} is longer than {MAX_NAME_LENGTH} characters")
    return name


def check_key(key: str) -> str:
    """A metadata key; a dot walks into nested JSON."""
    if not isinstance(key, str) or not KEY_PATTERN.fullmatch(key):
        raise ValueError(f"metadata key {key!r} must match [a-zA-Z_][a-zA-Z0-9_.]*")
    return key


def check_count(value: int, what: str, low: int = 1, high: int | None = None) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{what} must be an integer, got {value!r}")
    if value < low or (high is not None and value > high):
        raise ValueError(f"{what} must be between {low} and {high or 'any'}, got {value}")
    return value


def spark_type(declared: str) -> T.DataType:
    """Spark type of a declared SQL type such as ``VARCHAR(64)`` or ``DECIMAL(10,2)``."""
    match = re.fullmatch(r"\s*([a-zA-Z]+)\s*(?:\((.*)\))?\s*(?:unsigned)?\s*", declared, re.IGNORECASE)
    base = match.group(1).lower() if match else None
    if base in SQL_TYPES:
        return SQL_TYPES[base]
    if base in DECIMAL_TYPES:
        digits = [int(x) for x in (match.group(2) or "10,0").split(",")]
        return T.DecimalType(*digits)
    raise ValueError(f"unknown column type {declared!r}")


@dataclass(frozen=True)
class MetaColumn:
    """A metadata key that has its own typed column.

    ``default`` is part of the declared schema only: missing values are never filled from it.
    """

    name: str
    data_type: str = "TEXT"
    nullable: bool = True
    default: str | None = None

    def __post_init__(self):
        check_name(self.name, "metadata column")
        spark_type(self.data_type)

    @property
    def type(self) -> T.DataType:
        return spark_type(self.data_type)


@dataclass(frozen=True)
class TableConfig:
    dim: int = DEFAULT_DIM
    metric: str = "cosine"
    id_column: str = "id"
    node_id_column: str = "node_id"
    text_column: str = "text"
    embedding_column: str = "embedding"
    metadata_column: str | None = "metadata"
    promoted: tuple[MetaColumn, ...] = field(default_factory=tuple)

    def __post_init__(self):
        columns = tuple(c if isinstance(c, MetaColumn) else MetaColumn(c) for c in self.promoted)
        object.__setattr__(self, "promoted", columns)
        check_count(self.dim, "dim")
        if self.metric not in METRICS:
            raise ValueError(f"metric {self.metric!r} must be one of {METRICS}")
        names = self.core_names + [c.name for c in columns]
        for name in names:
            check_name(name, "column")
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"column names used more than once: {twice}")
        if self.metadata_column is None and not columns:
            raise ValueError("without a JSON metadata column at least one promoted column is needed")

    @property
    def core_names(self) -> list[str]:
        names = [self.id_column, self.node_id_column, self.text_column, self.embedding_column]
        return names + ([self.metadata_column] if self.metadata_column else [])

    @property
    def promoted_names(self) -> list[str]:
        return [c.name for c in self.promoted]

    def promoted_type(self, name: str) -> T.DataType | None:
        return next((c.type for c in self.promoted if c.name == name), None)

    @property
    def schema(self) -> T.StructType:
        fields = [
            T.StructField(self.id_column, T.StringType(), False),
            T.StructField(self.node_id_column, T.StringType(), False),
            T.StructField(self.text_column, T.StringType()),
        ]
        if self.metadata_column:
            fields.append(T.StructField(self.metadata_column, T.StringType()))
        fields += [T.StructField(c.name, c.type, c.nullable) for c in self.promoted]
        vector = T.ArrayType(T.FloatType(), False)
        fields.append(T.StructField(self.embedding_column, vector, False))
        return T.StructType(fields)

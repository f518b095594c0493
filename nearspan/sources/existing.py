"""Using a table as it is, whoever wrote it."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from nearspan.schema import SQL_TYPES, MetaColumn, TableConfig


def existing_table(spark: SparkSession, config: TableConfig, path: str | None = None, table: str | None = None) -> tuple[DataFrame, TableConfig]:
    """The rows of a Parquet folder or catalog table, and the config with its actual column types.

    Nothing is set up or written.  A missing column, or an embedding that is not an array of
    numbers, is an error.
    """
    if (path is None) == (table is None):
        raise ValueError("name a path or a table")
    rows = spark.read.parquet(path) if path else spark.table(table)
    wanted = [n for n in config.core_names if n != config.id_column] + config.promoted_names
    missing = sorted(set(wanted) - set(rows.columns))
    if missing:
        raise ValueError(f"the table has no columns {missing}")
    vector = rows.schema[config.embedding_column].dataType
    if not (isinstance(vector, T.ArrayType) and isinstance(vector.elementType, (T.FloatType, T.DoubleType))):
        raise ValueError(f"column {config.embedding_column!r} is {vector.simpleString()}, not an array of numbers")
    actual = tuple(
        MetaColumn(c.name, _declared(rows.schema[c.name].dataType), rows.schema[c.name].nullable, c.default)
        for c in config.promoted
    )
    return rows, replace(config, promoted=actual)


def _declared(dtype: T.DataType) -> str:
    name = dtype.simpleString()
    if isinstance(dtype, T.DecimalType) or name in SQL_TYPES:
        return name
    raise ValueError(f"a metadata column cannot be {name}")

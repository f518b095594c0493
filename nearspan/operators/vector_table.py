"""Building vector tables and reading rows back out of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.functions.metadata import (
    empty_map,
    extract_key,
    overlay,
    overlay_typed,
    parse_metadata,
    parse_metadata_typed,
    public_keys,
    read_key,
    without_keys,
)
from nearspan.functions.vectors import decode_vector, vector_fault
from nearspan.schema import TableConfig


def vector_table(source: DataFrame, config: TableConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows with ``node_id``, ``text``, ``embedding`` and ``metadata`` JSON in the table's layout.

    Promoted keys leave the JSON and become typed columns.  The id is a digest of the node id, so
    writing a row again gives the same id.  ``keep`` names columns that ride along unchanged.
    """
    given = set(source.columns)
    json = F.col("metadata") if "metadata" in given else F.lit("{}")
    vector = F.col("embedding")
    if dict(source.dtypes)["embedding"] == "string":
        vector = decode_vector(vector)
    node_id = F.col("node_id").cast("string")
    columns = [
        F.sha2(node_id, 256).alias(config.id_column),
        node_id.alias(config.node_id_column),
        (F.col("text") if "text" in given else F.lit(None)).cast("string").alias(config.text_column),
    ]
    if config.metadata_column:
        rest = without_keys(json, {c.name: c.type for c in config.promoted}) if config.promoted else F.coalesce(json, F.lit("{}"))
        columns.append(rest.alias(config.metadata_column))
    for column in config.promoted:
        value = extract_key(json, column.name, column.type)
        if column.name in given:
            value = F.coalesce(F.col(column.name).cast(column.type), value)
        columns.append(value.alias(column.name))
    columns.append(vector.cast("array<float>").alias(config.embedding_column))
    return source.select(*columns, *keep)


def write_audit(rows: DataFrame, config: TableConfig) -> dict[str, int]:
    """Counts of what would make a write fail, from one pass over the rows."""
    fault = vector_fault(F.col(config.embedding_column), config.dim)
    checks = {
        "rows": F.count("*"),
        "missing node_id": F.count_if(F.col(config.node_id_column).isNull()),
        "no embedding": F.count_if(fault == "no embedding"),
        "wrong dimension": F.count_if(fault == "wrong dimension"),
        "missing value": F.count_if(fault == "missing value"),
    }
    for column in config.promoted:
        if config.metadata_column:
            left = read_key(F.col(config.metadata_column), column.name)
            checks[f"{column.name} does not fit {column.type.simpleString()}"] = F.count_if(left.isNotNull())
        if not column.nullable:
            checks[f"missing {column.name}"] = F.count_if(F.col(column.name).isNull())
    return rows.agg(*[value.alias(name) for name, value in checks.items()]).first().asDict()


def assert_writable(rows: DataFrame, config: TableConfig) -> int:
    """Row count; raises before anything is written when a row breaks the layout."""
    counts = write_audit(rows, config)
    total = counts.pop("rows")
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise ValueError(f"rows cannot be written, a default never fills a missing value: {broken}")
    return total


def not_null_report(rows: DataFrame, config: TableConfig) -> DataFrame:
    """Per NOT NULL promoted column the number of rows without a value, in one pass."""
    names = [c.name for c in config.promoted if not c.nullable]
    counts = rows.agg(F.count("*").alias("n_rows"), *[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("n_missing")) for n in names]))
    return counts.select("n_rows", pairs.alias("c")).select("c.column_name", "c.n_missing", "n_rows")


def stable_columns(config: TableConfig) -> list[Column]:
    """``node_id, text, metadata`` and the promoted columns, whatever the table calls them."""
    columns = [F.col(config.node_id_column).alias("node_id"), F.col(config.text_column).alias("text")]
    if config.metadata_column:
        columns.append(F.col(config.metadata_column).alias("metadata"))
    return columns + [F.col(name) for name in config.promoted_names]


def merged_metadata(config: TableConfig) -> Column:
    """The JSON metadata with the promoted values that are present put over it."""
    base = parse_metadata(F.col(config.metadata_column)) if config.metadata_column else empty_map()
    return overlay(base, {name: F.col(name) for name in config.promoted_names})


def merged_metadata_typed(table: DataFrame, config: TableConfig) -> Column:
    """The metadata as a map of variants, in which numbers, booleans and nested values keep their type, with the
    promoted values that are present, in the types of their columns, put over it."""
    base = F.col(config.metadata_column) if config.metadata_column else F.lit("{}")
    values = {name: (F.col(name), table.schema[name].dataType) for name in config.promoted_names}
    return overlay_typed(parse_metadata_typed(base), values)


def rebuilt_rows(table: DataFrame, config: TableConfig, typed: bool = False) -> DataFrame:
    """Rows as they went in: node id, text that is never NULL, one metadata map, of texts or of typed variants."""
    metadata = merged_metadata_typed(table, config) if typed else merged_metadata(config)
    own_id = F.try_element_at(metadata, F.lit("node_id"))
    own_id = F.try_variant_get(own_id, "$", "string") if typed else own_id
    node_id = F.coalesce(F.col(config.node_id_column), own_id, F.lit(""))
    return table.select(
        node_id.alias("node_id"),
        F.coalesce(F.col(config.text_column), F.lit("")).alias("text"),
        public_keys(metadata).alias("metadata"),
    )

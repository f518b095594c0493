"""Reading rows by id, by filter, or all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.functions.filters import FilterGroup, MetaFilter, predicate
from nearspan.operators.sizing import broadcast_if_small
from nearspan.schema import TableConfig, check_count
from nearspan.session import small_frame

LITERAL_IDS = 1_000
# Spark sends a list of up to ten values to the files as equalities, a longer one only as a range.
PUSHED_IDS = 10


def by_ids(table: DataFrame, ids: DataFrame | Sequence[str], key: str = "node_id") -> DataFrame:
    """Rows whose key is among the ids; unknown ids are ignored."""
    if not isinstance(ids, DataFrame):
        wanted = sorted({str(i) for i in ids})
        if len(wanted) <= LITERAL_IDS:
            return table.where(F.col(key).isin(wanted))
        ids = small_frame(table.sparkSession, [(i,) for i in wanted], f"{key} string")
    return table.join(broadcast_if_small(ids.select(key).distinct()), key, "left_semi")


def write_clustered(rows: DataFrame, path: str, key: str = "node_id", row_group_bytes: int = 32 << 20) -> None:
    """Rows in the order of their key, with a Bloom filter of the keys in every row group.

    Rows of one key may span tasks: they are told apart by a digest of their other columns.
    """
    plain = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    ordered = rows.repartitionByRange(key, F.xxhash64(*[F.col(f"`{name}`") for name in plain]))
    ordered.sortWithinPartitions(key).write.options(
        **{
            f"parquet.bloom.filter.enabled#{key}": "true",
            "parquet.bloom.filter.adaptive.enabled": "true",
            "parquet.block.size": str(row_group_bytes),
        }
    ).parquet(path)


def point_rows(table: DataFrame, ids: DataFrame | Sequence[str], key: str = "node_id") -> DataFrame:
    """``by_ids`` for a clustered table: few ids, counted, reach the files as equalities, so that only row groups
    whose range and Bloom filter admit one are read; more ids are joined."""
    if isinstance(ids, DataFrame):
        few = ids.select(key).where(F.col(key).isNotNull()).distinct().limit(LITERAL_IDS + 1).collect()
        wanted = sorted(row[0] for row in few)
    else:
        wanted = sorted({str(i) for i in ids})
    if len(wanted) > LITERAL_IDS:
        return by_ids(table, ids, key)
    parts = [F.col(key).isin(wanted[at : at + PUSHED_IDS]) for at in range(0, len(wanted), PUSHED_IDS)]
    return table.where(_any(parts) if parts else F.lit(False))


def _any(parts: Sequence[Column]) -> Column:
    """One of the conditions, as a tree of little depth."""
    if len(parts) == 1:
        return parts[0]
    half = len(parts) // 2
    return _any(parts[:half]) | _any(parts[half:])


def by_values(table: DataFrame, key: Column, values: DataFrame, negate: bool = False) -> DataFrame:
    """IN and NOT IN against a frame of values of any size; a NULL key matches neither."""
    name = values.columns[0]
    side = broadcast_if_small(values.select(F.col(name).alias("_value")).where("_value IS NOT NULL").distinct())
    rows = table.withColumn("_key", key).where("_key IS NOT NULL")
    kind = "left_anti" if negate else "left_semi"
    return rows.join(side, F.col("_key") == F.col("_value"), kind).drop("_key")


def first_rows(rows: DataFrame, limit: int, key: str = "node_id") -> DataFrame:
    """The first rows by key.  For a large limit the last key among them is found on the keys alone, and
    only rows up to it are sorted."""
    if limit > LITERAL_IDS:
        keys = rows.select(F.col(key).alias("_key")).orderBy("_key").limit(limit)
        last, nulls = keys.agg(F.max("_key"), F.count_if(F.col("_key").isNull())).first()
        upto = F.col(key).isNull() if last is None else F.col(key).isNull() | (F.col(key) <= F.lit(last))
        rows = rows.where(upto if nulls or last is None else F.col(key) <= F.lit(last))
    return rows.orderBy(key).limit(limit)


def matching(table: DataFrame, filters: MetaFilter | FilterGroup | None, config: TableConfig) -> DataFrame:
    wanted = predicate(filters, config)
    return table if wanted is None else table.where(wanted)


def browse(
    table: DataFrame,
    config: TableConfig,
    ids: DataFrame | Sequence[str] | None = None,
    filters: MetaFilter | FilterGroup | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows by ids, else by filters, else all; a ``limit`` keeps the first ones by node id, but not of ids."""
    if isinstance(ids, DataFrame) or ids:
        return by_ids(table, ids, config.node_id_column)
    found = matching(table, filters, config)
    return found if limit is None else first_rows(found, check_count(limit, "limit"), config.node_id_column)


def search_by_metadata(
    table: DataFrame, filters: MetaFilter | FilterGroup, config: TableConfig, limit: int = 10
) -> DataFrame:
    check_count(limit, "limit")
    wanted = predicate(filters, config)
    if wanted is None:
        raise ValueError("at least one filter is needed")
    return first_rows(table.where(wanted), limit, config.node_id_column)


def fetch_embeddings(
    table: DataFrame, ids: DataFrame | Sequence[str], key: str = "node_id", embedding: str = "embedding"
) -> DataFrame:
    """Node id and embedding of the wanted ids; rows without a readable vector are left out."""
    return by_ids(table.select(key, embedding), ids, key).where(F.col(embedding).isNotNull())


def count_rows(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("n_rows"))

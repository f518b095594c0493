"""Tables bucketed by key, for joins and aggregates that shuffle nothing.

Rows are written with Spark's own buckets, one file each.  A bucket is read by one task, so keys that alone would
fill a bucket or more are kept in a second, plain table, whose joins and aggregates shuffle and are split by
adaptive execution.  No key is in both tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.operators.sizing import broadcast_if_small
from nearspan.schema import check_count, check_name

HOT = "__hot"


@dataclass(frozen=True)
class BucketedTable:
    """A catalog table of buckets and, where there are hot keys, one of their rows."""

    table: str
    keys: tuple[str, ...]
    n_buckets: int
    hot_table: str | None = None

    def cold(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def hot(self, spark: SparkSession) -> DataFrame | None:
        return spark.table(self.hot_table) if self.hot_table else None

    def rows(self, spark: SparkSession) -> DataFrame:
        hot = self.hot(spark)
        return self.cold(spark) if hot is None else self.cold(spark).unionByName(hot)


def write_bucketed(
    rows: DataFrame, table: str, keys: Sequence[str], n_buckets: int, path: str, hot_share: float = 1.0
) -> BucketedTable:
    """Rows as a new catalog table of ``n_buckets`` sorted buckets under ``path``.

    Keys with more than ``hot_share`` of an average bucket's rows, nulls too, go to the table ``<table>_hot``; there
    are fewer than ``n_buckets / hot_share`` of them.  The column ``__hot`` is reserved.
    """
    check_name(table, "table name")
    check_count(n_buckets, "n_buckets")
    if hot_share <= 0:
        raise ValueError("hot_share must be above 0")
    if not keys or HOT in rows.columns:
        raise ValueError(f"keys are needed, and no column may be called {HOT}")
    counts = rows.groupBy(*keys).agg(F.count("*").alias(HOT))
    total = rows.count()
    hot = counts.where(F.col(HOT) * n_buckets > total * hot_share)
    has_hot = total > 0 and not hot.isEmpty()
    cold = rows
    if has_hot:
        side = broadcast_if_small(hot.select(*[F.col(k).alias(f"{HOT}_{k}") for k in keys]))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{HOT}_{k}")) for k in keys])
        cold = rows.join(side, same, "left_anti")
        apart = rows.join(side, same, "left_semi")
        apart.write.option("path", f"{path}/hot").format("parquet").saveAsTable(f"{table}_hot")
    cold.repartition(n_buckets, *keys).write.bucketBy(n_buckets, *keys).sortBy(*keys).option(
        "path", f"{path}/buckets"
    ).format("parquet").saveAsTable(table)
    return BucketedTable(table, tuple(keys), n_buckets, f"{table}_hot" if has_hot else None)


def join_bucketed(spark: SparkSession, left: BucketedTable, right: BucketedTable) -> DataFrame:
    """Inner join on the keys, which must have the same names and number of buckets on both sides.

    Buckets meet without an exchange; only rows of hot keys, and the other side's rows for these, are shuffled.
    Null keys meet nothing.  Other columns must differ in name.
    """
    if (left.keys, left.n_buckets) != (right.keys, right.n_buckets):
        raise ValueError("both tables need the same keys and number of buckets")
    clash = set(spark.table(left.table).columns) & set(spark.table(right.table).columns) - set(left.keys)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keys = list(left.keys)
    parts = [left.cold(spark).join(right.cold(spark).hint("merge"), keys)]
    if left.hot_table:
        parts.append(left.hot(spark).join(_only(right.rows(spark), left.hot(spark), keys), keys))
    if right.hot_table:
        parts.append(_only(left.cold(spark), right.hot(spark), keys).join(right.hot(spark), keys))
    return reduce(DataFrame.unionByName, parts)


def _only(rows: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the few hot keys, picked where they are read."""
    return rows.join(broadcast_if_small(hot.select(*keys).distinct()), list(keys), "left_semi")


def aggregate_bucketed(spark: SparkSession, table: BucketedTable, *aggregates: Column) -> DataFrame:
    """One row per key; buckets are aggregated without an exchange, hot keys by partial aggregates and a shuffle."""
    cold = table.cold(spark).groupBy(*table.keys).agg(*aggregates)
    hot = table.hot(spark)
    return cold if hot is None else cold.unionByName(hot.groupBy(*table.keys).agg(*aggregates))

"""Hash, key, range and list partitioning of any table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.operators.sizing import broadcast_if_small
from nearspan.schema import check_count, check_name, spark_type
from nearspan.sources.files import make_folder

KINDS = ("HASH", "KEY", "RANGE", "LIST")
MAXVALUE = "MAXVALUE"
BROADCAST_MARK, REQUIRED_MARK = "nearspan.broadcast", "nearspan.required"


@dataclass(frozen=True)
class PartitionSpec:
    """How a key column maps to partitions.

    HASH and KEY take a number of partitions.  RANGE takes ordered definitions
    ``{"name", "values_less_than"}``, the bound excluded; LIST takes ``{"name", "values_in"}``.
    """

    kind: str
    column: str
    partitions: int = 0
    defs: tuple[dict[str, Any], ...] = field(default_factory=tuple)

    def __post_init__(self):
        object.__setattr__(self, "kind", str(self.kind).upper())
        object.__setattr__(self, "defs", tuple(self.defs or ()))
        if self.kind not in KINDS:
            raise ValueError(f"partitioning {self.kind!r} must be one of {KINDS}")
        check_name(self.column, "partition column")
        if self.kind in ("HASH", "KEY"):
            check_count(self.partitions, "partitions")
            return
        if not self.defs:
            raise ValueError(f"{self.kind} partitioning needs definitions")
        for item in self.defs:
            if not item.get("name"):
                raise ValueError(f"a {self.kind} definition has no 'name': {item}")
            check_name(item["name"], "partition name")
            wanted = "values_less_than" if self.kind == "RANGE" else "values_in"
            if item.get(wanted) is None:
                raise ValueError(f"{self.kind} partition {item['name']!r} has no {wanted!r}")
            if self.kind == "LIST" and not list(item["values_in"]):
                raise ValueError(f"LIST partition {item['name']!r} has an empty 'values_in'")
        if len({item["name"] for item in self.defs}) < len(self.defs):
            raise ValueError("partition names must be unique")
        if self.kind == "RANGE":
            bounds = self.bounds()
            if None in bounds[:-1] or any(a >= b for a, b in zip(bounds, bounds[1:]) if b is not None):
                raise ValueError("range bounds must ascend, MAXVALUE only last")

    def bounds(self) -> list[Any]:
        """Upper bounds in order; None stands for no bound."""
        values = [item["values_less_than"] for item in self.defs]
        return [None if isinstance(v, str) and v.upper() == MAXVALUE else v for v in values]

    def of(self, key: Column, dtype: T.DataType | None = None) -> Column:
        """Partition of a key; NULL when no partition takes it.

        HASH takes the remainder of integers and a digest of any other type.
        """
        if self.kind == "HASH" and dtype is not None and not isinstance(dtype, T.IntegralType):
            return F.pmod(F.coalesce(F.xxhash64(key), F.lit(0)), F.lit(self.partitions)).cast("int")
        if self.kind == "HASH":
            return F.pmod(F.coalesce(key.cast("long"), F.lit(0)), F.lit(self.partitions)).cast("int")
        if self.kind == "KEY":
            return F.pmod(F.xxhash64(key), F.lit(self.partitions)).cast("int")
        if self.kind == "RANGE":
            chosen = F.when(key.isNull(), F.lit(self.defs[0]["name"]))
            for item, bound in zip(self.defs, self.bounds()):
                fits = F.lit(True) if bound is None else key < F.lit(bound)
                chosen = chosen.when(fits, F.lit(item["name"]))
            return chosen
        chosen = F.when(F.lit(False), F.lit(None).cast("string"))
        for item in self.defs:
            values = [v for v in item["values_in"] if v is not None]
            fits = key.isin(values) if values else F.lit(False)
            if len(values) < len(list(item["values_in"])):
                fits = key.isNull() | F.coalesce(fits, F.lit(False))
            chosen = chosen.when(fits, F.lit(item["name"]))
        return chosen

    def overlapping(self, low: Any = None, high: Any = None) -> list[str]:
        """Names of the range partitions that may hold keys from ``low`` to ``high``, ends included."""
        names, floor = [], None
        for item, bound in zip(self.defs, self.bounds()):
            above = low is None or bound is None or low < bound
            below = high is None or floor is None or high >= floor
            if above and below:
                names.append(item["name"])
            floor = bound
        return names


def with_partition(rows: DataFrame, spec: PartitionSpec, name: str = "p") -> DataFrame:
    return rows.withColumn(name, spec.of(F.col(spec.column), rows.schema[spec.column].dataType))


def assert_partitioned(rows: DataFrame, spec: PartitionSpec) -> None:
    """Raises with a count when a key has no partition; reads the key column only."""
    if spec.kind in ("RANGE", "LIST"):
        lost = rows.select(spec.of(F.col(spec.column)).alias("p")).where("p IS NULL").count()
        if lost:
            raise ValueError(f"{lost} rows have a {spec.column!r} that no {spec.kind} partition takes")


def write_partitioned(
    rows: DataFrame, path: str, spec: PartitionSpec, mode: str = "errorifexists", name: str = "p"
) -> None:
    """Write a table in directories by partition.

    Rows are brought together by partition before the write; a partition that holds a large share
    of the rows is split over several tasks and files instead of passing through one.
    """
    assert_partitioned(rows, spec)
    gathered = with_partition(rows, spec, name).hint("rebalance", name)
    gathered.write.mode(mode).partitionBy(name).parquet(path)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def where_key(rows: DataFrame, spec: PartitionSpec, value: Any, name: str = "p") -> DataFrame:
    """Rows with one key value (or any of a list), reading only the partitions that can hold it."""
    values = list(value) if isinstance(value, (list, tuple, set)) else [value]
    dtype = rows.schema[spec.column].dataType
    homes = [spec.of(F.lit(v).cast(dtype), dtype) for v in values]
    return rows.where(F.col(name).isin(homes) & F.col(spec.column).isin(values))


def where_between(rows: DataFrame, spec: PartitionSpec, low: Any, high: Any, name: str = "p") -> DataFrame:
    """Rows with a key from ``low`` to ``high`` of a range partitioned table."""
    return rows.where(F.col(name).isin(spec.overlapping(low, high)) & F.col(spec.column).between(low, high))


def partition_report(rows: DataFrame, spec: PartitionSpec, name: str = "p") -> DataFrame:
    """Rows and key range of each partition; unmatched rows show as partition NULL."""
    key = F.col(spec.column)
    placed = rows.select(spec.of(key, rows.schema[spec.column].dataType).alias(name), key.alias("k"))
    return placed.groupBy(name).agg(
        F.count("*").alias("n_rows"), F.min("k").alias("min_key"), F.max("k").alias("max_key")
    )


def create_partitioned_table(
    spark: SparkSession,
    table: str,
    columns: Sequence[tuple[str, str]],
    spec: PartitionSpec | None = None,
    broadcast: bool = False,
    if_not_exists: bool = True,
    path: str | None = None,
    name: str = "p",
) -> None:
    """An empty catalog table with declared ``(column, SQL type)`` pairs."""
    check_name(table, "table name")
    if broadcast and spec:
        raise ValueError("a broadcast table has no partitions")
    fields = [_declared(check_name(c, "column"), t) for c, t in columns]
    if spec:
        if spec.column not in [f.name for f in fields]:
            raise ValueError(f"the table has no column {spec.column!r} to partition on")
        fields.append(T.StructField(name, T.IntegerType() if spec.kind in ("HASH", "KEY") else T.StringType()))
    listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in fields)
    parted = f" PARTITIONED BY ({name})" if spec else ""
    quoted = (path or "").replace("\\", "\\\\").replace("'", "\\'")
    where = f" LOCATION '{quoted}'" if path else ""
    exists = "IF NOT EXISTS " if if_not_exists else ""
    if path:
        make_folder(spark, path)
    required = ",".join(f.name for f in fields if not f.nullable)
    marked = f" TBLPROPERTIES ('{BROADCAST_MARK}' = '{str(broadcast).lower()}', '{REQUIRED_MARK}' = '{required}')"
    spark.sql(f"CREATE TABLE {exists}`{table}` ({listed}) USING parquet{parted}{where}{marked}")


def _declared(name: str, declared: str) -> T.StructField:
    """A column of a declaration such as ``BIGINT NOT NULL``."""
    words = declared.split()
    required = [w.upper() for w in words[-2:]] == ["NOT", "NULL"]
    return T.StructField(name, spark_type(" ".join(words[:-2] if required else words)), not required)


def table_marks(spark: SparkSession, table: str) -> dict[str, str]:
    """The table's properties; files don't keep what NOT NULL and broadcast declare."""
    return dict(spark.sql(f"SHOW TBLPROPERTIES `{check_name(table, 'table name')}`").collect())


def is_broadcast_table(spark: SparkSession, table: str) -> bool:
    """Whether the table was declared with ``broadcast=True``."""
    return table_marks(spark, table).get(BROADCAST_MARK) == "true"


def insert_rows(rows: DataFrame, table: str, spec: PartitionSpec | None = None, name: str = "p") -> None:
    """Append rows to a catalog table; columns the rows lack become NULL."""
    spark = rows.sparkSession
    target = spark.table(table).schema
    if spec:
        assert_partitioned(rows, spec)
        rows = with_partition(rows, spec, name).hint("rebalance", name)
    unknown = set(rows.columns) - set(target.names)
    if unknown:
        raise ValueError(f"table {table!r} has no columns {sorted(unknown)}")
    given = set(rows.columns)
    required = [c for c in table_marks(spark, table).get(REQUIRED_MARK, "").split(",") if c]
    empty = rows.agg(*[F.count_if(F.col(c).isNull() if c in given else F.lit(True)).alias(c) for c in required]).first() if required else ()
    lost = {c: n for c, n in zip(required, empty) if n}
    if lost:
        raise ValueError(f"table {table!r} needs values in {lost}")
    rows.select(
        *[(F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields]
    ).write.insertInto(table)


def join_dimension(facts: DataFrame, dimension: DataFrame | str, on, how: str = "inner") -> DataFrame:
    """Join with a small table that every executor gets a full copy of, if it is measured small.

    A table given by name is copied only if it was declared with ``broadcast=True``.
    """
    if isinstance(dimension, str):
        spark, name = facts.sparkSession, dimension
        dimension = spark.table(name)
        if not is_broadcast_table(spark, name):
            return facts.join(dimension, on, how)
    return facts.join(broadcast_if_small(dimension), on, how)

"""Tables on plain Parquet that change by whole buckets.

Every change is a new generation.  It writes the buckets it touches to a fresh folder and then one
small commit that says, for every bucket, which folder holds its rows.  A reader takes the newest
commit.  Files that a running job reads are never overwritten, a failed job leaves the table as it
was, and a change costs as much as the buckets it touches.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.schema import check_count
from nearspan.sources.files import children, exists, remove
from nearspan.session import small_frame

COMMIT_SCHEMA = "bucket int, folder string, n_rows long"


@dataclass(frozen=True)
class Bucket:
    folder: str
    n_rows: int


class SnapshotTable:
    """A table in ``root``, bucketed by a digest of its key."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, buckets: int = 1):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = key
        self.buckets = check_count(buckets, "buckets")
        self._known: tuple[int, dict[int, Bucket]] = (0, {})

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def generation(self) -> int:
        """Newest committed generation, 0 for a table that was never written."""
        names = children(self.spark, f"{self.root}/commits")
        for number in sorted((int(n.split("=")[1]) for n in names), reverse=True):
            # A commit is one file, which appears whole or not at all.
            if children(self.spark, f"{self.root}/commits/gen={number}"):
                return number
        return 0

    def state(self) -> dict[int, Bucket]:
        """Per bucket where its rows are; one entry per bucket reaches the driver."""
        current = self.generation()
        if current != self._known[0]:
            commit = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/commits/gen={current}")
            self._known = current, {r["bucket"]: Bucket(r["folder"], r["n_rows"]) for r in commit.collect()}
        known = self._known[1]
        if known and len(known) != self.buckets:
            raise ValueError(f"the table at {self.root} has {len(known)} buckets, not {self.buckets}")
        return dict(known)

    def count(self) -> int:
        """Rows of the table, from the newest commit alone."""
        return sum(b.n_rows for b in self.state().values())

    def read(self, buckets: set[int] | None = None) -> DataFrame:
        """The current rows, or those of some buckets, with their ``bucket``."""
        paths = [
            f"{self.root}/data/gen={b.folder}/bucket={n}"
            for n, b in sorted(self.state().items())
            if b.n_rows and (buckets is None or n in buckets)
        ]
        names = [*self.schema.names, "bucket"]
        stored = T.StructType([*self.schema.fields, T.StructField("gen", T.StringType()), _BUCKET])
        if not paths:
            return small_frame(self.spark, [], T.StructType([*self.schema.fields, _BUCKET]))
        reader = self.spark.read.schema(stored).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(names)

    def replace(self, rows: DataFrame | None, touched: set[int] | None = None, kept: DataFrame | None = None) -> int:
        """Commit new content of the touched buckets (all by default); the number of its rows.

        ``rows`` are brought together by bucket.  ``kept`` are rows as :meth:`read` gave them, with
        their bucket: they lie in bucket order already and are written where they are read.
        """
        state = self.state()
        touched = set(range(self.buckets)) if touched is None else touched
        if not touched:
            return 0
        number = self.generation() + 1
        folder = f"{number}-{uuid.uuid4().hex}"
        path = f"{self.root}/data/gen={folder}"
        names = [*self.schema.names, "bucket"]
        if kept is not None:
            kept.select(names).write.mode("append").partitionBy("bucket").parquet(path)
        if rows is not None:
            placed = rows.select(*self.schema.names, self.bucket_of(F.col(self.key)).alias("bucket"))
            placed.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(path)
        counts = self._written(path)
        for bucket in range(self.buckets):
            if bucket in touched or bucket not in state:
                state[bucket] = Bucket(folder, counts.get(bucket, 0))
        entries = [(n, b.folder, b.n_rows) for n, b in sorted(state.items())]
        commit = small_frame(self.spark, entries, COMMIT_SCHEMA).coalesce(1)
        # One writer at a time: two that commit the same generation at the same moment are not told apart.
        commit.write.json(f"{self.root}/commits/gen={number}")
        self._known = number, state
        return sum(counts.values())

    def clear(self) -> None:
        """No rows, the table stays."""
        self.replace(small_frame(self.spark, [], self.schema))

    def drop(self) -> None:
        if exists(self.spark, self.root):
            remove(self.spark, self.root)
        self._known = 0, {}

    def touched_by(self, keys: DataFrame) -> set[int]:
        """Buckets that hold the keys of a frame; at most one row per bucket reaches the driver."""
        found = keys.select(self.bucket_of(F.col(self.key)).alias("bucket")).distinct().collect()
        return {r["bucket"] for r in found}

    def _written(self, path: str) -> dict[int, int]:
        if not children(self.spark, path):
            return {}
        rows = self.spark.read.schema(T.StructType([*self.schema.fields, _BUCKET])).parquet(path)
        return {r["bucket"]: r["n"] for r in rows.groupBy("bucket").agg(F.count("*").alias("n")).collect()}


_BUCKET = T.StructField("bucket", T.IntegerType())

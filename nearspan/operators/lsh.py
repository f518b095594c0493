"""Approximate neighbour join by random projections, without a stored index.

Vectors that fall into the same bucket of at least one hash table are compared, and only the best
``k`` of them leave a task; pairs are never listed.  A bucket with more rows or queries than a task
should hold is cut into slices of rows and blocks of queries, which all meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.operators.ivf import unit
from nearspan.operators.knn import (
    MIN_SLICE_ROWS,
    PART_QUERIES,
    SLICE_BYTES,
    check_queries,
    every,
    finish,
    keep_nearest,
    meet_in_parts,
    turn_of,
)
from nearspan.operators.sizing import broadcast_if_small
from nearspan.schema import METRICS, check_count

PARTS = 4_096
PARTS_PER_CORE = 4


def nearest_by_projection(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    tables: int = 4,
    bucket_length: float = 0.5,
    seed: int = 7,
    node_id: str = "node_id",
    embedding: str = "embedding",
    qid: str = "qid",
    query_embedding: str = "embedding",
    slice_rows: int | None = None,
    part_queries: int = PART_QUERIES,
    parts: int = PARTS,
) -> DataFrame:
    """The ``k`` nearest rows of each query among those that share a bucket with it."""
    check_count(k, "k")
    check_count(tables, "tables")
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} must be one of {METRICS}")
    asked = queries.select(F.col(qid).alias("query_id"), F.col(query_embedding).alias("vector"))
    rows = corpus.select(F.col(node_id).alias("node_id"), F.col(embedding).alias("vector")).where("vector IS NOT NULL")
    dim = check_queries(asked)
    size = slice_rows or max(1, SLICE_BYTES // (4 * max(dim, 1)))
    hasher = BucketedRandomProjectionLSH(
        inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed
    )
    sample = asked.select(array_to_vector("vector").alias("features")).limit(1)
    if not sample.count():
        raise ValueError("there are no queries")
    model = hasher.fit(sample)

    def hashed(frame: DataFrame, keep: Sequence[str]) -> DataFrame:
        features = frame.withColumn("features", array_to_vector(unit("vector", metric)))
        spots = model.transform(features).select(*keep, F.posexplode("hashes").alias("t", "h"))
        return spots.select(*keep, F.struct("t", vector_to_array("h")[0].cast("long").alias("h")).alias("bucket"))

    # Queries of a large bucket are cut so that a core has several parts, and tasks are no fewer.
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    part_queries = min(part_queries, max(MIN_SLICE_ROWS, -(-tables * asked.count() // (PARTS_PER_CORE * cores))))
    # Only buckets that are too large for one task are listed; the others are one part each.
    placed, wanted = hashed(rows, ["node_id", "vector"]), hashed(asked, ["query_id", "vector"])
    slices = _large(placed, size, "slices")
    blocks = _large(wanted, part_queries, "blocks")
    counts = [F.coalesce(F.col(c), F.lit(1).cast("long")) for c in ("slices", "blocks")]

    def cut_up(frame: DataFrame, key: str, own: Column, other: Column, names: tuple[str, str]) -> DataFrame:
        sized = frame.join(slices, "bucket", "left").join(blocks, "bucket", "left")
        own_name, other_name = names
        rows = sized.select(key, "vector", "bucket", turn_of(key, own).alias(own_name), every(other).alias(other_name))
        return rows.select(key, "vector", F.xxhash64("bucket", "slice", "block").alias("part"))

    cut = cut_up(placed, "node_id", *counts, ("slice", "block"))
    spread = cut_up(wanted, "query_id", *reversed(counts), ("block", "slice"))
    dim = asked.select(F.max(F.size("vector"))).first()[0]
    found = meet_in_parts(cut, spread, max(parts, PARTS_PER_CORE * cores), k, metric, False, dim)
    # A row may share several buckets with a query.
    once = found.groupBy("query_id", "node_id").agg(F.min("distance").alias("distance"))
    return finish(keep_nearest(once, k), metric, qid, node_id)


def _large(placed: DataFrame, limit: int, name: str) -> DataFrame:
    """Buckets with more rows than ``limit``, and into how many pieces to cut them."""
    counts = placed.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    return broadcast_if_small(counts.select("bucket", F.ceil(F.col("n") / limit).alias(name)))

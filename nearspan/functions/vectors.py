"""Checks and conversions of embedding columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.functions.distance import norm


def decode_vector(text: Column) -> Column:
    """JSON array text to an embedding; text that is not an array of numbers gives NULL."""
    return F.from_json(text, "array<float>")


def encode_vector(vector: Column) -> Column:
    return F.to_json(vector)


def vector_norm(vector: Column) -> Column:
    return norm(vector)


def vector_fault(vector: Column, dim: int) -> Column:
    """Why an embedding cannot be stored, or NULL when it can."""
    return (
        F.when(vector.isNull(), F.lit("no embedding"))
        .when(F.size(vector) != dim, F.lit("wrong dimension"))
        .when(F.exists(vector, lambda x: x.isNull()), F.lit("missing value"))
    )


def dimension_audit(rows: DataFrame, dim: int, node_id: str = "node_id", embedding: str = "embedding") -> DataFrame:
    """Faulty rows by reason and length, with the first offending node id of each."""
    faults = rows.select(
        F.col(node_id).alias("node_id"),
        vector_fault(F.col(embedding), dim).alias("reason"),
        F.when(F.col(embedding).isNotNull(), F.size(embedding)).alias("dimension"),
    ).where("reason IS NOT NULL")
    return faults.groupBy("reason", "dimension").agg(
        F.count("*").alias("n_rows"), F.min("node_id").alias("first_node_id")
    )

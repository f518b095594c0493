"""Distances between embeddings as JVM-side column expressions.

All arithmetic is done in double.  A distance that is not defined (a missing vector, a zero
vector under cosine, a NaN) is NULL, ranks last and has similarity 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from nearspan.schema import METRICS


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def _doubles(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def _no_nan(value: Column) -> Column:
    return F.nullif(value, F.lit(float("nan")))


def dot(left: Column, right: Column) -> Column:
    return _sum(F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double")))


def norm(vector: Column) -> Column:
    return F.sqrt(_sum(F.transform(vector, lambda x: x.cast("double") * x.cast("double"))))


def cosine_distance(left: Column, right: Column) -> Column:
    return _no_nan(1 - F.try_divide(dot(left, right), norm(left) * norm(right)))


def euclidean_distance(left: Column, right: Column) -> Column:
    def gap(x, y):
        return (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))

    return _no_nan(F.sqrt(_sum(F.zip_with(left, right, gap))))


def inner_product_distance(left: Column, right: Column) -> Column:
    return _no_nan(-dot(left, right))


def distance(left: Column, right: Column, metric: str) -> Column:
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} must be one of {METRICS}")
    return {
        "cosine": cosine_distance,
        "euclidean": euclidean_distance,
        "inner_product": inner_product_distance,
    }[metric](left, right)


def similarity(distance: Column, metric: str) -> Column:
    """Score of a distance: higher is closer."""
    if metric == "euclidean":
        score = 1 / (1 + F.greatest(F.lit(0.0), distance))
        score = F.when(distance.isNotNull(), score)
    elif metric == "inner_product":
        score = -distance
    else:
        score = 1 - distance
    return F.coalesce(score, F.lit(0.0))


# SQL names of the vector functions and their bodies; plain SQL, inlined by the optimizer.
SQL_FUNCTIONS = {
    "vec_fromtext": ("t STRING", "ARRAY<FLOAT>", "from_json(t, 'array<float>')"),
    "vec_totext": ("v ARRAY<FLOAT>", "STRING", "to_json(v)"),
    "vector_dim": ("v ARRAY<FLOAT>", "INT", "if(v IS NULL, NULL, size(v))"),
    "vec_distance_inner_product": (
        "a ARRAY<FLOAT>, b ARRAY<FLOAT>",
        "DOUBLE",
        "-aggregate(zip_with(a, b, (x, y) -> double(x) * double(y)), 0D, (s, x) -> s + x)",
    ),
    "vec_distance_euclidean": (
        "a ARRAY<FLOAT>, b ARRAY<FLOAT>",
        "DOUBLE",
        "sqrt(aggregate(zip_with(a, b, (x, y) -> (double(x) - double(y)) * (double(x) - double(y))), 0D,"
        " (s, x) -> s + x))",
    ),
    "vec_distance_cosine": (
        "a ARRAY<FLOAT>, b ARRAY<FLOAT>",
        "DOUBLE",
        "1 - try_divide(aggregate(zip_with(a, b, (x, y) -> double(x) * double(y)), 0D, (s, x) -> s + x),"
        " sqrt(aggregate(transform(a, x -> double(x) * double(x)), 0D, (s, x) -> s + x))"
        " * sqrt(aggregate(transform(b, x -> double(x) * double(x)), 0D, (s, x) -> s + x)))",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Make the vector functions callable from SQL text."""
    if spark.catalog.functionExists("vec_distance"):
        return
    for name, (arguments, result, body) in SQL_FUNCTIONS.items():
        if result == "DOUBLE":
            body = f"nullif({body}, double('NaN'))"
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION vec_distance(a ARRAY<FLOAT>, b ARRAY<FLOAT>) "
        "RETURNS DOUBLE RETURN vec_distance_cosine(a, b)"
    )

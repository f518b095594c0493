"""The test tables in the shapes that the registered queries start from."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan import MetaColumn, TableConfig

DIM = 64
PLAIN = TableConfig(dim=DIM)
PROMOTED = TableConfig(dim=DIM, promoted=(MetaColumn("lang", "VARCHAR(8)"), MetaColumn("n_chars", "INT")))
EVENTS = TableConfig(
    dim=DIM,
    metadata_column="props",
    promoted=(MetaColumn("event_type", "VARCHAR(16)"), MetaColumn("value", "DOUBLE")),
)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as ``(node_id, embedding, label)``."""
    rows = load(spark, sf_dir, "embeddings")
    return rows.select(F.col("vec_id").cast("string").alias("node_id"), "embedding", "label")


def every_vector_asks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding as a query ``(qid, embedding)``."""
    return load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), "embedding")


def label_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vector of each label as ``(label, centre)``."""
    rows = load(spark, sf_dir, "embeddings")
    points = rows.select("label", array_to_vector("embedding").alias("v"))
    means = points.groupBy("label").agg(Summarizer.mean(F.col("v")).alias("m"))
    return means.select("label", vector_to_array("m", "float32").alias("centre"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with JSON metadata; quality and toxic are there only where a label is."""
    rows = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    metadata = F.struct(
        "lang",
        "source",
        "n_chars",
        F.col("source").alias("ref_doc_id"),
        "quality",
        (F.col("toxic") == 1).alias("toxic"),
        F.struct(F.col("lang").alias("code")).alias("language"),
        F.col("doc_id").alias("_row"),
    )
    return rows.select(
        "doc_id", F.col("doc_id").cast("string").alias("node_id"), "text", F.to_json(metadata).alias("metadata")
    )


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have an embedding, as input of a vector table."""
    rows = load(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    return documents(spark, sf_dir).join(rows, "doc_id").drop("doc_id")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events")
    return rows.withColumn("node_id", F.col("event_id").cast("string"))


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of documents: turns of a conversation replace the text, pages are new rows."""
    turns = load(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("node_id"), "text", F.col("turn").alias("seq")
    )
    pages = load(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id")).alias("node_id"),
        F.col("html").alias("text"),
        F.lit(0).cast("long").alias("seq"),
    )
    return turns.unionByName(pages)


# The same shapes in SQL, as common table expressions.

VECTORS_SQL = "v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings)"
DOCS_SQL = (
    "d AS (SELECT documents.doc_id, CAST(documents.doc_id AS VARCHAR) AS node_id, text, lang, source, n_chars,"
    " quality, toxic FROM documents LEFT JOIN labels ON labels.doc_id = documents.doc_id)"
)
CENTRES_SQL = (
    "m AS (SELECT label, i, CAST(avg(x) AS FLOAT) AS x FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,"
    " generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i),"
    " c AS (SELECT label AS cell, CAST(list(x ORDER BY i) AS DOUBLE[]) AS centre FROM m GROUP BY label)"
)
DISTANCE_SQL = {
    "cosine": "list_cosine_distance({a}, {b})",
    "euclidean": "list_distance({a}, {b})",
    "inner_product": "-list_inner_product({a}, {b})",
}
SIMILARITY_SQL = {
    "cosine": "1 - {d}",
    "euclidean": "1 / (1 + greatest(0, {d}))",
    "inner_product": "-({d})",
}

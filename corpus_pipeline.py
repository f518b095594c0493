"""The corpus pipeline: documents in, shards of a clean and mixed corpus out.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept.  All but the
last return the columns of documents; the mixing stage may return a document more than once or not at
all, which is what it is for.

All stages take empty tables, nulls in any column, texts of any length and repeated rows.  Other columns may have
any names and come back as they are, except from the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.llm import decontaminate, mixing, near, quality, sharding
from nearspan.llm.common import load, settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.  Null, empty and blank texts are rejected; repeated rows are judged alike."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles: the one with the smallest id.

    Null ids come last, ties go to the smaller digest of the text.  Of rows that repeat an id and a text one stays;
    documents without words stay.
    """
    return near.one_of_each(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands.  Null, empty and blank texts stay, repeated rows go or stay together."""
    return decontaminate.clean_documents(docs, load(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix draws them.

    A null source is a source of its own; texts without words are never drawn; repeated rows are drawn one by one.
    """
    return mixing.mixed_rows(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix, with its size, checksum and source.

    A null text counts as empty.  Repeated rows get slots of their own, null ids come first in the order of rows.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        sharding.crc32(text).alias("text_crc32"),
    )
    return sharding.shard(slim, [F.col("doc_id"), F.col("text_crc32"), F.col("size")])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# Neither the near-duplicate groups nor the permutations can be said in SQL within bounds.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

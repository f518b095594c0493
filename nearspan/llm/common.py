"""Helpers of the training-data operators: tables, row keys, and written intermediate results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again.

    Cuts the lineage: later jobs read files that outlive lost executors, and every reader sees the
    same rows.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def whole(text: Column | str) -> Column:
    """A text as the operators take it: null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_key(text: Column) -> Column:
    """128-bit digest of a text; rows with equal texts share it."""
    return F.unhex(F.md5(text))


def unit_hash(*parts: Column | str, seed: int) -> Column:
    """A number in [0, 1) that depends on the parts and the seed alone."""
    columns = [F.lit(seed), *(F.col(p) if isinstance(p, str) else p for p in parts)]
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))

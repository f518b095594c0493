"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered in the order of their keys.  A Feistel network over the next even power of two
permutes the numbers; a value beyond the row count is permuted again until it falls inside (cycle
walking), which keeps the map one-to-one.  Shard and slot of a row follow from its number alone, and
``source_row`` gives the row that stands at a shard and slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.llm.common import settle, whole

ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, (int(max(n - 1, 1)).bit_length() + 1) // 2)


def _round(half: np.ndarray, key: int, bits: int) -> np.ndarray:
    h = (half + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h & np.uint64((1 << bits) - 1)


def _keys(seed: int) -> list[int]:
    return [int(k) for k in np.random.SeedSequence(seed).generate_state(ROUNDS, np.uint64) >> np.uint64(1)]


def permute(numbers: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The permutation of ``0 .. n-1`` that the seed names, or its inverse."""
    bits = _half_bits(n)
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    keys = _keys(seed)
    value = np.asarray(numbers, np.uint64).copy()
    walking = np.arange(len(value))
    while len(walking):
        left, right = value[walking] >> shift, value[walking] & mask
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ _round(left, key, bits), left
            else:
                left, right = right, left ^ _round(right, key, bits)
        value[walking] = (left << shift) | right
        walking = walking[value[walking] >= np.uint64(n)]
    return value.astype(np.int64)


def source_row(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """The number of the row that stands at a shard and slot."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def permuted(number: Column, n: int, seed: int) -> Column:
    @F.pandas_udf(T.LongType())
    def apply(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    return apply(number)


def numbered(frame: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """The rows with ``_row``, their place in the order from 0 without gaps, and the row count.

    Sorted once by ranges of the order; equal rows are spread by a last random key, so that many
    copies don't meet in one task.  The sorted rows are written with their place in their partition,
    and the partitions' counts, a handful of rows, give the offsets.
    """
    ordered = frame.withColumn("_tie", F.rand(5)).orderBy(*order, "_tie").drop("_tie")
    place = F.monotonically_increasing_id()
    ordered = ordered.withColumn("_part", F.shiftright(place, 33).cast("int"))
    ordered = settle(ordered.withColumn("_at", place.bitwiseAND((1 << 33) - 1)), "numbered")
    counts = dict(ordered.groupBy("_part").count().collect())
    offsets, total = [], 0
    for part in sorted(counts):
        offsets.append((part, total))
        total += counts[part]
    starts = frame.sparkSession.createDataFrame(offsets, "_part int, _start long")
    joined = ordered.join(F.broadcast(starts), "_part")
    return joined.withColumn("_row", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start"), total


def shard(
    frame: DataFrame, order: list[Column], shards: int = 8, seed: int = 20, names: tuple[str, str] = ("shard", "slot")
) -> DataFrame:
    """Every row with its shard and its slot there, by the law ``rows``: counts at most one apart.

    Slots run from 0 without gaps.  Columns of the two names are replaced; the names ``_row``,
    ``_part``, ``_at``, ``_start`` and ``_tie`` are reserved.  Equal rows get different slots, an
    empty table stays empty.
    """
    rows, total = numbered(frame.drop(*names), order)
    place = permuted(F.col("_row"), total, seed)
    rows = rows.withColumn("_row", place)
    return rows.withColumns(
        {names[0]: F.pmod("_row", F.lit(shards)).cast("int"), names[1]: F.floor(F.col("_row") / shards)}
    ).drop("_row")


def crc32(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def document_shards(documents: DataFrame, shards: int = 8, seed: int = 20) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    The size is the text's bytes plus one; a null text counts as empty.  Rows are numbered by
    doc_id (null first), checksum and size.
    """
    text = whole("text")
    slim = documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), crc32(text).alias("text_crc32")
    )
    placed = shard(slim, [F.col("doc_id"), F.col("text_crc32"), F.col("size")], shards, seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

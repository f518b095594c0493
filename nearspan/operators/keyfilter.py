"""Anti joins with many keys: rows that no key can match never move.

The keys are marked in a bitmap, built by partial aggregates and sized from their number, of which a row's mark is
looked up by a broadcast join on the bitmap's words.  Rows whose mark is not set go straight to the output, where
they are read; only the others, nearly all of them real matches, are shuffled to meet the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.operators.sizing import MAX_BROADCAST_BYTES, broadcast_if_small, measure

BITS_PER_KEY = 16
# 4 million words of 64 bits; with more keys than fit a larger share of the other rows is shuffled, too.
MAX_BITS = 1 << 28


def without_keys(
    base: DataFrame, keys: DataFrame, on: Sequence[str], max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``base`` that agree with no row of ``keys`` in the columns ``on``; a row with a null there stays.

    A few keys, measured, are sent to the rows.  Beyond that the rows are read once to pass on those that no key can
    match, and once for the rest.  Columns that begin with two underscores are reserved.
    """
    keys = keys.select(*on).distinct()
    rows, size = measure(keys)
    side = broadcast_if_small(keys, max_bytes=max_bytes, measured=(rows, size))
    same = all(base.schema[c].dataType == keys.schema[c].dataType for c in on)
    if side is not keys or not same:
        # Marks tell only values of one type apart.
        return base.join(side, list(on), "left_anti")
    marked = _marked(base, keys, on, rows)
    passed = marked.where(~F.col("__met")).select(base.columns)
    met = marked.where("__met").select(base.columns)
    return passed.unionByName(met.join(keys.hint("shuffle_merge"), list(on), "left_anti"))


def _marked(base: DataFrame, keys: DataFrame, on: Sequence[str], n_keys: int) -> DataFrame:
    bits = min(MAX_BITS, max(64, 1 << (BITS_PER_KEY * max(1, n_keys) - 1).bit_length()))
    words = keys.select(*_place(on, bits)).groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __bit)")).alias("__bits"))
    placed = base.select(*base.columns, *_place(on, bits)).join(F.broadcast(words), "__word", "left")
    met = F.coalesce(F.expr("(shiftrightunsigned(__bits, __bit) & 1) = 1"), F.lit(False))
    return placed.withColumn("__met", met)


def _place(on: Sequence[str], bits: int) -> tuple[Column, Column]:
    mark = F.pmod(F.xxhash64(*on), F.lit(bits))
    return F.shiftright(mark, 6).cast("int").alias("__word"), mark.bitwiseAND(F.lit(63)).cast("int").alias("__bit")

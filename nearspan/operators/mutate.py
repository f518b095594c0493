"""Upsert and delete as functions from frame to frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from nearspan.functions.filters import FilterGroup, MetaFilter, predicate
from nearspan.functions.metadata import read_key
from nearspan.operators.keyfilter import without_keys
from nearspan.operators.lookup import LITERAL_IDS
from nearspan.operators.sizing import MAX_BROADCAST_BYTES
from nearspan.schema import TableConfig
from nearspan.session import small_frame


def latest(updates: DataFrame, key: str = "node_id", seq: str | None = "seq") -> DataFrame:
    """One row per key: the one with the highest sequence value.

    Equal sequence values, or no sequence column, are decided by a digest of the row, which is
    stable but not an arrival order.  Each task drops superseded rows before the shuffle, so a key
    that is updated very often sends one row per task.
    """
    digest = F.xxhash64(*updates.columns)
    order = ([F.col(seq).desc_nulls_last()] if seq else []) + [digest.desc()]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    kept = updates.withColumn("_place", place).where(F.col("_place") <= 1).drop("_place")
    return kept.drop(seq) if seq else kept


def upsert(
    base: DataFrame,
    updates: DataFrame,
    key: str = "node_id",
    seq: str | None = "seq",
    on: Sequence[str] = (),
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Base rows without the updated keys, plus the latest update of each key.

    ``on`` adds columns that both sides share and that depend on the key, such as a bucket.  Keys of up to
    ``max_bytes`` are sent to the base rows; beyond that only base rows that a filter of the keys lets through move.
    """
    fresh = latest(updates, key, seq)
    stay = without_keys(base, updates, [key, *on], max_bytes)
    return stay.select(base.columns).unionByName(fresh.select(base.columns))


def keep_unless(base: DataFrame, doomed: Column) -> DataFrame:
    """Rows for which the predicate is not true; an unknown predicate keeps the row."""
    return base.where(~F.coalesce(doomed, F.lit(False)))


def document_predicate(document_id: str, config: TableConfig) -> Column:
    return document_key(config) == F.lit(document_id)


def document_key(config: TableConfig) -> Column:
    """Where a row names its source document."""
    if "ref_doc_id" in config.promoted_names:
        return F.col("ref_doc_id")
    if config.metadata_column:
        return read_key(F.col(config.metadata_column), "ref_doc_id")
    raise ValueError("deleting by source document needs a 'ref_doc_id' column or a JSON metadata column")


def delete_by_document(base: DataFrame, documents: str | DataFrame, config: TableConfig) -> DataFrame:
    """Without the rows of one source document, or of every document in a one-column frame."""
    if isinstance(documents, str):
        return keep_unless(base, document_predicate(documents, config))
    return without_keys(base.withColumn("_ref", document_key(config)), documents.toDF("_ref"), ["_ref"]).drop("_ref")


def delete_by_ids(
    base: DataFrame, ids: DataFrame | Sequence[str], key: str = "node_id", max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    if not isinstance(ids, DataFrame):
        doomed = sorted({str(i) for i in ids})
        if len(doomed) <= LITERAL_IDS:
            return keep_unless(base, F.col(key).isin(doomed)) if doomed else base
        ids = small_frame(base.sparkSession, [(i,) for i in doomed], f"{key} string")
    return without_keys(base, ids, [key], max_bytes)


def delete_by_filters(base: DataFrame, filters: MetaFilter | FilterGroup, config: TableConfig) -> DataFrame:
    doomed = predicate(filters, config)
    if doomed is None:
        raise ValueError("a delete needs at least one filter")
    return keep_unless(base, doomed)


def delete_nodes(
    base: DataFrame,
    config: TableConfig,
    ids: DataFrame | Sequence[str] | None = None,
    filters: MetaFilter | FilterGroup | None = None,
) -> DataFrame:
    """By ids, else by filters, else nothing is deleted."""
    if isinstance(ids, DataFrame) or ids:
        return delete_by_ids(base, ids, config.node_id_column)
    if filters is not None and (isinstance(filters, MetaFilter) or filters.filters):
        return delete_by_filters(base, filters, config)
    return base


def delete_counted(
    base: DataFrame, filters: MetaFilter | FilterGroup, config: TableConfig
) -> tuple[DataFrame, Observation]:
    """The remaining rows and an observation whose ``n_deleted`` is filled by the write itself."""
    doomed = predicate(filters, config)
    if doomed is None:
        raise ValueError("a delete needs at least one filter")
    seen = Observation()
    watched = base.observe(seen, F.count_if(F.coalesce(doomed, F.lit(False))).alias("n_deleted"))
    return keep_unless(watched, doomed), seen

"""Incremental ingest: micro-batches of a stream upserted into a vector store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from nearspan.plans.store import VectorStore


def upsert_batches(store: VectorStore, seq: str | None = None) -> Callable[[DataFrame, int], None]:
    """Batch function for ``foreachBatch``; a replayed batch leaves the same rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store.add(batch, seq)

    return write


def ingest(stream: DataFrame, store: VectorStore, checkpoint: str, seq: str | None = None) -> DataStreamWriter:
    """Writer that upserts what has arrived and then stops; start it with ``.start()``."""
    return (
        stream.writeStream.foreachBatch(upsert_batches(store, seq))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )

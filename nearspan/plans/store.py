"""A vector table as one object: add, search, browse and delete over a bucketed snapshot table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from nearspan.functions.filters import FilterGroup, MetaFilter, predicate
from nearspan.operators import ivf, lookup, mutate
from nearspan.operators.knn import nearest_join, with_payload
from nearspan.operators.mmr import CARRIED_CANDIDATES, DEFAULT_LAMBDA, default_candidates, rerank, with_embeddings
from nearspan.operators.sizing import broadcast_if_small
from nearspan.operators.vector_table import assert_writable, rebuilt_rows, stable_columns, vector_table
from nearspan.schema import TableConfig, check_count, check_name
from nearspan.sources.files import children
from nearspan.sources.snapshots import SnapshotTable
from nearspan.session import small_frame

MODES = ("default", "mmr")
SEARCH_TYPES = ("auto", "knn", "ann")
DEFAULT_RECALL = ivf.RECALL

Filters = MetaFilter | FilterGroup | None


class VectorStore:
    """Vector table under ``path``.

    Rows are bucketed by node id, which is the key of every write.  Writes commit whole
    generations; a reader sees the last committed one.
    """

    def __init__(self, spark: SparkSession, path: str, config: TableConfig, buckets: int = 1):
        self.spark = spark
        self.path = path.rstrip("/")
        self.config = config
        self.table = SnapshotTable(spark, f"{self.path}/table", config.schema, config.node_id_column, buckets)

    # Reading

    def rows(self) -> DataFrame:
        return self.table.read().drop("bucket")

    def count(self) -> int:
        return self.table.count()

    def get_nodes(
        self, ids: DataFrame | Sequence[str] | None = None, filters: Filters = None, limit: int | None = None
    ) -> DataFrame:
        """Rows by ids, else by filters, else all; a ``limit`` caps the latter two."""
        found = lookup.browse(self._holding(ids), self.config, ids, filters, limit)
        return found.select(*stable_columns(self.config))

    def get_documents(
        self, ids: DataFrame | Sequence[str] | None = None, filters: Filters = None, limit: int | None = None
    ) -> DataFrame:
        """Like ``get_nodes``, with text and one metadata map as they were added."""
        return rebuilt_rows(lookup.browse(self._holding(ids), self.config, ids, filters, limit), self.config)

    def search_by_metadata(self, filters: Filters, limit: int = 10) -> DataFrame:
        found = lookup.search_by_metadata(self.rows(), filters, self.config, limit)
        return found.select(*stable_columns(self.config))

    def embeddings(self, ids: DataFrame | Sequence[str]) -> DataFrame:
        names = self.config.node_id_column, self.config.embedding_column
        return lookup.fetch_embeddings(self._holding(ids), ids, *names)

    def _holding(self, ids) -> DataFrame:
        """Rows of the buckets that can hold a short list of ids, else all rows."""
        if ids is None or isinstance(ids, DataFrame) or not 0 < len(ids) <= lookup.LITERAL_IDS:
            return self.rows()
        keys = small_frame(self.spark, [(str(i),) for i in ids], f"{self.config.node_id_column} string")
        return self.table.read(self.table.touched_by(keys)).drop("bucket")

    # Searching

    def query(
        self,
        queries: DataFrame | Sequence[float],
        k: int = 10,
        filters: Filters = None,
        mode: str = "default",
        search_type: str = "auto",
        probes: int | None = None,
        recall: float | None = None,
        fetch_k: int | None = None,
        lambda_mult: float = DEFAULT_LAMBDA,
        qid: str = "qid",
        with_rows: bool = True,
    ) -> DataFrame:
        """Nearest rows of one vector or of a frame ``(qid, embedding)``.

        Filters are applied before ranking.  ``mode="mmr"`` re-ranks ``fetch_k`` candidates for
        diversity.  ``search_type``: ``knn`` and ``auto`` are exact at every size; ``ann`` uses the
        index if there is a current one, with filters and after writes too.  It reads ``probes``
        cells, or as many as gave the ``recall`` asked for (0.9 by default) when the index was measured.
        """
        if mode not in MODES:
            raise NotImplementedError(f"query mode {mode!r} is not available")
        if search_type not in SEARCH_TYPES:
            raise ValueError(f"search type {search_type!r} must be one of {SEARCH_TYPES}")
        check_count(k, "k")
        if probes is not None:
            check_count(probes, "probes")
        if queries is None:
            raise ValueError("the query vector is missing")
        if not isinstance(queries, DataFrame):
            queries = small_frame(self.spark, [(0, [float(x) for x in queries])], f"{qid} int, embedding array<float>")
        wanted = predicate(filters, self.config)
        fetch = k if mode == "default" else fetch_k or default_candidates(k)
        index = self._usable_index(search_type)
        names = self.config.node_id_column, self.config.embedding_column
        corpus = self.rows() if wanted is None else self.rows().where(wanted)
        corpus = corpus.select(F.col(names[0]).alias("node_id"), F.col(names[1]).alias("embedding"))
        carry = ["embedding"] if mode == "mmr" and queries.count() * fetch <= CARRIED_CANDIDATES else []
        options = {"qid": qid, "with_cosine": mode == "mmr", "carry": carry}
        if index is not None:
            wanted_recall = recall or DEFAULT_RECALL if probes is None else None
            found = ivf.search_bounded(
                index, queries, fetch, wanted_recall, None if wanted is None else filters, self.config, probes, **options
            )
        else:
            found = nearest_join(corpus, queries, fetch, self.config.metric, **options)
        if mode == "mmr":
            if not carry:
                found = with_embeddings(found, corpus, queries, fetch)
            found = rerank(found, k, lambda_mult, qid)
        if not with_rows:
            return found
        rows = self.rows().select(*stable_columns(self.config))
        return with_payload(found, rows, rows.columns[1:], queries, k)

    def _usable_index(self, search_type: str) -> ivf.IvfIndex | None:
        index = self.find_index() if search_type == "ann" else None
        return index if index is not None and index.generation() == self.table.generation() else None

    def _following(self) -> ivf.IvfIndex | None:
        """The index that a change now must be added to."""
        return self._usable_index("ann")

    def _follow(self, index: ivf.IvfIndex | None, rows: DataFrame | None = None, removed: DataFrame | None = None) -> None:
        """Add a change of the table to its index."""
        if index is None:
            return
        names = self.config.node_id_column, self.config.embedding_column
        if rows is not None:
            rows = rows.select(F.col(names[0]).alias("node_id"), F.col(names[1]).alias("embedding"), *self._filter_columns())
        if removed is not None:
            removed = removed.select(F.col(names[0]).alias("node_id"))
        ivf.add_changes(index, rows, removed, self.table.generation())

    def _filter_columns(self) -> list[str]:
        """What an index carries so that every filter can be answered from it."""
        return [*self.config.promoted_names, *([self.config.metadata_column] if self.config.metadata_column else [])]

    # Writing

    def add(self, rows: DataFrame, seq: str | None = None) -> int:
        """Insert rows, replacing those whose node id is there already; the table's row count.

        The whole frame is checked before anything is written.  ``seq`` orders repeated node ids
        within the frame, the last one wins.
        """
        table = vector_table(rows, self.config, (seq,) if seq else ())
        key = self.config.node_id_column
        table = table.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not assert_writable(table, self.config):
                return self.count()
            fresh = mutate.latest(table, key, seq)
            index = self._following()
            touched = self.table.touched_by(table.select(key))
            before = self.table.read(touched)
            kept = before.join(broadcast_if_small(table.select(key).distinct()), key, "left_anti")
            self.table.replace(fresh, touched, kept)
            self._follow(index, fresh)
            return self.count()
        finally:
            table.unpersist()

    def delete(self, document: str | DataFrame) -> int:
        """Delete the rows of one source document, or of a frame of them; the number deleted."""
        if isinstance(document, str):
            return self._delete_where(mutate.document_predicate(document, self.config))
        hit = lookup.by_values(self.table.read(), mutate.document_key(self.config), document)
        touched = self._buckets_of(hit)
        kept = mutate.delete_by_document(self.table.read(touched), document, self.config)
        return self._keep(kept, touched, hit)

    def delete_nodes(self, ids: DataFrame | Sequence[str] | None = None, filters: Filters = None) -> int:
        """By ids, else by filters, else nothing; the number deleted."""
        key = self.config.node_id_column
        if isinstance(ids, DataFrame) or ids:
            if not isinstance(ids, DataFrame):
                ids = small_frame(self.spark, [(str(i),) for i in ids], f"{key} string")
            touched = self.table.touched_by(ids.select(key))
            return self._keep(mutate.delete_by_ids(self.table.read(touched), ids, key), touched, ids)
        if filters is None or (isinstance(filters, FilterGroup) and not filters.filters):
            return 0
        return self.delete_by_metadata(filters)

    def delete_by_metadata(self, filters: Filters) -> int:
        """Delete the rows that match; the number deleted."""
        doomed = predicate(filters, self.config)
        if doomed is None:
            raise ValueError("a delete needs at least one filter")
        return self._delete_where(doomed)

    def _delete_where(self, doomed: Column) -> int:
        """Only buckets with matches are rewritten, without a shuffle."""
        hit = self.table.read().where(doomed)
        touched = self._buckets_of(hit)
        return self._keep(mutate.keep_unless(self.table.read(touched), doomed), touched, hit)

    @staticmethod
    def _buckets_of(rows: DataFrame) -> set[int]:
        return {r["bucket"] for r in rows.select("bucket").distinct().collect()}

    def _keep(self, kept: DataFrame, touched: set[int], removed: DataFrame) -> int:
        before = sum(b.n_rows for n, b in self.table.state().items() if n in touched)
        if not before:
            return 0
        index = self._following()
        left = self.table.replace(None, touched, kept)
        self._follow(index, removed=removed)
        return before - left

    def clear(self) -> None:
        """Remove all rows and keep the table."""
        self.table.clear()

    def drop(self) -> None:
        """Remove the table and its indexes."""
        self.table.drop()
        for generation in self._index_paths():
            ivf.drop_index(self.spark, generation)

    # Index

    def _index_paths(self) -> list[str]:
        return [f"{self.path}/index/{n}" for n in children(self.spark, f"{self.path}/index")]

    def find_index(self) -> ivf.IvfIndex | None:
        """The newest index of the table."""
        for path in reversed(self._index_paths()):
            index = ivf.open_index(self.spark, path, self.config.metric)
            if index is not None:
                return index
        return None

    def apply_vector_index(
        self, index_name: str = "vi", n_cells: int | None = None, max_iter: int = 10, metric: str | None = None
    ) -> ivf.IvfIndex:
        check_name(index_name, "index name")
        if metric is not None and metric != self.config.metric:
            raise ValueError(f"the table uses {self.config.metric}, an index for {metric} would not serve it")
        generation = self.table.generation()
        number = max([int(p.rsplit("/", 1)[1][:6]) for p in self._index_paths()], default=0) + 1
        return ivf.build_index(
            self.rows(),
            f"{self.path}/index/{number:06d}-{index_name}",
            self.config.metric,
            n_cells,
            max_iter,
            index_name=index_name,
            node_id=self.config.node_id_column,
            embedding=self.config.embedding_column,
            keep=self._filter_columns(),
            source_generation=generation,
        )

    def drop_vector_index(self, index_name: str | None = None) -> bool:
        """Drop the indexes of a name, or all; without one searches are exact."""
        paths = [p for p in self._index_paths() if index_name is None or p.rsplit("/", 1)[1][7:] == index_name]
        return any([ivf.drop_index(self.spark, path) for path in paths])

    def optimize(self) -> ivf.IvfIndex | None:
        """Fresh centroids and cells over the current rows, and fresh files for the table."""
        index = self.find_index()
        self.table.replace(self.rows())
        if index is None:
            return None
        info = index.info().first()
        old = self._index_paths()
        fresh = self.apply_vector_index(info["index_name"], None, info["max_iter"])
        for path in old:
            ivf.drop_index(self.spark, path)
        return fresh

    def get_stats(self) -> DataFrame | None:
        index = self.find_index()
        return None if index is None else ivf.index_stats(index, self.count())

    def explain_index_health(self, queries: DataFrame, k: int = 10, probes: Sequence[int] = (1, 4, 8)) -> DataFrame | None:
        index = self.find_index()
        if index is None:
            return None
        names = self.config.node_id_column, self.config.embedding_column
        corpus = self.rows().select(F.col(names[0]).alias("node_id"), F.col(names[1]).alias("embedding"))
        return ivf.index_health(index, corpus, queries, k, probes)

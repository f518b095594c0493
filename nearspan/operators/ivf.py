"""Approximate search: rows are grouped into cells around centroids, a query probes a few cells.

The index is a Parquet table of ``(cell, node_id, embedding, gap)`` in directories by cell, ``gap`` being how far
the row is from its centroid; a table of centroids; one of the cells' sizes, radii and synopses; and one row that
describes the index.  Probing every cell is the exact search, and so is :func:`search_bounded`, which reads only the
cells that can hold an answer.

Changes of the table are added as a set of new rows in the existing cells and a list of the rows that they replace or
remove, with its cells (:func:`add_changes`); a search joins the latter out of the cells it reads.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from nearspan.functions import synopsis
from nearspan.functions.distance import norm
from nearspan.functions.filters import FilterGroup, MetaFilter, predicate
from nearspan.operators.cells import (
    MAX_CENTROID_BYTES,
    Bins,
    CellSet,
    Found,
    MATRIX_CELLS,
    bins_of,
    cell_ranks,
    dealt,
    dealt_schema,
    gather_cells,
    meet_cells,
    radius_of,
    rows_by_probes,
    search_cells,
)
from nearspan.operators.kernel import Block, NearestRows, matrix
from nearspan.operators.knn import (
    MAX_SENT_QUERIES,
    PART_QUERIES,
    check_queries,
    finish,
    gather_queries,
    keep_nearest,
    nearest_join,
    scan_with_queries,
)
from nearspan.operators.sizing import broadcast_if_small
from nearspan.schema import METRICS, TableConfig, check_count, check_name
from nearspan.session import scratch_path, small_frame
from nearspan.sources.files import children, exists, remove

# A recall is measured on this many rows of the table, chosen by hash, as queries.
CALIBRATION_ROWS = 500
RECALL = 0.9
ALGORITHM = "IVF"
INFO_SCHEMA = (
    "index_name string, column_name string, algorithm string, metric_type string, dimension int,"
    " n_cells int, max_iter int, n_rows long, source_generation long"
)


@dataclass(frozen=True)
class IvfIndex:
    """Handle of a built index."""

    spark: SparkSession
    path: str

    def info(self) -> DataFrame:
        return self.spark.read.schema(INFO_SCHEMA).json(f"{self.path}/info")

    def deltas(self) -> list[int]:
        """Numbers of the changes added since the index was built; one without its info row was never finished."""
        found = [int(n) for n in children(self.spark, f"{self.path}/deltas")]
        return [n for n in sorted(found) if exists(self.spark, f"{self._delta(n)}/info")]

    def _delta(self, number: int) -> str:
        return f"{self.path}/deltas/{number:06d}"

    def _parts(self, name: str) -> list[tuple[int, DataFrame]]:
        """A table of the index and of each change that has it, by number; the index itself is 0."""
        paths = [(0, self.path), *((n, self._delta(n)) for n in self.deltas())]
        return [(n, self.spark.read.parquet(f"{p}/{name}")) for n, p in paths if exists(self.spark, f"{p}/{name}")]

    def generation(self) -> int:
        """The generation of the table that the index stands for."""
        numbers = self.deltas()
        path = f"{self._delta(numbers[-1])}/info" if numbers else f"{self.path}/info"
        return self.spark.read.schema(INFO_SCHEMA).json(path).first()["source_generation"]

    def centroids(self) -> DataFrame:
        return _united([part for _, part in self._parts("centroids")])

    def kept(self) -> list[T.StructField]:
        """Columns that travel with the rows."""
        fields = self.spark.read.parquet(f"{self.path}/rows").schema.fields
        return [f for f in fields if f.name not in ("node_id", "embedding", "gap", "cell")]

    def rows(self, where: Column | None = None) -> DataFrame:
        """The current rows of the cells, of those for which a condition on ``cell`` holds if one is given.

        A row is gone if a later change names it and its cell.
        """
        known, lost = self._parts("rows"), self._parts("gone")
        parts = [p.where(where) if where is not None else p for _, p in known]
        numbers = [n for n, _ in known]
        gone = [p.where(where) if where is not None else p for _, p in lost]
        if not gone:
            return _united(parts)
        marked = [p.withColumn("gone_by", F.lit(n)) for p, (n, _) in zip(gone, lost)]
        last = _united(marked).groupBy("node_id", "cell").agg(F.max("gone_by").alias("gone_by"))
        rows = _united([p.withColumn("added_by", F.lit(n)) for p, n in zip(parts, numbers)])
        joined = rows.join(broadcast_if_small(last), ["node_id", "cell"], "left")
        here = F.col("gone_by").isNull() | (F.col("gone_by") <= F.col("added_by"))
        return joined.where(here).select(*parts[0].columns)

    def cells(self) -> DataFrame:
        """Per cell: centroid, rows, radius, and the synopsis of the kept columns."""
        fields = synopsis.summarised(self.kept())
        whole = _united([part for _, part in self._parts("cells")])
        sums = whole.groupBy("cell").agg(
            F.sum("n_rows").alias("n_rows"), F.max("radius").alias("radius"), *synopsis.combined(fields)
        )
        gone = [part for _, part in self._parts("gone")]
        if gone:
            lost = _united(gone).groupBy("cell").agg(F.count("*").alias("lost"))
            sums = sums.join(lost, "cell", "left")
            sums = sums.withColumn("n_rows", F.col("n_rows") - F.coalesce("lost", F.lit(0))).drop("lost")
        return self.centroids().join(sums, "cell", "left").fillna(0, ["n_rows", "radius"])

    def rows_of(self) -> int:
        return self.cells().agg(F.sum("n_rows")).first()[0] or 0


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def unit(embedding: str, metric: str):
    """The vector that cells are built on: its direction under cosine, itself otherwise."""
    vector = F.col(embedding)
    if metric != "cosine":
        return vector
    length = norm(vector)
    # The length is an element here, so that it is not computed anew for each value.
    scaled = F.transform(F.array(length), lambda n: F.transform(vector, lambda x: (x / n).cast("float")))[0]
    return F.when(length > 0, scaled).otherwise(vector)


def train_centroids(
    corpus: DataFrame,
    n_cells: int,
    metric: str = "cosine",
    max_iter: int = 10,
    seed: int = 7,
    node_id: str = "node_id",
    embedding: str = "embedding",
    train_rows: int | None = None,
) -> DataFrame:
    """Centroids ``(cell, centroid)`` learnt by k-means, from all rows unless ``train_rows`` asks for a sample.

    Centroids only steer the search; every row is indexed.  A sample is of about the given number of
    rows, chosen by hash.
    """
    check_count(n_cells, "n_cells")
    usable = corpus.where(F.col(embedding).isNotNull())
    total = usable.count()
    if not total:
        raise ValueError("an index needs rows with embeddings")
    if train_rows is not None and total > train_rows:
        usable = usable.where(F.pmod(F.xxhash64(node_id), F.lit(-(-total // check_count(train_rows, "train_rows")))) == 0)
    points = usable.select(array_to_vector(unit(embedding, metric)).alias("features")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=n_cells, seed=seed, maxIter=max_iter, initMode="random").fit(points)
    finally:
        points.unpersist()
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return small_frame(corpus.sparkSession, centres, "cell int, centroid array<float>")


def _gather_centroids(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The centroids as arrays, after a check that they take at most ``MAX_CENTROID_BYTES``."""
    size = centroids.agg(F.sum(F.size("centroid") * 4)).first()[0]
    if not 0 < (size or 0) <= MAX_CENTROID_BYTES:
        raise ValueError(f"centroids take {size} bytes, an index has 1 to {MAX_CENTROID_BYTES}")
    table = centroids.select("cell", "centroid").orderBy("cell").toArrow()
    return table["cell"].to_numpy().astype(np.int32), matrix(table["centroid"])


def assign_cells(
    rows: DataFrame,
    centroids: DataFrame,
    probes: int = 1,
    embedding: str = "embedding",
    metric: str = "cosine",
    asking: bool = False,
    with_gap: bool = False,
) -> DataFrame:
    """Each row with its ``probes`` nearest cells as rows ``(..., cell, probe)``, without a shuffle.

    ``with_gap`` adds how far the centroid is, null if that is undefined.

    Rows of an inner-product index lie in the cell at the least Euclidean distance; queries, told by
    ``asking``, look first where the product with the centroid is largest.
    """
    cells, centres = _gather_centroids(centroids)
    probes = min(check_count(probes, "probes"), len(cells))
    payload = rows.sparkSession.sparkContext.broadcast((cells, centres))
    near_metric = _cell_metric(metric, asking)
    schema = T.StructType(
        [*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("probe", T.IntegerType())]
    )
    if with_gap:
        schema = schema.add("gap", T.DoubleType())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, centres = payload.value
        targets = Block(centres, pa.table({"node_id": pa.array(ids)}), probes, near_metric)
        for batch in batches:
            if not batch.num_rows:
                continue
            near = NearestRows(matrix(batch.column(embedding), centres.shape[1]), probes, near_metric)
            near.offer(targets)
            best = near.best.sort_by([("query", "ascending"), ("distance", "ascending"), ("node_id", "ascending")])
            out = pa.Table.from_batches([batch]).take(best["query"])
            turn = (np.arange(out.num_rows) % probes + 1).astype(np.int32)
            out = out.append_column("cell", best["node_id"]).append_column("probe", pa.array(turn))
            if with_gap:
                gap = best["distance"].to_numpy()
                out = out.append_column("gap", pa.array(gap, mask=~np.isfinite(gap)))
            yield from out.to_batches(max_chunksize=10_000)

    return rows.mapInArrow(place, schema)


def _cell_metric(metric: str, asking: bool) -> str:
    return "euclidean" if metric == "inner_product" and not asking else metric


def build_index(
    corpus: DataFrame,
    path: str,
    metric: str = "cosine",
    n_cells: int | None = None,
    max_iter: int = 10,
    seed: int = 7,
    centroids: DataFrame | None = None,
    index_name: str = "vi",
    node_id: str = "node_id",
    embedding: str = "embedding",
    keep: Sequence[str] = (),
    source_generation: int = 0,
    train_rows: int | None = None,
) -> IvfIndex:
    """Write an index over all rows of ``corpus``.

    A cell may hold any share of the rows: the write splits large cells over tasks and files.
    """
    spark = corpus.sparkSession
    check_name(index_name, "index name")
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} must be one of {METRICS}")
    if exists(spark, f"{path}/info"):
        raise ValueError(f"there is already an index at {path}")
    rows = corpus.select(F.col(node_id).alias("node_id"), F.col(embedding).alias("embedding"), *keep)
    if centroids is None:
        if n_cells is None:
            n_cells = default_cells(rows.count())
        centroids = train_centroids(rows, n_cells, metric, max_iter, seed, train_rows=train_rows)
    centroids.write.parquet(f"{path}/centroids")
    centroids = spark.read.parquet(f"{path}/centroids")
    _write_rows(rows, centroids, metric, path)
    total = spark.read.parquet(f"{path}/rows").count()
    used = centroids.count()
    dim = centroids.select(F.max(F.size("centroid"))).first()[0]
    info = [(index_name, embedding, ALGORITHM, metric, dim, used, max_iter, total, source_generation)]
    small_frame(spark, info, INFO_SCHEMA).coalesce(1).write.json(f"{path}/info")
    return IvfIndex(spark, path)


def _write_rows(rows: DataFrame, centroids: DataFrame, metric: str, path: str) -> None:
    """Rows in their cells, and the cells' sizes, radii and synopses, under a path."""
    placed = assign_cells(rows, centroids, 1, "embedding", metric, with_gap=True).drop("probe")
    placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/rows")
    written = rows.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    fields = synopsis.summarised(f for f in placed.schema.fields if f.name not in ("node_id", "embedding", "gap", "cell"))
    sizes = written.groupBy("cell").agg(
        F.count("*").alias("n_rows"), radius_of(F.col("gap"), metric).alias("radius"), *synopsis.aggregates(fields)
    )
    sizes.write.parquet(f"{path}/cells")


def default_cells(n_rows: int) -> int:
    return max(1, round(math.sqrt(max(n_rows, 1))))


def open_index(spark: SparkSession, path: str, metric: str | None = None) -> IvfIndex | None:
    """The index at a path, or None; an index of another metric than the table's is an error."""
    if not exists(spark, f"{path}/info"):
        return None
    index = IvfIndex(spark, path)
    built = index.info().first()["metric_type"]
    if metric is not None and built != metric:
        raise ValueError(f"the index at {path} was built for {built}, the table uses {metric}")
    return index


def drop_index(spark: SparkSession, path: str) -> bool:
    return remove(spark, path) if exists(spark, path) else False


def search_index(
    index: IvfIndex,
    queries: DataFrame,
    k: int,
    probes: int = 8,
    metric: str | None = None,
    qid: str = "qid",
    query_embedding: str = "embedding",
    carry: Sequence[str] = (),
    with_cosine: bool = False,
    max_sent: int = MAX_SENT_QUERIES,
    slice_rows: int | None = None,
    part_queries: int = PART_QUERIES,
) -> DataFrame:
    """The ``k`` nearest rows of each query among the rows of its ``probes`` nearest cells."""
    check_count(k, "k")
    check_count(probes, "probes")
    info = index.info().first()
    if metric is not None and metric != info["metric_type"]:
        raise ValueError(f"the index was built for {info['metric_type']}, not {metric}")
    metric = info["metric_type"]
    asked = queries.select(F.col(qid).alias("query_id"), F.col(query_embedding).alias("vector"))
    rows = index.rows().select("node_id", F.col("embedding").alias("vector"), *carry, "cell")
    id_type = asked.schema["query_id"].dataType
    centroids = index.centroids()
    sent = gather_queries(asked, max_sent)
    if sent is not None:
        wanted = _probe_lists(sent, centroids, probes, metric)
        # Other cells are not read at all; a list of most cells would only burden the plan.
        needed = rows if 2 * len(wanted) > info["n_cells"] else rows.where(F.col("cell").isin(sorted(wanted)))
        found = scan_with_queries(needed, sent, id_type, k, metric, with_cosine, wanted)
        return finish(keep_nearest(found, k), metric, qid, "node_id")
    dim = check_queries(asked)
    cells = gather_cells(index.cells(), metric)
    bins = bins_of(cells, dim, slice_rows, index.spark.sparkContext.defaultParallelism)
    met = _probing(asked, cells, bins, probes, metric)
    found, _ = meet_cells(rows, met, cells, bins, k, metric, with_cosine, dim, part_queries)
    return finish(keep_nearest(found, k), metric, qid, "node_id")


def search_bounded(
    index: IvfIndex,
    queries: DataFrame,
    k: int,
    recall: float | None = None,
    filters: MetaFilter | FilterGroup | None = None,
    config: TableConfig | None = None,
    probes: int | None = None,
    qid: str = "qid",
    query_embedding: str = "embedding",
    carry: Sequence[str] = (),
    with_cosine: bool = False,
    **options,
) -> DataFrame:
    """The ``k`` nearest rows of each query, of those that match the filters; ``k`` of them if there are so many.

    By default the result is that of the exact join over the same rows, but cells that cannot hold an answer are not
    read.  With ``probes`` each query reads so many of its nearest cells with rows, and on until they hold ``k``
    rows; with ``recall`` as many as gave that recall when the index was measured (see :func:`calibrate`).

    Filters name kept columns, or keys of a kept JSON column.  Cells whose synopsis rules a match out are skipped; in
    the others matches are counted by a read of the filtered columns alone, so that sizes are those of the matches.
    """
    return bounded(
        index, queries, k, recall, filters, config, probes, qid, query_embedding, carry, with_cosine, **options
    ).rows


def bounded(
    index: IvfIndex,
    queries: DataFrame,
    k: int,
    recall: float | None = None,
    filters: MetaFilter | FilterGroup | None = None,
    config: TableConfig | None = None,
    probes: int | None = None,
    qid: str = "qid",
    query_embedding: str = "embedding",
    carry: Sequence[str] = (),
    with_cosine: bool = False,
    **options,
) -> Found:
    """What :func:`search_bounded` gives, and per visited cell its rows and how many queries visited it."""
    check_count(k, "k")
    if probes is not None and recall is not None:
        raise ValueError("give a number of probes or a recall, not both")
    if recall is not None:
        probes = probes_for(index, recall)
    first = check_count(1 if probes is None else probes, "probes")
    metric = index.info().first()["metric_type"]
    asked = queries.select(F.col(qid).alias("query_id"), F.col(query_embedding).alias("vector"))
    table = index.cells()
    wanted = None if filters is None else predicate(filters, config)
    if wanted is None:
        rows = index.rows()
    else:
        fields = synopsis.summarised(index.kept())
        able = [r["cell"] for r in table.where((F.col("n_rows") > 0) & synopsis.possible(filters, config, fields)).select("cell").collect()]
        rows = index.rows(F.col("cell").isin(able) if 2 * len(able) < table.count() else None).where(wanted)
        matches = rows.groupBy("cell").agg(F.count("*").alias("n_rows"))
        table = table.drop("n_rows").join(matches, "cell", "left").fillna(0, ["n_rows"])
    cells = gather_cells(table, metric)
    slim = rows.select("node_id", F.col("embedding").alias("vector"), *carry, "cell")
    found = search_cells(slim, cells, asked, k, first, probes is None, with_cosine, **options)
    return Found(finish(found.rows, metric, qid, "node_id"), found.visits)


def add_changes(
    index: IvfIndex, rows: DataFrame | None = None, removed: DataFrame | None = None, source_generation: int = 0
) -> IvfIndex:
    """New and changed rows ``(node_id, embedding, kept columns)``, and ids ``(node_id)`` of removed ones.

    Rows go to the cells of the existing centroids.  The rows that they replace, or that are removed, are listed with
    their cells.  Nothing of the index is rewritten; the change counts once its info row is there.  One writer at a
    time.  ``rows`` must have one row per id.
    """
    metric = index.info().first()["metric_type"]
    number = max([int(n) for n in children(index.spark, f"{index.path}/deltas")], default=0) + 1
    path = index._delta(number)
    names = [f.name for f in index.kept()]
    keys = [frame.select("node_id") for frame in (rows, removed) if frame is not None]
    if not keys:
        return index
    current = index.rows().select("node_id", "cell")
    gone = current.join(broadcast_if_small(_united(keys).distinct()), "node_id", "left_semi")
    gone.write.parquet(f"{path}/gone")
    if rows is not None:
        _write_rows(rows.select("node_id", "embedding", *names), index.centroids(), metric, path)
    return _finished(index, path, source_generation)


def _finished(index: IvfIndex, path: str, source_generation: int) -> IvfIndex:
    info = {**index.info().first().asDict(), "source_generation": source_generation}
    small_frame(index.spark, [tuple(info.values())], INFO_SCHEMA).coalesce(1).write.json(f"{path}/info")
    return index


def split_cells(index: IvfIndex, factor: float = 4.0, max_iter: int = 10, seed: int = 7) -> int:
    """Cells with more than ``factor`` times the mean number of rows get new centroids among themselves; how many.

    After many changes cells may have drifted.  The rows of the large ones are clustered in one job, into as many
    cells as they have means, and added again as a change; their old cells are then empty.  Distributed like the
    build, whatever share of the rows a cell holds.
    """
    spark = index.spark
    info = index.info().first()
    sizes = index.cells().select("cell", "n_rows").collect()
    used = [r["n_rows"] for r in sizes if r["n_rows"]]
    mean = max(1.0, sum(used) / max(1, len(used)))
    large = {r["cell"]: r["n_rows"] for r in sizes if r["n_rows"] > factor * mean}
    if not large:
        return 0
    number = max([int(n) for n in children(spark, f"{index.path}/deltas")], default=0) + 1
    path, generation = index._delta(number), index.generation()
    rows = index.rows(F.col("cell").isin(sorted(large)))
    fresh = train_centroids(rows, math.ceil(sum(large.values()) / mean), info["metric_type"], max_iter, seed)
    first = max(r["cell"] for r in sizes) + 1
    fresh.withColumn("cell", F.col("cell") + first).write.parquet(f"{path}/centroids")
    rows.select("node_id", "cell").write.parquet(f"{path}/gone")
    names = [f.name for f in index.kept()]
    _write_rows(rows.select("node_id", "embedding", *names), spark.read.parquet(f"{path}/centroids"), info["metric_type"], path)
    _finished(index, path, generation)
    return len(large)


def recall_curve(index: IvfIndex, truth: DataFrame, asked: DataFrame) -> DataFrame:
    """Recall and share of rows read for every number of probes, ``(probes, recall, visited_share)``, in one pass.

    ``truth`` has the true neighbours ``(query_id, node_id)`` of the queries ``(query_id, vector)``.  A neighbour is
    found with so many probes as is the place of its cell in the query's order, so the places' histogram holds the
    recall of every number of probes.
    """
    cells = gather_cells(index.cells(), index.info().first()["metric_type"])
    where = index.rows().select("node_id", "cell")
    placed = truth.join(where, "node_id").join(asked, "query_id").select("vector", "cell")
    hits = cell_ranks(placed, cells).groupBy(F.col("place").alias("probes")).agg(F.count("*").alias("hits"))
    total = truth.count()
    read = rows_by_probes(asked, cells)
    table = read.join(hits, "probes", "left").toArrow().sort_by("probes")
    found = np.cumsum(table["hits"].fill_null(0).to_numpy()) / max(total, 1)
    share = table["n_rows"].to_numpy() / max(asked.count() * cells.total, 1)
    rows = zip(table["probes"].to_pylist(), found.tolist(), share.tolist())
    return small_frame(index.spark, rows, "probes int, recall double, visited_share double")


def calibrate(index: IvfIndex, k: int = 10, rows: int = CALIBRATION_ROWS) -> DataFrame:
    """The recall curve of about ``rows`` rows of the index itself as queries, kept beside the index.

    The rows are a sample by hash, of bounded size; their neighbours are exact.  A row does not count as its own.
    """
    current = index.rows().where(F.col("gap").isNotNull())
    step = max(1, -(-index.rows_of() // check_count(rows, "rows")))
    sample = current.where(F.pmod(F.xxhash64("node_id"), F.lit(step)) == 0)
    asked = sample.select(F.col("node_id").alias("query_id"), F.col("embedding").alias("vector"))
    truth = search_bounded(index, asked, k + 1, qid="query_id", query_embedding="vector")
    truth = truth.where(F.col("query_id") != F.col("node_id")).select("query_id", "node_id")
    path = scratch_path(index.spark, "truth")
    truth.write.parquet(path)
    curve = recall_curve(index, index.spark.read.parquet(path), asked)
    curve.coalesce(1).write.mode("overwrite").parquet(f"{index.path}/curve")
    return curve


def probes_for(index: IvfIndex, recall: float) -> int:
    """The least number of probes that reached a recall when the index was measured; measures it if it never was."""
    if not 0 < recall <= 1:
        raise ValueError(f"recall {recall} must be above 0 and at most 1")
    if not exists(index.spark, f"{index.path}/curve"):
        calibrate(index)
    curve = index.spark.read.parquet(f"{index.path}/curve")
    enough = curve.where(F.col("recall") >= recall).agg(F.min("probes"))
    return enough.first()[0] or curve.count() or 1


def pivot_join(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    n_pivots: int | None = None,
    node_id: str = "node_id",
    embedding: str = "embedding",
    qid: str = "qid",
    query_embedding: str = "embedding",
    **options,
) -> Found:
    """The exact neighbour join with the corpus split around pivots, for many queries on clustered vectors.

    Pivots are rows of the corpus, chosen by hash; every row goes to its nearest pivot, once.  A query goes only to
    the pivots whose rows can be among its ``k`` nearest, and is moved once for each bin of pivots that has one, so it
    is compared with the rows of its ``visits`` alone.
    """
    spark = corpus.sparkSession
    rows = corpus.where(F.col(embedding).isNotNull())
    total, dim = rows.agg(F.count("*"), F.max(F.size(embedding))).first()
    most = MAX_CENTROID_BYTES // (4 * max(dim or 1, 1))
    wanted = min(n_pivots or default_cells(total), most)
    step = max(1, total // wanted)
    chosen = rows.where(F.pmod(F.xxhash64(F.col(node_id), F.lit(7)), F.lit(step)) == 0).orderBy(node_id)
    picked = chosen.select(F.col(embedding).alias("centroid")).limit(most).toArrow()["centroid"].to_pylist()
    if not picked:
        picked = rows.select(embedding).limit(1).toArrow()[embedding].to_pylist()
    if not picked:
        none = nearest_join(corpus, queries, k, metric, node_id, embedding, qid, query_embedding)
        return Found(none, small_frame(spark, [], "cell int, n_queries long, n_rows long"))
    pivots = small_frame(spark, list(enumerate(picked)), "cell int, centroid array<float>")
    index = build_index(
        corpus, scratch_path(spark, "pivots"), metric, centroids=pivots, node_id=node_id, embedding=embedding
    )
    found = bounded(index, queries, k, qid=qid, query_embedding=query_embedding, **options)
    return Found(found.rows.withColumnRenamed("node_id", node_id), found.visits)


def _probe_lists(sent: pa.Table, centroids: DataFrame, probes: int, metric: str) -> dict[int, np.ndarray]:
    """Per cell the positions of the queries that probe it."""
    cells, centres = _gather_centroids(centroids)
    near_metric, probes = _cell_metric(metric, True), min(probes, len(cells))
    near = NearestRows(matrix(sent["vector"]), probes, near_metric)
    near.offer(Block(centres, pa.table({"node_id": pa.array(cells)}), probes, near_metric))
    best = near.best
    if best is None:
        return {}
    chosen, query = best["node_id"].to_numpy(), best["query"].to_numpy()
    return {int(c): np.sort(query[chosen == c]) for c in np.unique(chosen)}


def _probing(asked: DataFrame, cells: CellSet, bins: Bins, probes: int, metric: str) -> DataFrame:
    """Rows ``(query_id, vector, bin, visited)`` for the ``probes`` nearest cells of all queries, without a shuffle."""
    payload = asked.sparkSession.sparkContext.broadcast((cells, bins))
    near_metric, probes = _cell_metric(metric, True), min(probes, len(cells.ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, bins = payload.value
        targets = Block(cells.centres, pa.table({"node_id": pa.array(cells.ids)}), probes, near_metric)
        step = max(1, MATRIX_CELLS // len(cells.ids))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                vectors = matrix(batch.column("vector").slice(at, step), cells.centres.shape[1])
                near = NearestRows(vectors, probes, near_metric)
                near.offer(targets)
                chosen = np.zeros((len(vectors), len(cells.ids)), bool)
                best = near.best
                chosen[best["query"].to_numpy(), np.searchsorted(cells.ids, best["node_id"].to_numpy())] = True
                yield from dealt(batch, chosen & (cells.n_rows > 0), at, bins)

    return asked.mapInArrow(run, dealt_schema(asked))


def index_stats(index: IvfIndex, corpus_rows: int | None = None) -> DataFrame:
    """Rows per cell, empty cells included, and optionally how many rows are not in the index."""
    cells = index.cells().select("cell", "n_rows")
    if corpus_rows is None:
        return cells
    missing = F.lit(corpus_rows) - index.rows_of()
    return cells.withColumn("n_not_indexed", missing.cast("long"))


def index_summary(index: IvfIndex) -> DataFrame:
    """Totals over the cells, as one row."""
    return index_stats(index).agg(
        F.count("*").alias("n_cells"),
        F.sum("n_rows").alias("n_rows"),
        F.min("n_rows").alias("min_rows"),
        F.max("n_rows").alias("max_rows"),
        F.count_if(F.col("n_rows") == 0).alias("n_empty"),
    )


def rebuild_index(index: IvfIndex, corpus: DataFrame, path: str, **options) -> IvfIndex:
    """A new index with fresh centroids over the current rows, written beside the old one."""
    info = index.info().first()
    options = {"metric": info["metric_type"], "max_iter": info["max_iter"], "n_cells": info["n_cells"], **options}
    return build_index(corpus, path, index_name=info["index_name"], **options)


def index_health(
    index: IvfIndex,
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 10,
    probes: Sequence[int] = (1, 4, 8),
    qid: str = "qid",
    query_embedding: str = "embedding",
) -> DataFrame:
    """Recall against the exact search and the share of rows visited, by number of probes."""
    info = index.info().first()
    exact = nearest_join(corpus, queries, k, info["metric_type"], qid=qid, query_embedding=query_embedding)
    path = scratch_path(index.spark, "truth")
    exact.select(F.col(qid).alias("query_id"), "node_id").write.parquet(path)
    asked = queries.select(F.col(qid).alias("query_id"), F.col(query_embedding).alias("vector"))
    curve = recall_curve(index, index.spark.read.parquet(path), asked)
    # More probes than cells read all cells.
    most = curve.count()
    wanted = [(p, min(check_count(p, "probes"), most)) for p in sorted(set(probes))]
    known = curve.withColumnRenamed("probes", "read")
    report = small_frame(index.spark, wanted, "probes int, read int").join(known, "read")
    about = ["index_name", "algorithm", "metric_type", "dimension", "n_cells"]
    return report.select(*[F.lit(info[c]).alias(c) for c in about], "probes", "recall", "visited_share")

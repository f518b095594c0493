"""Search among rows that lie in cells around centroids, with a bound for what a cell can hold.

A cell has a radius: no row in it is farther from its centroid.  By the triangle inequality a row of the cell is
at least the distance of query and centroid, less the radius, away from the query.  A search visits the nearest
cells until they hold ``k`` rows, which gives a ``k``-th distance; then all other cells whose bound does not pass
it.  What is left unread cannot hold an answer, so the result is that of the exact join.

Distances between directions are angles under cosine.  Under inner product the bound is that of Cauchy and Schwarz.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.operators.kernel import lengths_of, matrix
from nearspan.operators.knn import (
    MAX_SENT_QUERIES,
    PART_QUERIES,
    check_queries,
    every,
    gather_queries,
    keep_nearest,
    meet_in_parts,
    parts_of_rows,
    scan_with_queries,
    turn_of,
)
from nearspan.session import scratch_path, small_frame

MAX_CENTROID_BYTES = 256 << 20
MATRIX_CELLS = 4_000_000
# Bounds give way by this much, relative to the vectors' lengths, so that rounding never hides a row.
SLACK = 1e-9
ANGLE_SLACK = 1e-6


@dataclass(frozen=True)
class CellSet:
    """Centroids, rows and radius of the cells; on the driver, at most ``MAX_CENTROID_BYTES`` of centroids."""

    ids: np.ndarray
    centres: np.ndarray
    n_rows: np.ndarray
    radius: np.ndarray
    metric: str

    @property
    def total(self) -> int:
        return int(self.n_rows.sum())

    def gaps(self, queries: np.ndarray) -> np.ndarray:
        """How far each query is from each centroid: an angle, a distance or a product; NaN if undefined."""
        a, b = queries.astype(np.float64), self.centres.astype(np.float64)
        product = a @ b.T
        if self.metric == "inner_product":
            return -product
        if self.metric == "euclidean":
            squares = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * product
            return np.sqrt(np.maximum(squares, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.outer(lengths_of(a), lengths_of(b))
            return np.arccos(np.clip(np.where(scale > 0, product / scale, np.nan), -1, 1))

    def bounds(self, queries: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        """The least distance that a row of each cell can have from each query."""
        norms, lengths = lengths_of(queries)[:, None], lengths_of(self.centres)
        if self.metric == "cosine":
            bound = 1 - np.cos(np.maximum(gaps - self.radius - ANGLE_SLACK, 0))
        elif self.metric == "euclidean":
            # The rounding of a difference of squares grows near zero, so the slack is that of its root.
            slack = math.sqrt(SLACK) * (norms + lengths)
            bound = np.where(gaps > slack, gaps - self.radius - SLACK * (norms + lengths + self.radius) - slack * slack / np.maximum(gaps, slack), 0)
        else:
            bound = gaps - norms * self.radius * (1 + SLACK) - SLACK * norms * (lengths + 1)
        return np.where(np.isnan(bound), -np.inf, bound)

    def first(self, gaps: np.ndarray, k: int, probes: int) -> np.ndarray:
        """Which cells each query visits first: the ``probes`` nearest with rows, and on until they hold ``k`` rows."""
        keyed = np.where(np.isnan(gaps), np.inf, gaps)
        order = np.argsort(keyed, axis=1, kind="stable")
        held = self.n_rows[order]
        before = np.cumsum(held, axis=1) - held
        place = np.cumsum(held > 0, axis=1)
        visited = np.zeros(gaps.shape, bool)
        np.put_along_axis(visited, order, (held > 0) & ((before < k) | (place <= probes)), axis=1)
        return visited

    def visits(
        self, queries: np.ndarray, k: int, probes: int, limits: np.ndarray | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of query and cell, by position: the first visits, or with ``limits`` those that come after them."""
        for at, chosen in self.chosen(queries, k, probes, limits):
            query, cell = np.nonzero(chosen)
            yield query + at, cell

    def chosen(
        self, queries: np.ndarray, k: int, probes: int, limits: np.ndarray | None = None
    ) -> Iterator[tuple[int, np.ndarray]]:
        """The same as matrices of queries and cells, each with the position of its first query."""
        step = max(1, MATRIX_CELLS // max(1, len(self.ids)))
        for at in range(0, len(queries), step):
            part = queries[at : at + step]
            gaps = self.gaps(part)
            chosen = self.first(gaps, k, probes)
            if limits is not None:
                near = self.bounds(part, gaps) <= limits[at : at + step, None]
                chosen = near & ~chosen & (self.n_rows > 0)
            yield at, chosen


@dataclass(frozen=True)
class Found:
    """Ranked rows, and per visited cell how many queries visited it."""

    rows: DataFrame
    visits: DataFrame


def gather_cells(table: DataFrame, metric: str) -> CellSet:
    """Cells from rows ``(cell, centroid, n_rows, radius)``."""
    size = table.agg(F.sum(F.size("centroid") * 4)).first()[0]
    if not 0 < (size or 0) <= MAX_CENTROID_BYTES:
        raise ValueError(f"centroids take {size} bytes, a search takes 1 to {MAX_CENTROID_BYTES}")
    rows = table.select("cell", "centroid", "n_rows", "radius").orderBy("cell").toArrow()
    return CellSet(
        rows["cell"].to_numpy().astype(np.int32),
        matrix(rows["centroid"]),
        rows["n_rows"].to_numpy().astype(np.int64),
        rows["radius"].to_numpy().astype(np.float64),
        metric,
    )


def radius_of(gap: Column, metric: str) -> Column:
    """The radius of a cell from the distances of its rows to the centroid; undefined ones don't count."""
    most = F.coalesce(F.max(gap), F.lit(0.0))
    return F.acos(F.greatest(1 - most, F.lit(-1.0))) if metric == "cosine" else most


def search_cells(
    rows: DataFrame,
    cells: CellSet,
    asked: DataFrame,
    k: int,
    probes: int = 1,
    exact: bool = True,
    with_cosine: bool = False,
    max_sent: int = MAX_SENT_QUERIES,
    slice_rows: int | None = None,
    part_queries: int = PART_QUERIES,
) -> Found:
    """The ``k`` nearest of the rows ``(node_id, vector, ..., cell)`` to each query ``(query_id, vector)``.

    ``exact`` goes on behind the first visits until no cell can hold a nearer row.  Without it each query reads its
    ``probes`` nearest cells, and more until they hold ``k`` rows.
    """
    spark = rows.sparkSession
    sent = gather_queries(asked, max_sent)
    if sent is not None:
        return _search_sent(rows, cells, sent, asked.schema["query_id"].dataType, k, probes, exact, with_cosine)
    dim = check_queries(asked)
    bins = bins_of(cells, dim, slice_rows, spark.sparkContext.defaultParallelism)
    options = (k, cells.metric, with_cosine, dim, part_queries)
    first, visits = meet_cells(rows, _visiting(asked, cells, bins, k, probes), cells, bins, *options)
    found = keep_nearest(first, k)
    if exact:
        found = _written(found)
        last = found.where(F.col("rank") == k).select("query_id", F.col("distance").alias("limit"))
        more = _visiting(asked.join(last, "query_id", "left"), cells, bins, k, probes, True)
        others, further = meet_cells(rows, more, cells, bins, *options)
        found = keep_nearest(found.drop("rank").unionByName(others), k)
        visits = visits + further
    counts = [(int(c), int(n)) for c, n in zip(cells.ids, visits) if n]
    visited = small_frame(spark, counts, "cell int, n_queries long")
    return Found(found, visited.join(F.broadcast(_sizes(spark, cells)), "cell"))


def _search_sent(rows, cells: CellSet, sent: pa.Table, id_type, k, probes, exact, with_cosine) -> Found:
    spark = rows.sparkSession
    vectors = matrix(sent["vector"]) if sent.num_rows else np.zeros((0, cells.centres.shape[1]), np.float32)
    first = _by_cell(cells, cells.visits(vectors, k, probes))
    found = keep_nearest(_scan(rows, sent, id_type, k, cells, with_cosine, first), k)
    counts = {cell: len(members) for cell, members in first.items()}
    if exact and sent.num_rows:
        found = _written(found)
        limits = np.full(sent.num_rows, np.inf)
        place = {value: i for i, value in enumerate(sent["query_id"].to_pylist())}
        for row in found.where((F.col("rank") == k) & F.col("distance").isNotNull()).select("query_id", "distance").collect():
            limits[place[row["query_id"]]] = row["distance"]
        more = _by_cell(cells, cells.visits(vectors, k, probes, limits))
        if more:
            others = _scan(rows, sent, id_type, k, cells, with_cosine, more)
            found = keep_nearest(found.drop("rank").unionByName(others), k)
        for cell, members in more.items():
            counts[cell] = counts.get(cell, 0) + len(members)
    visits = small_frame(spark, sorted(counts.items()), "cell int, n_queries long")
    return Found(found, visits.join(F.broadcast(_sizes(spark, cells)), "cell"))


def _sizes(spark, cells: CellSet) -> DataFrame:
    return small_frame(spark, zip(cells.ids.tolist(), cells.n_rows.tolist()), "cell int, n_rows long")


def _written(found: DataFrame) -> DataFrame:
    """The ranked rows of the first visits, at most ``k`` per query, written to the shared folder."""
    path = scratch_path(found.sparkSession, "visits")
    found.write.parquet(path)
    return found.sparkSession.read.schema(found.schema).parquet(path)


def _by_cell(cells: CellSet, visits) -> dict[int, np.ndarray]:
    """Per cell the positions of the queries that visit it."""
    parts = list(visits)
    query = np.concatenate([q for q, _ in parts]) if parts else np.zeros(0, np.int64)
    cell = np.concatenate([c for _, c in parts]) if parts else np.zeros(0, np.int64)
    order = np.lexsort((query, cell))
    query, cell = query[order], cell[order]
    number, start = np.unique(cell, return_index=True)
    return {int(cells.ids[n]): part for n, part in zip(number, np.split(query, start[1:]))}


def _scan(rows, sent, id_type, k, cells: CellSet, with_cosine, wanted) -> DataFrame:
    # Cells that nobody visits are not read; a list of most cells would only burden the plan.
    needed = rows if 2 * len(wanted) > len(cells.ids) else rows.where(F.col("cell").isin(sorted(wanted)))
    return scan_with_queries(needed, sent, id_type, k, cells.metric, with_cosine, wanted)


@dataclass(frozen=True)
class Bins:
    """Cells side by side, cut into bins of about as many rows: the bins and the places of the cells in each.

    A cell whose rows pass the end of a bin has rows in the next one, too, dealt by the id.
    """

    first: np.ndarray
    count: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def bins_of(cells: CellSet, dim: int, slice_rows: int | None, cores: int) -> Bins:
    """As many bins as :func:`parts_of_rows` says; by position the first bin of each cell and the number of its bins."""
    n_bins = parts_of_rows(cells.total, dim, slice_rows, cores)
    held = np.maximum(cells.n_rows, 0)
    after = np.cumsum(held)
    room = max(1, math.ceil(int(held.sum()) / n_bins))
    first = np.minimum((after - held) // room, n_bins - 1)
    last = np.minimum(np.maximum(first, (after - 1) // room), n_bins - 1)
    begin = np.searchsorted(last, np.arange(n_bins), "left")
    end = np.searchsorted(first, np.arange(n_bins), "right")
    return Bins(first, last - first + 1, begin, end)


def dealt(batch: pa.RecordBatch, chosen: np.ndarray, at: int, bins: Bins) -> Iterator[pa.RecordBatch]:
    """Queries from position ``at`` on, once for each bin with a chosen cell, with a map of the bin's cells."""
    for number, (begin, end) in enumerate(zip(bins.begin, bins.end)):
        own = chosen[:, begin:end]
        query = np.flatnonzero(own.any(axis=1))
        for start in range(0, len(query), 10_000):
            some = query[start : start + 10_000]
            maps = np.packbits(own[some], axis=1)
            ends = np.arange(len(some) + 1, dtype=np.int32) * maps.shape[1]
            marks = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(maps.tobytes())])
            part = batch.select(["query_id", "vector"]).take(pa.array(some + at))
            bin_ = pa.array(np.full(len(some), number, np.int32))
            yield pa.RecordBatch.from_arrays([*part.columns, bin_, marks], names=["query_id", "vector", "bin", "visited"])


def dealt_schema(asked: DataFrame) -> T.StructType:
    return T.StructType([asked.schema["query_id"], asked.schema["vector"]]).add("bin", "integer").add("visited", "binary")


def _visiting(asked: DataFrame, cells: CellSet, bins: Bins, k: int, probes: int, further: bool = False) -> DataFrame:
    """Rows ``(query_id, vector, bin, visited)`` for the visits of all queries, without a shuffle."""
    payload = asked.sparkSession.sparkContext.broadcast((cells, bins))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, bins = payload.value
        for batch in batches:
            if not batch.num_rows:
                continue
            limits = None
            if further:
                limits = batch.column("limit").fill_null(np.inf).to_numpy(zero_copy_only=False)
            for at, chosen in cells.chosen(matrix(batch.column("vector"), cells.centres.shape[1]), k, probes, limits):
                yield from dealt(batch, chosen, at, bins)

    return asked.mapInArrow(run, dealt_schema(asked))


def _visits(met: DataFrame, cells: CellSet, bins: Bins) -> tuple[np.ndarray, np.ndarray]:
    """How many queries visit each bin and each cell; a task sends one row per bin and cell in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            number = batch.column("bin").to_numpy()
            for one in np.unique(number).tolist():
                maps = batch.column("visited").filter(pa.array(number == one)).to_pylist()
                bits = np.unpackbits(np.frombuffer(b"".join(maps), np.uint8).reshape(len(maps), -1), axis=1)
                total[one] = total.get(one, 0) + np.r_[len(maps), bits.sum(axis=0, dtype=np.int64)]
        for one, sums in total.items():
            yield pa.record_batch(
                {
                    "bin": pa.array(np.full(len(sums), one, np.int32)),
                    "spot": pa.array(np.arange(-1, len(sums) - 1, dtype=np.int32)),
                    "n": pa.array(sums),
                }
            )

    sums = met.select("bin", "visited").mapInArrow(run, "bin int, spot int, n bigint").groupBy("bin", "spot")
    table = sums.agg(F.sum("n").alias("n")).toArrow()
    bin_, spot, n = (table[c].to_numpy() for c in ("bin", "spot", "n"))
    asking, visits = np.zeros(len(bins.begin), np.int64), np.zeros(len(cells.ids), np.int64)
    asking[bin_[spot < 0]] = n[spot < 0]
    place = bins.begin[bin_] + spot
    # Bits beyond the last cell are never set; a cell in several bins counts in its first.
    counts = (spot >= 0) & (place < bins.end[bin_])
    counts[counts] = bins.first[place[counts]] == bin_[counts]
    visits[place[counts]] = n[counts]
    return asking, visits


def meet_cells(
    rows: DataFrame,
    met: DataFrame,
    cells: CellSet,
    bins: Bins,
    k: int,
    metric: str,
    with_cosine: bool,
    dim: int,
    part_queries: int,
) -> tuple[DataFrame, np.ndarray]:
    """Best ``k`` rows per query and part, for queries ``(query_id, vector, bin, visited)``; and the visits by cell.

    A query is sent once to each bin that has one of its cells, not to each cell.  A bin with many queries is cut into
    blocks of them, which all meet its rows, each in a part of its own.  One row per cell reaches the driver.
    """
    spark = rows.sparkSession
    asking, visits = _visits(met, cells, bins)
    blocks = -(-asking // part_queries)
    first_part = np.cumsum(blocks) - blocks
    used = np.flatnonzero(visits)
    homes = small_frame(
        spark,
        zip(*(x[used].tolist() for x in (cells.ids, np.arange(len(cells.ids)), bins.first, bins.count))),
        "cell int, place int, first_bin long, bins long",
    )
    numbers = np.flatnonzero(blocks)
    plan = small_frame(
        spark, zip(*(x[numbers].tolist() for x in (np.arange(len(blocks)), bins.begin, first_part, blocks))),
        "bin int, begin int, first_part long, blocks long",
    )
    home = (F.col("first_bin") + turn_of("node_id", F.col("bins"))).cast("int")
    cut = rows.join(F.broadcast(homes), "cell").withColumn("bin", home).join(F.broadcast(plan), "bin")
    cut = cut.withColumn("block", every(F.col("blocks"))).withColumn("part", F.col("first_part") + F.col("block"))
    cut = cut.withColumn("spot", F.col("place") - F.col("begin"))
    cut = cut.drop("cell", "place", "first_bin", "bins", "bin", "begin", "first_part", "blocks", "block")
    spread = met.join(F.broadcast(plan), "bin")
    spread = spread.withColumn("part", F.col("first_part") + turn_of("query_id", F.col("blocks")))
    spread = spread.select("query_id", "vector", "part", "visited")
    return meet_in_parts(cut, spread, max(int(blocks.sum()), 1), k, metric, with_cosine, dim), visits


def cell_ranks(truth: DataFrame, cells: CellSet) -> DataFrame:
    """For rows ``(vector, cell)`` of a query and the cell of one of its true neighbours: the cell's place in the
    query's order of cells, from 1, as the column ``place``."""
    payload = truth.sparkSession.sparkContext.broadcast(cells)
    schema = T.StructType([*(f for f in truth.schema.fields if f.name != "vector"), T.StructField("place", T.IntegerType())])
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = payload.value
        for batch in batches:
            if not batch.num_rows:
                continue
            wanted = np.searchsorted(cells.ids, batch.column("cell").to_numpy())
            place = np.zeros(batch.num_rows, np.int32)
            step = max(1, MATRIX_CELLS // len(cells.ids))
            vectors = matrix(batch.column("vector"), cells.centres.shape[1])
            for at in range(0, batch.num_rows, step):
                place[at : at + step] = places(cells, vectors[at : at + step])[
                    np.arange(len(wanted[at : at + step])), wanted[at : at + step]
                ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(place)], names=schema.names)

    return truth.mapInArrow(run, schema)


def places(cells: CellSet, queries: np.ndarray) -> np.ndarray:
    """Place of each cell in each query's order, from 1; equal gaps go by cell."""
    gaps = cells.gaps(queries)
    order = np.argsort(np.where(np.isnan(gaps), np.inf, gaps), axis=1, kind="stable")
    out = np.zeros(gaps.shape, np.int32)
    np.put_along_axis(out, order, np.arange(1, gaps.shape[1] + 1, dtype=np.int32)[None, :], axis=1)
    return out


def rows_by_probes(asked: DataFrame, cells: CellSet) -> DataFrame:
    """Rows that all queries together read, by number of probes: ``(probes, n_rows)``.  A task sends one row per cell."""
    payload = asked.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = payload.value
        total = np.zeros(len(cells.ids), np.int64)
        for batch in batches:
            vectors = matrix(batch.column("vector"), cells.centres.shape[1]) if batch.num_rows else np.zeros((0, 1))
            step = max(1, MATRIX_CELLS // len(cells.ids))
            for at in range(0, len(vectors), step):
                place = places(cells, vectors[at : at + step])
                held = np.zeros(place.shape, np.int64)
                np.put_along_axis(held, place - 1, np.broadcast_to(cells.n_rows, place.shape), axis=1)
                total += np.cumsum(held, axis=1).sum(axis=0)
        yield pa.record_batch({"probes": pa.array(np.arange(1, len(total) + 1, dtype=np.int32)), "n_rows": pa.array(total)})

    sums = asked.select("vector").mapInArrow(run, "probes int, n_rows bigint")
    return sums.groupBy("probes").agg(F.sum("n_rows").alias("n_rows"))

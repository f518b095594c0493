"""Compressed codes of an index's rows: residual product quantisation and exact re-ranking.

A row's difference from its centroid is cut into subspaces, each replaced by the nearest of 256 learnt vectors.  A
search reads the codes in place of the vectors: what they stand for gives the distance to every coded row by products.
Codes keep how far off they are, so each distance gives bounds, too.  An exact search takes the k-th distance of every
query in the few cells nearest to it, and finds in one pass over the codes the rows that may lie below that of any query
and which queries may have such rows in which cells; only these rows meet their vectors, and only those queries.  A cell
of which the bounds admit most rows is read whole.  Pairs of query and row are never listed, and a row that is admitted
meets no more bounds than show it.  An approximate search re-ranks a fixed number of rows per query.

Rows without a defined distance, and rows with values that are not finite, are re-ranked by the exact search always.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.functions.distance import distance
from nearspan.operators.cells import CellSet, _by_cell, bins_of, gather_cells
from nearspan.operators.ivf import IvfIndex, _gather_centroids, unit
from nearspan.operators.kernel import UNIT, Block, NearestRows, lengths_of, matrix
from nearspan.operators.knn import (
    MAX_SENT_QUERIES,
    finish,
    gather_queries,
    keep_nearest,
    nearest_join,
    scan_with_queries,
    turn_of,
)
from nearspan.operators.sizing import broadcast_if_small
from nearspan.schema import check_count
from nearspan.session import scratch_path, small_frame

CODES = 256
# The learnt vectors come from about this many rows, chosen by hash; every row is coded.
FIT_ROWS = 65_536
FIT_ROUNDS = 10
CALIBRATION_ROWS = 500
QUERY_CHUNK = 256
# Relative slack of the bounds, far above the rounding of single-precision vectors.
SLACK = 1e-6
# An exact search sends queries of about so many bytes at once, and no fewer than a scan does.
SENT_BYTES = 12 << 20
# The first limit of a query comes from so many of its nearest cells, and more until they hold k rows.
FIRST_CELLS = 8
# So many rows of a cell meet all queries before the others meet those that none of them admits.
FEW_ROWS = 32
PRODUCT_CELLS = 1_000_000
# Numbers beyond this may overflow in single precision; what has them is admitted.
HUGE = 1e17


@dataclass(frozen=True)
class CodedIndex:
    """The codes of an index at ``path``: ``rows`` (cell, node_id, code, term, error) and ``books``."""

    index: IvfIndex
    path: str

    @property
    def spark(self) -> SparkSession:
        return self.index.spark

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def books(self) -> list[np.ndarray]:
        """Per subspace the learnt vectors; 256 numbers per dimension in all."""
        table = self.spark.read.parquet(f"{self.path}/books").orderBy("subspace").collect()
        return [np.array(r["book"], np.float64).reshape(-1, r["width"]) for r in table]

    def assert_current(self) -> None:
        """Codes stand for the rows of the index when they were written."""
        written = self.spark.read.parquet(f"{self.path}/info").first()["n_changes"]
        if written != len(self.index.deltas()):
            raise ValueError("the index has changed since its codes were written: build them anew")


def build_codes(index: IvfIndex, path: str, subspaces: int | None = None, fit_rows: int = FIT_ROWS, seed: int = 7) -> CodedIndex:
    """Write the codes of all rows of an index; by default a byte stands for four dimensions."""
    spark, info = index.spark, index.info().first()
    dim, metric = info["dimension"], info["metric_type"]
    subspaces = min(dim, check_count(subspaces or max(1, dim // 4), "subspaces"))
    check_count(fit_rows, "fit_rows")
    shared = spark.sparkContext.broadcast(_gather_centroids(index.centroids()))
    edges = [int(part[0]) for part in np.array_split(np.arange(dim), subspaces)] + [dim]
    rows = index.rows().select("cell", "node_id", unit("embedding", metric).alias("vector"))

    def residuals(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Difference from the centroid, and the centroid; undefined rows are not finite."""
        cells, centres = shared.value
        centre = centres.astype(np.float64)[np.searchsorted(cells, batch.column("cell").to_numpy())]
        vectors = matrix(batch.column("vector"), dim).astype(np.float64)
        if metric == "cosine":
            vectors = np.where((vectors != 0).any(axis=1)[:, None], vectors, np.nan)
        return vectors - centre, centre

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = residuals(batch)[0]
            rest = rest[np.isfinite(rest).all(axis=1)]
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                number = pa.array(np.full(len(rest), i, np.int32))
                yield pa.RecordBatch.from_arrays([number, pa.array(list(rest[:, a:b]), pa.list_(pa.float64()))], ["subspace", "part"])

    def learn(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        book = _learn(np.stack(group["part"].to_numpy()), seed + int(key[0]))
        return pd.DataFrame({"subspace": [key[0]], "width": [book.shape[1]], "book": [book.reshape(-1)]})

    share = max(1, -(-index.rows_of() // fit_rows))
    sample = rows.where(F.pmod(F.xxhash64("node_id"), F.lit(share)) == 0) if share > 1 else rows
    parts = sample.mapInArrow(cut, "subspace int, part array<double>")
    parts.groupBy("subspace").applyInPandas(learn, "subspace int, width int, book array<double>").write.parquet(f"{path}/books")
    coded = CodedIndex(index, path)
    books = coded.books()
    if not books:
        raise ValueError("codes need rows with finite embeddings")
    learnt = spark.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rest, centre = residuals(batch)
            sound = np.isfinite(rest).all(axis=1)
            rest = np.where(sound[:, None], rest, 0.0)
            codes = np.stack([_nearest(rest[:, a:b], book) for a, b, book in zip(edges, edges[1:], learnt.value)], axis=1)
            near = np.concatenate([book[codes[:, i]] for i, book in enumerate(learnt.value)], axis=1)
            term = (near * near).sum(axis=1) + 2 * (centre * near).sum(axis=1)
            error = np.nextafter(np.sqrt(((rest - near) ** 2).sum(axis=1)).astype(np.float32), np.float32(np.inf))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node_id"),
                    pa.array([row.tobytes() for row in codes.astype(np.uint8)], pa.binary()),
                    pa.array(np.where(sound, term, np.nan)),
                    pa.array(error),
                    batch.column("cell"),
                ],
                ["node_id", "code", "term", "error", "cell"],
            )

    id_type = rows.schema["node_id"].dataType.simpleString()
    schema = f"node_id {id_type}, code binary, term double, error float, cell int"
    rows.mapInArrow(encode, schema).write.parquet(f"{path}/rows")
    info = small_frame(spark, [(subspaces, len(index.deltas()))], "subspaces int, n_changes int")
    info.coalesce(1).write.parquet(f"{path}/info")
    return coded


def _learn(points: np.ndarray, seed: int) -> np.ndarray:
    """At most 256 vectors by k-means, the same for any order of the points."""
    points = points[np.lexsort(points.T[::-1])]
    distinct = np.unique(points, axis=0)
    if len(distinct) <= CODES:
        return distinct
    book = distinct[np.sort(np.random.default_rng(seed).choice(len(distinct), CODES, replace=False))]
    for _ in range(FIT_ROUNDS):
        home = _nearest(points, book)
        counts = np.bincount(home, minlength=CODES)
        sums = np.stack([np.bincount(home, points[:, d], CODES) for d in range(points.shape[1])], axis=1)
        book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
    return book


def _nearest(points: np.ndarray, book: np.ndarray, size: int = 8192) -> np.ndarray:
    weight = (book * book).sum(axis=1)
    found = [(weight - 2 * points[at : at + size] @ book.T).argmin(axis=1) for at in range(0, len(points), size)]
    return np.concatenate([np.zeros(0, np.int64), *found])


class _Queries:
    """What a task knows of the queries, and of what the codes stand for."""

    def __init__(self, queries: np.ndarray, books: list[np.ndarray], cells: np.ndarray, centres: np.ndarray, metric: str):
        self.metric, self.cells, self.books = metric, cells, books
        self.centres = centres.astype(np.float64)
        queries = queries.astype(np.float64)
        length = np.sqrt((queries * queries).sum(axis=1))
        if metric == "cosine":
            with np.errstate(divide="ignore", invalid="ignore"):
                queries = np.where(length[:, None] > 0, queries / length[:, None], np.nan)
            length = np.where(length > 0, 1.0, np.nan)
        self.queries, self.length, self.centre_square = queries, length, (self.centres * self.centres).sum(axis=1)

    def __len__(self) -> int:
        return len(self.queries)

    def bounds(self, batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """For some queries after others: distance of each to each coded row, and by how much the row's own may differ.

        Not finite if unknown.
        """
        codes = batch.column("code")
        ends = np.frombuffer(codes.buffers()[1], np.int32)[codes.offset : codes.offset + len(codes) + 1]
        codes = np.frombuffer(codes.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(codes), -1)
        cell = np.searchsorted(self.cells, batch.column("cell").to_numpy())
        term, error = batch.column("term").to_numpy(), batch.column("error").to_numpy().astype(np.float64)
        near = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], axis=1) + self.centres[cell]
        square = self.centre_square[cell] + term
        size = np.sqrt(np.maximum(square, 0))
        for at in range(0, len(self), QUERY_CHUNK):
            some = slice(at, at + QUERY_CHUNK)
            length = self.length[some][:, None]
            with np.errstate(invalid="ignore", over="ignore"):
                product = self.queries[some] @ near.T
                if self.metric == "euclidean":
                    gap = np.sqrt(np.maximum(length**2 + square - 2 * product, 0))
                    # The square root of a rounded difference is off by the root of the rounding.
                    yield some, gap, error + SLACK * (length + size)
                else:
                    # An undefined row makes the product undefined, too.
                    yield some, term * 0 - product, length * (error + SLACK * (size + error + 1))


def _shared(coded: CodedIndex, sent: pa.Table):
    metric = coded.index.info().first()["metric_type"]
    known = (matrix(sent["vector"]), coded.books(), *_gather_centroids(coded.index.centroids()), metric)
    return coded.spark.sparkContext.broadcast(known)


def _lower(gap: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.where(np.isfinite(gap) & np.isfinite(off), gap - off, -np.inf)


def _scan(coded: CodedIndex, sent: pa.Table, limit: int, upper: bool, most: np.ndarray | None = None) -> DataFrame:
    """``asked, node_id, cell, distance`` of coded rows, ``asked`` being the query's number.

    Without ``most`` those that may be among the ``limit`` least of a query by distance, or by its upper bound; with it
    all whose lower bound is at most the query's.
    """
    payload = _shared(coded, sent)
    rows = coded.rows().select("node_id", F.col("code"), "term", "error", "cell")
    schema = T.StructType().add("asked", "integer").add(rows.schema["node_id"]).add("cell", "integer").add("distance", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = _Queries(*payload.value)
        best = np.full((len(queries) if most is None else 0, limit), np.inf)
        for batch in batches:
            for some, gap, off in queries.bounds(batch) if batch.num_rows else ():
                if most is None:
                    known = np.isfinite(gap) & np.isfinite(off)
                    value = np.where(known, gap + off if upper else gap, np.inf)
                    joined = np.concatenate([best[some], value], axis=1)
                    best[some] = np.partition(joined, limit - 1, axis=1)[:, :limit]
                    hit = value <= best[some].max(axis=1)[:, None]
                else:
                    value = _lower(gap, off)
                    hit = value <= most[some][:, None]
                asked, row = np.nonzero(hit)
                picked = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((asked + some.start).astype(np.int32)),
                        batch.column("node_id").take(picked),
                        batch.column("cell").take(picked),
                        pa.array(value[asked, row]),
                    ],
                    schema.names,
                )

    return rows.mapInArrow(run, schema)


@dataclass(frozen=True)
class _Known:
    """What every block of queries of a search shares; the index is listed and its centroids are gathered once."""

    cells: CellSet
    vectors: DataFrame
    codes: DataFrame
    learnt: Broadcast

    @staticmethod
    def of(coded: CodedIndex) -> _Known:
        index, spark = coded.index, coded.spark
        info = index.info().first()
        cells = gather_cells(index.cells(), info["metric_type"])
        vectors = index.rows().select("cell", "node_id", F.col("embedding").alias("vector"))
        # Each task has cells of its own, about as many rows as the others; a large cell is cut.
        bins = bins_of(cells, info["dimension"], None, 2 * spark.sparkContext.defaultParallelism)
        numbers = zip(cells.ids.tolist(), bins.first.tolist(), bins.count.tolist())
        homes = small_frame(spark, numbers, "cell int, first_bin long, bins long")
        codes = coded.rows().select("node_id", "code", "term", "error", "cell").join(F.broadcast(homes), "cell")
        home = (F.col("first_bin") + turn_of("node_id", F.col("bins"))).cast("int")
        codes = codes.repartitionById(len(bins.begin), home).drop("first_bin", "bins").sortWithinPartitions("cell")
        learnt = spark.sparkContext.broadcast((coded.books(), cells.ids, cells.centres.astype(np.float64)))
        return _Known(cells, vectors, codes, learnt)


def _first_visits(cells: CellSet, queries: np.ndarray, k: int) -> dict[int, np.ndarray]:
    """Per cell the queries that it is among the nearest of, which hold ``k`` rows if there are so many."""
    held = np.flatnonzero(cells.n_rows > 0)
    if not len(held):
        return {}
    probes = min(FIRST_CELLS, len(held))
    near = NearestRows(queries, probes, cells.metric)
    near.offer(Block(cells.centres[held], pa.table({"node_id": pa.array(held)}), probes, cells.metric))
    query, cell = near.best["query"].to_numpy(), near.best["node_id"].to_numpy()
    rows = np.bincount(query, cells.n_rows[cell], len(queries))
    short = np.flatnonzero(rows < k)
    enough = rows[query] >= k
    pairs = [(query[enough], cell[enough]), *((short[q], c) for q, c in cells.visits(queries[short], k, probes))]
    return _by_cell(cells, pairs)


def _limits(coded: CodedIndex, sent: pa.Table, k: int, known: _Known | None = None) -> np.ndarray:
    """No less than the k-th distance of each query, in the numbers of ``_Queries.bounds``; infinite if not known.

    It is the k-th distance to the rows of the query's nearest cells.
    """
    known = known or _Known.of(coded)
    cells = known.cells
    asked = pa.table({"query_id": np.arange(sent.num_rows, dtype=np.int32), "vector": sent["vector"]})
    first = _first_visits(cells, matrix(sent["vector"]), k)
    rows = known.vectors if 2 * len(first) > len(cells.ids) else known.vectors.where(F.col("cell").isin(sorted(first)))
    met = scan_with_queries(rows, asked, T.IntegerType(), k, cells.metric, False, first)
    last = keep_nearest(met, k).where((F.col("rank") == k) & F.col("distance").isNotNull()).select("query_id", "distance").toArrow()
    most = np.full(sent.num_rows, np.inf)
    most[last["query_id"].to_numpy()] = last["distance"].to_numpy() - (cells.metric == "cosine")
    return most


class _Asking(Mapping):
    """Per cell the positions of some queries, kept as a bit per query."""

    def __init__(self, bits: dict[int, np.ndarray], count: int):
        self.bits, self.count = bits, count

    def __getitem__(self, cell: int) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.bits[cell], count=self.count))

    def __contains__(self, cell: object) -> bool:
        return cell in self.bits

    def __iter__(self) -> Iterator[int]:
        return iter(self.bits)

    def __len__(self) -> int:
        return len(self.bits)


class _Test:
    """Whether a query's limit admits coded rows, by one product in single precision with all its rounding allowed for.

    A row at ``near``, give or take ``error``, is admitted when a query's ``left @ right`` is at most its ``top``.
    Under Euclidean distance that is ``|query - near| <= limit + error``, squared and sorted by what each side knows.
    Queries without a finite limit admit every row.
    """

    def __init__(self, queries: np.ndarray, most: np.ndarray, metric: str):
        queries = queries.astype(np.float64)
        with np.errstate(invalid="ignore", over="ignore", divide="ignore"):
            length = lengths_of(queries)
            if metric == "cosine":
                queries = np.where(length[:, None] > 0, queries / length[:, None], np.nan)
                length = np.where(length > 0, 1.0, np.nan)
            sound = (length < HUGE) & (np.abs(most) < HUGE) & np.isfinite(queries).all(axis=1)
        queries, length, most = (np.where(sound.reshape(-1, *[1] * (x.ndim - 1)), x, 0.0) for x in (queries, length, most))
        self.metric, self.slack = metric, 4 * (queries.shape[1] + 16) * UNIT + 4 * SLACK
        if metric == "euclidean":
            parts = [-2 * queries, -2 * most[:, None], np.ones((len(queries), 1))]
            top = most**2 - length**2 + 2 * self.slack * (length + most) ** 2
        else:
            parts = [-queries, -length[:, None]]
            top = most + self.slack * np.abs(most)
        self.left = np.concatenate(parts, axis=1).astype(np.float32)
        # The number added is above what is lost where products are too small for single precision.
        self.top = np.where(sound, np.nextafter((top + 1e-36).astype(np.float32), np.float32(np.inf)), np.float32(np.inf))

    def right(self, near: np.ndarray, error: np.ndarray) -> np.ndarray:
        size = lengths_of(near)
        if self.metric != "euclidean":
            return np.concatenate([near, (error + self.slack * (size + error + 1))[:, None]], axis=1).astype(np.float32)
        rest = size**2 - error**2 - 2 * self.slack * (size + error) ** 2
        return np.concatenate([near, error[:, None], rest[:, None]], axis=1).astype(np.float32)

    def admits(self, queries: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.left[queries] @ right.T <= self.top[queries][:, None]

    def mark(self, right: np.ndarray, able: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Mark the queries, of those ``able``, that admit any of a cell's rows; which rows any of them admits.

        A query that is marked meets only rows that are not yet admitted.
        """
        wanted = np.zeros(len(right), bool)
        few = np.unique(np.linspace(0, len(right) - 1, FEW_ROWS).astype(int))
        marked, todo = able[marks[able]], able[~marks[able]]
        for rows in (few, np.arange(len(right)))[: 2 if len(few) < len(right) else 1]:
            step = max(1, PRODUCT_CELLS // len(rows))
            for at in range(0, len(todo), step):
                hit = self.admits(todo[at : at + step], right[rows])
                marks[todo[at : at + step]] = hit.any(axis=1)
                wanted[rows] |= hit.any(axis=0)
            if rows is few and len(few) < len(right):
                marked, todo = np.r_[marked, todo[marks[todo]]], todo[~marks[todo]]
        rest, at, step = np.flatnonzero(~wanted), 0, 64
        while len(rest) and at < len(marked):
            hit = self.admits(marked[at : at + step], right[rest]).any(axis=0)
            wanted[rest[hit]] = True
            rest, at = rest[~hit], at + step
            step = min(4 * step, max(64, PRODUCT_CELLS // max(1, len(rest))))
        return wanted


def _admitted(
    coded: CodedIndex, sent: pa.Table, most: np.ndarray, known: _Known | None = None
) -> tuple[DataFrame, Mapping[int, np.ndarray]]:
    """The rows ``(cell, node_id)`` with a lower bound of at most that of any query; per cell the queries with such rows.

    One map of the queries per cell and task reaches the driver.
    """
    known = known or _Known.of(coded)
    learnt = known.learnt
    payload = coded.spark.sparkContext.broadcast(_Test(matrix(sent["vector"]), most, known.cells.metric))
    schema = T.StructType().add("cell", "integer").add(known.codes.schema["node_id"]).add("asking", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = payload.value
        asking: dict[int, np.ndarray] = {}
        id_type = None

        def maps(of: list[int]) -> Iterator[pa.RecordBatch]:
            for cell in of:
                if (marks := asking.pop(cell)).any():
                    bits = pa.array([np.packbits(marks).tobytes()])
                    yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.nulls(1, id_type), bits], schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.column("node_id").type
            cells, starts = np.unique(batch.column("cell").to_numpy(), return_index=True)
            # Rows come by cell: those of all cells but the last of a batch have been met.
            yield from maps([c for c in asking if c < cells[0]])
            near, centre, error, sound = _decoded(batch, *learnt.value)
            reach = lengths_of(near - centre) + error
            right, wanted = test.right(near, error), ~sound
            ends = np.r_[starts[1:], batch.num_rows]
            rows = [np.arange(a, b)[sound[a:b]] for a, b in zip(starts, ends)]
            # No row of a cell is nearer than its centroid, less how far the farthest is from that.
            radius = np.array([reach[r].max(initial=0.0) for r in rows]) * (1 + SLACK)
            whole = test.right(centre[starts], radius)
            for i, cell in enumerate(cells.tolist()):
                marks = asking.setdefault(cell, np.zeros(len(test.top), bool))
                if len(rows[i]):
                    able = np.flatnonzero(test.admits(slice(None), whole[i : i + 1]))
                    wanted[rows[i]] = test.mark(right[rows[i]], able, marks)
                if len(rows[i]) < ends[i] - starts[i]:
                    marks[:] = True
            kept = batch.filter(pa.array(wanted))
            none = pa.nulls(kept.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([kept.column("cell"), kept.column("node_id"), none], schema.names)
        yield from maps(list(asking))

    path = scratch_path(coded.spark, "admitted")
    known.codes.mapInArrow(run, schema).write.parquet(path)
    payload.destroy()
    written = coded.spark.read.schema(schema).parquet(path)
    bits: dict[int, np.ndarray] = {}
    table = written.where("asking IS NOT NULL").select("cell", "asking").toArrow()
    for cell, marks in zip(table["cell"].to_pylist(), table["asking"].to_pylist()):
        bits[cell] = bits.get(cell, 0) | np.frombuffer(marks, np.uint8)
    return written.where("asking IS NULL").select("cell", "node_id"), _Asking(bits, sent.num_rows)


def _decoded(batch: pa.RecordBatch, books: list[np.ndarray], cells: np.ndarray, centres: np.ndarray):
    """What the codes stand for, the centroids, how far off the codes are, and for which rows all that is known."""
    codes = batch.column("code")
    ends = np.frombuffer(codes.buffers()[1], np.int32)[codes.offset : codes.offset + len(codes) + 1]
    codes = np.frombuffer(codes.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(codes), -1)
    centre = centres[np.searchsorted(cells, batch.column("cell").to_numpy())]
    near = np.concatenate([book[codes[:, i]] for i, book in enumerate(books)], axis=1) + centre
    error = batch.column("error").to_numpy().astype(np.float64)
    with np.errstate(invalid="ignore", over="ignore"):
        sound = np.isfinite(batch.column("term").to_numpy()) & (lengths_of(near) + lengths_of(centre) + error < HUGE)
    return np.where(sound[:, None], near, centre), centre, np.where(sound, error, 0.0), sound


def _admitted_vectors(known: _Known, listed: DataFrame) -> DataFrame:
    """The vectors of the listed rows; a cell of which most rows are listed is read whole, without a join.

    One row per cell reaches the driver.
    """
    counts = listed.groupBy("cell").count().toArrow()
    cell, vectors = counts["cell"].to_numpy(), known.vectors
    whole = 2 * counts["count"].to_numpy() >= known.cells.n_rows[np.searchsorted(known.cells.ids, cell)]

    def of(frame: DataFrame, some: np.ndarray) -> DataFrame:
        homes = small_frame(frame.sparkSession, [(c,) for c in some.tolist()], "cell int")
        return frame if len(some) == len(known.cells.ids) else frame.join(F.broadcast(homes), "cell", "left_semi")

    if whole.all():
        return of(vectors, cell)
    some = cell[~whole]
    picked = of(vectors, some).join(broadcast_if_small(of(listed, some)), ["cell", "node_id"], "left_semi")
    return of(vectors, cell[whole]).unionByName(picked) if whole.any() else picked


def _shortlist(coded: CodedIndex, sent: pa.Table, k: int, rerank: int | None) -> DataFrame:
    """``asked, node_id, cell`` of the rows that a query re-ranks, or all that its bounds admit."""
    if rerank is not None:
        return keep_nearest(_scan(coded, sent, rerank, upper=False), rerank, ["asked"])
    return _scan(coded, sent, k, upper=False, most=_limits(coded, sent, k))


def search_codes(
    coded: CodedIndex,
    queries: DataFrame,
    k: int,
    rerank: int | None = None,
    recall: float | None = None,
    qid: str = "qid",
    query_embedding: str = "embedding",
    max_sent: int | None = None,
) -> DataFrame:
    """The ``k`` nearest rows of each query; exact, unless ``rerank`` rows per query or a ``recall`` are asked for.

    Queries are sent to the tasks, about ``max_sent`` at once: more are cut into blocks, each of which reads the
    codes anew.  By default an exact search sends ``SENT_BYTES`` of them.  Repeated query ids give the rows of each.
    """
    check_count(k, "k")
    if rerank is not None and recall is not None:
        raise ValueError("give rerank or recall, not both")
    coded.assert_current()
    if rerank is not None:
        rerank = max(k, check_count(rerank, "rerank"))
    elif recall is not None:
        rerank = rerank_for(coded, k, recall)
    asked = queries.select(F.col(qid).alias("query_id"), F.col(query_embedding).alias("vector"))
    info = coded.index.info().first()
    if max_sent is None:
        max_sent = MAX_SENT_QUERIES if rerank is not None else max(MAX_SENT_QUERIES, SENT_BYTES // (4 * info["dimension"]))
    blocks = max(1, -(-asked.count() // check_count(max_sent, "max_sent")))
    found, known = None, None if rerank is not None else _Known.of(coded)
    block = F.pmod(F.xxhash64("query_id", "vector"), F.lit(blocks))
    for i in range(blocks):
        part = _search_block(coded, asked.where(block == i) if blocks > 1 else asked, k, rerank, max_sent, known)
        found = part if found is None else found.unionByName(part)
    return finish(found, info["metric_type"], qid, "node_id")


def _search_block(
    coded: CodedIndex, asked: DataFrame, k: int, rerank: int | None, max_sent: int, known: _Known | None
) -> DataFrame:
    # A block may hold more than the bound by chance, but is near it.
    sent = gather_queries(asked, 2 * max(max_sent, MAX_SENT_QUERIES))
    if sent is None:
        raise ValueError("too many equal queries for one block")
    if not sent.num_rows:
        empty = T.StructType([asked.schema["query_id"], coded.rows().schema["node_id"]])
        return coded.spark.createDataFrame([], empty.add("distance", "double").add("rank", "integer"))
    numbers = pa.table({"asked": np.arange(sent.num_rows, dtype=np.int32), "query_id": sent["query_id"], "vector": sent["vector"]})
    fields = T.StructType([T.StructField("asked", T.IntegerType()), *asked.schema.fields])
    if known is not None:
        most = _limits(coded, sent, k, known)
        listed, asking = _admitted(coded, sent, most, known)
        by_number = pa.table({"query_id": numbers["asked"], "vector": numbers["vector"]})
        # Rows beyond a query's limit leave no task; it gives way by more than a distance is rounded.
        one = float(known.cells.metric == "cosine")
        limits = most + one + SLACK * (np.abs(most) + one)
        rows = _admitted_vectors(known, listed)
        met = scan_with_queries(rows, by_number, T.IntegerType(), k, known.cells.metric, False, asking, limits)
        ids = coded.spark.createDataFrame(numbers.select(["asked", "query_id"]), T.StructType(fields.fields[:2]))
        found = keep_nearest(met, k).withColumnRenamed("query_id", "asked").join(F.broadcast(ids), "asked")
        # Written, so that what the tasks were sent can be given up before the next block.
        path = scratch_path(coded.spark, "found")
        found.select("query_id", "node_id", "distance", "rank").write.parquet(path)
        return coded.spark.read.parquet(path)
    metric = coded.index.info().first()["metric_type"]
    numbered = coded.spark.createDataFrame(numbers, fields)
    # Written once: its size is measured before it meets the vectors, and a scan is dearer than the list.
    path = scratch_path(coded.spark, "shortlist")
    _shortlist(coded, sent, k, rerank).select("asked", "node_id", "cell").distinct().write.parquet(path)
    listed = coded.spark.read.parquet(path)
    vectors = coded.index.rows().select("cell", "node_id", F.col("embedding").alias("own"))
    met = vectors.join(broadcast_if_small(listed), ["cell", "node_id"]).join(broadcast_if_small(numbered), "asked")
    exact = met.select("asked", "query_id", "node_id", distance(F.col("own"), F.col("vector"), metric).alias("distance"))
    return keep_nearest(exact, k, ["asked"]).drop("asked")


def rerank_for(coded: CodedIndex, k: int, recall: float, rows: int = CALIBRATION_ROWS) -> int:
    """How many rows per query have to be re-ranked for a share of the true neighbours.

    Measured for about ``rows`` rows of the index, chosen by hash, against their exact neighbours: of each true
    neighbour the rank by codes is looked up, among more and more rows until the share is met or all are ranked.
    """
    if not 0 < recall <= 1:
        raise ValueError("recall must be above 0 and at most 1")
    metric, total = coded.index.info().first()["metric_type"], coded.index.rows_of()
    share = max(1, total // rows)
    corpus = coded.index.rows().select("node_id", "embedding")
    sample = corpus.where(F.pmod(F.xxhash64("node_id", F.lit("codes")), F.lit(share)) == 0) if share > 1 else corpus
    sent = gather_queries(sample.where("embedding IS NOT NULL").select(F.col("node_id").alias("query_id"), F.col("embedding").alias("vector")))
    if not sent or not sent.num_rows:
        return max(k, total)
    asked = small_frame(coded.spark, zip(range(sent.num_rows), sent["vector"].to_pylist()), "asked int, embedding array<float>")
    truth = nearest_join(corpus, asked, k, metric, qid="asked").select("asked", "node_id")
    wanted = truth.count()
    limit = 8 * k
    while limit < total:
        ranked = keep_nearest(_scan(coded, sent, limit, upper=False), limit, ["asked"])
        met = truth.join(ranked.select("asked", "node_id", F.col("rank").alias("place")), ["asked", "node_id"])
        counts = met.groupBy("place").count().orderBy("place").collect()
        hits = 0
        for row in counts:
            hits += row["count"]
            if hits >= recall * wanted:
                return max(k, row["place"])
        limit *= 4
    return max(k, total)


def code_sizes(coded: CodedIndex) -> DataFrame:
    """Rows, and the bytes that a search reads per row from the codes and from the vectors."""
    code = F.octet_length("code") + 12
    sizes = coded.rows().agg(F.count("*").alias("n_rows"), F.max(code).cast("int").alias("code_bytes"))
    return sizes.withColumn("vector_bytes", F.lit(4 * coded.index.info().first()["dimension"]))

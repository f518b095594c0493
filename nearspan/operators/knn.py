"""Exact nearest neighbours of one query or of a whole frame of queries.

A frame of few queries (a checked, bounded number) is sent to the tasks and the corpus is read
once, in place, without a shuffle.  A frame of many queries is spread instead: the corpus is cut
into slices of bounded size, as many of which meet the stream of all queries in one task as its memory
holds, and only the best ``k`` rows per query and task leave it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.functions.distance import similarity
from nearspan.functions.vectors import vector_fault
from nearspan.operators.kernel import Block, NearestRows, matrix
from nearspan.schema import METRICS, check_count
from nearspan.session import small_frame

MAX_SENT_QUERIES = 10_000
MAX_TASKS = 20_000
MAX_SENT_MATCHES = 200_000
SLICE_BYTES = 64 * 1024 * 1024
MIN_SLICE_ROWS = 5_000
PART_QUERIES = 200_000


def nearest_to(
    corpus: DataFrame,
    point: Sequence[float],
    k: int,
    metric: str = "cosine",
    node_id: str = "node_id",
    embedding: str = "embedding",
    carry: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` rows nearest to one vector: node id, carried columns, distance, similarity, rank."""
    check_count(k, "k")
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} must be one of {METRICS}")
    if point is None or not len(point):
        raise ValueError("the query vector is missing")
    vector = pa.array([[float(x) for x in point]], type=pa.list_(pa.float32()))
    sent = pa.table({"query_id": pa.array([0], type=pa.int32()), "vector": vector})
    found = scan_with_queries(_corpus_rows(corpus, node_id, embedding, carry), sent, T.IntegerType(), k, metric)
    order = [F.col("distance").asc_nulls_last(), F.col("node_id")]
    best = found.drop("query_id").orderBy(*order).limit(k)
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.withColumnRenamed("node_id", node_id).withColumn("similarity", similarity(F.col("distance"), metric))


def nearest_join(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    node_id: str = "node_id",
    embedding: str = "embedding",
    qid: str = "qid",
    query_embedding: str = "embedding",
    carry: Sequence[str] = (),
    with_cosine: bool = False,
    max_sent: int = MAX_SENT_QUERIES,
    slice_rows: int | None = None,
    part_queries: int = PART_QUERIES,
) -> DataFrame:
    """The ``k`` nearest corpus rows of every query: query id, node id, distance, similarity, rank.

    ``carry`` names corpus columns that travel with the matches.  ``with_cosine`` adds the cosine
    similarity of query and match whatever the metric.  Query ids must be unique.
    """
    check_count(k, "k")
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} must be one of {METRICS}")
    rows = _corpus_rows(corpus, node_id, embedding, carry)
    asked = queries.select(F.col(qid).alias("query_id"), F.col(query_embedding).alias("vector"))
    sent = gather_queries(asked, max_sent)
    if sent is not None:
        found = scan_with_queries(rows, sent, asked.schema["query_id"].dataType, k, metric, with_cosine)
    else:
        dim = check_queries(asked)
        cores = rows.sparkSession.sparkContext.defaultParallelism
        slices = parts_of_rows(rows.count(), dim, slice_rows, cores)
        # Queries stream, so they are cut only where the slices alone leave cores idle; a corpus that is
        # large enough to be slow is moved once.
        blocks = max(1, min(math.ceil(asked.count() / part_queries), math.ceil(cores / slices)))
        # Every slice of rows meets every block of queries in a part of its own.
        cut = rows.withColumn("block", every(F.lit(blocks)))
        cut = cut.withColumn("part", turn_of("node_id", F.lit(slices)) * blocks + F.col("block")).drop("block")
        spread = asked.withColumn("slice", every(F.lit(slices)))
        spread = spread.withColumn("part", F.col("slice") * blocks + turn_of("query_id", F.lit(blocks))).drop("slice")
        found = meet_in_parts(cut, spread, slices * blocks, k, metric, with_cosine, dim)
    return finish(keep_nearest(found, k), metric, qid, node_id)


def parts_of_rows(count: int, dim: int, slice_rows: int | None, cores: int) -> int:
    """Into how many parts rows are cut, each of which meets the queries in one task.

    Every part costs one more copy of the queries, so there are no more than memory asks for, once all cores have one;
    slices of ``slice_rows`` rows share a part where it holds several.
    """
    wanted = max(count // MIN_SLICE_ROWS, math.ceil(count / slice_rows) if slice_rows else 0)
    return max(1, min(cores, wanted), math.ceil(count * 4 * max(dim, 1) / SLICE_BYTES))


def every(count: Column) -> Column:
    """One row per number from 0 up to ``count``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1))


def turn_of(key: str, count: Column) -> Column:
    """A number below ``count`` that depends on the key alone."""
    return F.pmod(F.xxhash64(key), count.cast("long"))


def _corpus_rows(corpus: DataFrame, node_id: str, embedding: str, carry: Sequence[str]) -> DataFrame:
    extra = [c for c in carry if c != node_id]
    return corpus.select(F.col(node_id).alias("node_id"), F.col(embedding).alias("vector"), *extra)


def finish(found: DataFrame, metric: str, qid: str, node_id: str) -> DataFrame:
    named = found.withColumnRenamed("query_id", qid).withColumnRenamed("node_id", node_id)
    return named.withColumn("similarity", similarity(F.col("distance"), metric))


def gather_queries(asked: DataFrame, limit: int = MAX_SENT_QUERIES) -> pa.Table | None:
    """The queries as one small table, or None when there are more than ``limit``."""
    if asked.count() > limit:
        return None
    table = asked.toArrow()
    lengths = set(pc.unique(pc.list_value_length(table["vector"])).to_pylist())
    if None in lengths or len(lengths) > 1 or table["vector"].combine_chunks().flatten().null_count:
        raise ValueError(f"every query needs a vector of the same size, found sizes {lengths}")
    return table


def check_queries(asked: DataFrame) -> int:
    """Size of the query vectors; raises when one is missing or they differ."""
    dim = asked.select(F.max(F.size("vector"))).first()[0] or 0
    bad = asked.where(vector_fault(F.col("vector"), dim).isNotNull()).limit(1).collect()
    if bad:
        raise ValueError(f"query {bad[0]['query_id']!r} has no vector of size {dim}")
    return dim


def _result_schema(rows: DataFrame, id_type: T.DataType, dropped: Iterable[str], with_cosine: bool) -> T.StructType:
    kept = [f for f in rows.schema.fields if f.name not in dropped]
    tail = [T.StructField("distance", T.DoubleType())]
    tail += [T.StructField("cosine", T.DoubleType())] if with_cosine else []
    return T.StructType([T.StructField("query_id", id_type), *kept, *tail])


def scan_with_queries(
    rows: DataFrame,
    sent: pa.Table,
    id_type: T.DataType,
    k: int,
    metric: str,
    with_cosine: bool = False,
    probes: Mapping[int, np.ndarray] | None = None,
    limits: np.ndarray | None = None,
) -> DataFrame:
    """Best ``k`` rows per query and partition, with the bounded query table sent to every task.

    With ``probes`` a row meets only the queries listed for its ``cell``.  With ``limits`` rows whose distance is
    beyond a query's limit are left out.
    """
    names = [c for c in rows.columns if c not in ("vector", "cell")]
    schema = _result_schema(rows, id_type, ("vector", "cell"), with_cosine)
    if not sent.num_rows:
        return small_frame(rows.sparkSession, [], schema)
    payload = rows.sparkSession.sparkContext.broadcast(
        (sent["query_id"].combine_chunks(), matrix(sent["vector"]), probes, limits)
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, vectors, wanted, limits = payload.value
        near = NearestRows(vectors, k, metric, with_cosine, limits)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            values, kept = matrix(table["vector"], vectors.shape[1]), table.select(names)
            if wanted is None:
                near.offer(Block(values, kept, k, metric))
                continue
            cells = table["cell"].to_numpy()
            for cell in np.unique(cells).tolist():
                if cell in wanted:
                    near.offer(Block(values, kept, k, metric, np.flatnonzero(cells == cell)), wanted[cell])
        yield from near.result(qids, names)

    # Every task returns k rows per query: few long tasks keep that small on a very large corpus.
    tasks = max(MAX_TASKS, 4 * rows.sparkSession.sparkContext.defaultParallelism)
    return rows.coalesce(tasks).mapInArrow(scan, schema)


def meet_in_parts(
    cut: DataFrame, spread: DataFrame, parts: int, k: int, metric: str, with_cosine: bool, dim: int
) -> DataFrame:
    """Best ``k`` rows per query and part, where rows and queries of the same ``part`` meet.

    Each task sorts its rows so that a part's corpus rows, of bounded number, come before its
    queries; those then stream by in batches.  A task takes several parts, one after the other, where
    there are more than ``MAX_TASKS``.

    Rows may have a ``spot``, a small number within the part, and queries a ``visited`` map of the spots: then a
    query meets only the rows whose spot is marked, the first spot being the highest bit of the first byte.
    """
    marked = "visited" in spread.columns
    names = [c for c in cut.columns if c not in ("vector", "part", "spot")]
    id_type = spread.schema["query_id"].dataType
    schema = _result_schema(cut, id_type, ("vector", "part", "spot"), with_cosine)
    both = cut.withColumn("asking", F.lit(False)).unionByName(
        spread.withColumn("asking", F.lit(True)), allowMissingColumns=True
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, Block]] = []
        current = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            part, asking = table["part"].to_numpy(), table["asking"].to_numpy(zero_copy_only=False)
            spot = table["spot"].fill_null(-1).to_numpy() if marked else np.zeros(len(part), np.int32)
            differs = (part[1:] != part[:-1]) | (asking[1:] != asking[:-1]) | (spot[1:] != spot[:-1])
            cuts = np.flatnonzero(differs) + 1
            for start, stop in zip(np.r_[0, cuts], np.r_[cuts, len(part)]):
                if part[start] != current:
                    current, held = part[start], []
                run = table.slice(start, stop - start)
                values = matrix(run["vector"], dim)
                if not asking[start]:
                    held.append((int(spot[start]), Block(values, run.select(names), k, metric)))
                elif held:
                    near = NearestRows(values, k, metric, with_cosine)
                    bits = _bits(run["visited"]) if marked else None
                    for number, block in held:
                        near.offer(block, None if bits is None else np.flatnonzero(bits[:, number]))
                    yield from near.result(run["query_id"].combine_chunks(), names)

    tasks = min(parts, MAX_TASKS)
    # Parts are dealt by number: by a hash of it some tasks would get several and others none.
    dealt = both.repartitionById(tasks, F.pmod("part", F.lit(tasks)).cast("int"))
    return dealt.sortWithinPartitions("part", "asking", *(["spot"] if marked else [])).mapInArrow(meet, schema)


def _bits(maps: pa.ChunkedArray) -> np.ndarray:
    """Maps of equal length as a matrix of booleans."""
    rows = np.frombuffer(b"".join(maps.to_pylist()), np.uint8).reshape(len(maps), -1)
    return np.unpackbits(rows, axis=1).view(bool)


def keep_nearest(found: DataFrame, k: int, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """The ``k`` nearest of the partial results, ranked; pruned on each side of the shuffle."""
    order: list[Column] = [F.col("distance").asc_nulls_last(), F.col("node_id")]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def with_payload(
    found: DataFrame, corpus: DataFrame, columns: Sequence[str], queries: DataFrame, k: int, node_id: str = "node_id"
) -> DataFrame:
    """Matches with corpus columns such as the text, read after ranking so they are never sorted.

    There are at most ``k`` matches per query.  When that is few rows in all they are sent to the
    corpus, which is then read in place; else both sides are shuffled.
    """
    few = queries.count() * k <= MAX_SENT_MATCHES
    return corpus.select(node_id, *columns).join(F.broadcast(found) if few else found, node_id)

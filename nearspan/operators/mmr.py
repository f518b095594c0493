"""Diversity re-ranking of each query's candidates by maximal marginal relevance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.operators.kernel import matrix
from nearspan.operators.knn import nearest_join, with_payload
from nearspan.schema import check_count

DEFAULT_LAMBDA = 0.5
TIE_DECIMALS = 12
CARRIED_CANDIDATES = 50_000


def default_candidates(k: int) -> int:
    return max(3 * k, 20)


def pick_diverse(relevance: np.ndarray, vectors: np.ndarray, k: int, lambda_mult: float = DEFAULT_LAMBDA) -> list[int]:
    """Positions picked one after another; ``relevance`` is the cosine similarity to the query.

    Scores equal to twelve decimals are ties and go to the lower position.  A vector without a
    direction leaves the order as it is; a round without any score ends the picking.
    """
    count = len(vectors)
    lengths = np.linalg.norm(vectors, axis=1)
    if np.any(lengths == 0):
        return list(range(min(k, count)))
    unit = vectors / lengths[:, None]
    picks = [int(np.argmax(np.round(relevance, TIE_DECIMALS)))] if count else []
    closest = np.full(count, -np.inf)
    open_ = np.ones(count, dtype=bool)
    while picks and len(picks) < min(k, count):
        open_[picks[-1]] = False
        to_last = unit @ unit[picks[-1]]
        closest = to_last if len(picks) == 1 else np.where(to_last > closest, to_last, closest)
        score = np.round(lambda_mult * relevance - (1 - lambda_mult) * closest, TIE_DECIMALS)
        score = np.where(open_ & ~np.isnan(score), score, -np.inf)
        best = int(np.argmax(score))
        if score[best] == -np.inf:
            break
        picks.append(best)
    return picks


def rerank(candidates: DataFrame, k: int, lambda_mult: float = DEFAULT_LAMBDA, qid: str = "qid") -> DataFrame:
    """Candidates with ``rank``, ``cosine`` and ``embedding`` to the ``k`` picks of each query.

    A query with no more than ``k`` candidates keeps its distance order.  A group never holds more
    rows than candidates were asked for.
    """
    kept = [f for f in candidates.schema.fields if f.name not in ("embedding", "cosine")]
    schema = T.StructType(kept)

    def one_query(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        order = list(range(min(k, group.num_rows)))
        if group.num_rows > k and not group["embedding"].null_count:
            relevance = group["cosine"].to_numpy()
            vectors = matrix(group["embedding"]).astype(np.float64)
            no_direction = np.any(np.linalg.norm(vectors, axis=1) == 0)
            query_has_none = np.isnan(relevance).all() and not np.isnan(vectors).any()
            if not (no_direction or query_has_none):
                order = pick_diverse(relevance, vectors, k, lambda_mult)
        picked = group.take(pa.array(order, type=pa.int64())).select([f.name for f in kept])
        place = pa.array(np.arange(1, len(order) + 1), type=pa.int32())
        return picked.set_column(picked.column_names.index("rank"), "rank", place)

    return candidates.groupBy(qid).applyInArrow(one_query, schema)


def with_embeddings(
    found: DataFrame, corpus: DataFrame, queries: DataFrame, k: int, node_id: str = "node_id", embedding: str = "embedding"
) -> DataFrame:
    """Candidates with their embeddings, read from the corpus after ranking."""
    rows = corpus.select(F.col(node_id).alias("node_id"), F.col(embedding).alias("embedding"))
    return with_payload(found, rows, ["embedding"], queries, k)


def nearest_diverse(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
    fetch_k: int | None = None,
    lambda_mult: float = DEFAULT_LAMBDA,
    node_id: str = "node_id",
    embedding: str = "embedding",
    qid: str = "qid",
    query_embedding: str = "embedding",
    carried: int = CARRIED_CANDIDATES,
    **options,
) -> DataFrame:
    """Nearest rows re-ranked for diversity.

    Few candidates bring their embedding along; for many, whose embeddings would make up most of
    the shuffle, the corpus is read once more for the candidates that are left.
    """
    fetch = default_candidates(k) if fetch_k is None else check_count(fetch_k, "fetch_k")
    rows = corpus.select(F.col(node_id).alias("node_id"), F.col(embedding).alias("embedding"))
    carry = ["embedding"] if queries.count() * fetch <= carried else []
    candidates = nearest_join(
        rows, queries, fetch, metric, qid=qid, query_embedding=query_embedding, carry=carry, with_cosine=True, **options
    )
    if not carry:
        candidates = with_embeddings(candidates, rows, queries, fetch)
    return rerank(candidates, k, lambda_mult, qid).withColumnRenamed("node_id", node_id)

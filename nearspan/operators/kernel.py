"""Block-wise nearest neighbours inside one task.

Spark decides which rows meet which queries; this helper keeps, for the rows that stream through
a task, the best ``k`` per query.  Equal vectors of a block are scored once.  The others are
screened with a single-precision matrix product; what its rounding bound cannot rule out is scored
again in double, pair by pair in a fixed order, so that ties go to the lower id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

UNIT = 2.0**-24
SCREEN_CELLS = 2_000_000
SCORE_CELLS = 4_000_000
# The first limit of a query is the k-th least of so many minima over a block, at least.
SEED_MINIMA = 256
# Scored pairs wait until there are so many per query, or so many in all, and are merged together.
WAITING_SHARE = 0.5
MOST_WAITING = 1_000_000


def matrix(column: pa.Array | pa.ChunkedArray, size: int | None = None) -> np.ndarray:
    """Vectors of a list column as a matrix; a row without a vector is all NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.unique(pc.list_value_length(column).drop_null().to_numpy(zero_copy_only=False)).tolist()
    size = size or (lengths[0] if lengths else 0)
    if any(length != size for length in lengths):
        raise ValueError(f"embeddings of sizes {lengths}, expected {size}: run the dimension audit first")
    values = column.drop_null().flatten().to_numpy(zero_copy_only=False)
    if not column.null_count:
        return values.reshape(len(column), size)
    rows = np.full((len(column), size), np.nan, dtype=values.dtype)
    rows[np.asarray(column.is_valid())] = values.reshape(-1, size)
    return rows


def lengths_of(rows: np.ndarray) -> np.ndarray:
    wide = rows.astype(np.float64)
    return np.sqrt((wide * wide).sum(axis=1))


def pair_distance(left: np.ndarray, right: np.ndarray, metric: str) -> np.ndarray:
    """Distance of each row pair in double; infinite where it is not defined."""
    a, b = left.astype(np.float64), right.astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        if metric == "euclidean":
            gap = a - b
            result = np.sqrt((gap * gap).sum(axis=1))
        else:
            product = (a * b).sum(axis=1)
            if metric == "cosine":
                scale = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
                result = 1.0 - np.where(scale > 0, product / scale, np.nan)
            else:
                result = -product
    return np.where(np.isnan(result), np.inf, result)


def equal_rows(vectors: np.ndarray) -> np.ndarray | None:
    """Number of the group of equal vectors that each row is in, or None when all differ."""
    bits = np.ascontiguousarray(vectors).view(np.uint32 if vectors.dtype == np.float32 else np.uint64)
    weights = np.random.default_rng(11).integers(1, 2**63, bits.shape[1], dtype=np.uint64) | np.uint64(1)
    digest = (bits * weights).sum(axis=1, dtype=np.uint64)
    values, first, group = np.unique(digest, return_index=True, return_inverse=True)
    if len(values) == len(digest):
        return None
    if not (bits == bits[first[group]]).all():
        return np.unique(bits, axis=0, return_inverse=True)[1].reshape(-1)
    return group


class Block:
    """Corpus rows made ready for comparison.

    ``rows`` holds ``node_id`` and what travels with it.  Of equal vectors only one is compared,
    and only the ``k`` lowest ids among them can be an answer.
    """

    def __init__(self, vectors: np.ndarray, rows: pa.Table, k: int, metric: str, spots: np.ndarray | None = None):
        self.rows = rows
        spots = np.arange(len(vectors)) if spots is None else spots
        part = vectors[spots]
        group = equal_rows(part) if len(part) > 1 else None
        if group is None:
            self.members, self.starts, self.sizes = spots, np.arange(len(part)), np.ones(len(part), dtype=np.int64)
        else:
            part = self._gather(part, spots, group, k)
        self.vectors = part
        norms = lengths_of(part)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            self.screen = (part / norms[:, None] if metric == "cosine" else part).astype(np.float32)
            self.squares = (norms * norms).astype(np.float32)
        self.sound = bool(np.isfinite(self.screen).all() and np.isfinite(norms).all())
        self.defined = np.isfinite(norms) & ((norms > 0) | (metric != "cosine"))
        self.top = float(norms[self.defined].max()) if self.defined.any() else 0.0

    def _gather(self, part, spots, group, k):
        order = np.argsort(group, kind="stable")
        sizes = np.bincount(group)
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        for number in np.flatnonzero(sizes > k):
            run = slice(starts[number], starts[number] + sizes[number])
            ids = self.rows["node_id"].take(pa.array(spots[order[run]]))
            order[run] = order[run][pc.sort_indices(ids).to_numpy()]
        self.members, self.starts, self.sizes = spots[order], starts, np.minimum(sizes, k)
        return part[order[starts]]

    def vector_of(self, rows: np.ndarray) -> np.ndarray:
        """Vectors of rows of the table."""
        number = np.zeros(self.rows.num_rows, dtype=np.int64)
        ends = np.r_[self.starts[1:], len(self.members)]
        number[self.members] = np.repeat(np.arange(len(self.starts)), ends - self.starts)
        return self.vectors[number[rows]]

    def expand(self, query: np.ndarray, spot: np.ndarray, gap: np.ndarray):
        """Scored pairs of query and compared vector as pairs of query and row."""
        count = self.sizes[spot]
        if len(self.members) == len(self.starts):
            return query, self.members[spot], gap
        ends = np.cumsum(count)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
        rows = self.members[np.repeat(self.starts[spot], count) + inside]
        return np.repeat(query, count), rows, np.repeat(gap, count)


class NearestRows:
    """Running best ``k`` rows per query over the blocks of one partition.

    Rows farther than a query's number in ``limits`` do not count.
    """

    def __init__(
        self, queries: np.ndarray, k: int, metric: str, with_cosine: bool = False, limits: np.ndarray | None = None
    ):
        self.queries = np.ascontiguousarray(queries)
        self.k = k
        self.metric = metric
        self.with_cosine = with_cosine
        self.norms = lengths_of(queries)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            scaled = queries / self.norms[:, None] if metric == "cosine" else queries
            # A factor that is a power of two changes no rounding.
            self.screen = scaled.astype(np.float32) * np.float32(-2 if metric == "euclidean" else -1)
        self.sound = np.isfinite(self.screen).all(axis=1) & np.isfinite(self.norms)
        self.bound = np.full(len(queries), np.inf) if limits is None else np.array(limits, np.float64)
        self.held: pa.Table | None = None
        self.waiting: list[pa.Table] = []
        self.n_waiting = 0

    @property
    def best(self) -> pa.Table | None:
        """The best rows so far, at most ``k`` per query."""
        self._merge()
        return self.held

    def offer(self, block: Block, members: np.ndarray | None = None) -> None:
        """Compare a block with all queries, or with those at the given positions."""
        if not len(block.vectors) or not len(self.queries):
            return
        chosen = np.arange(len(self.queries)) if members is None else members
        step = max(1, SCREEN_CELLS // len(block.vectors))
        for start in range(0, len(chosen), step):
            for query, row, gap in self._survivors(chosen[start : start + step], block):
                self.waiting.append(self._payload(query, row, gap, block))
                self.n_waiting += len(query)
            if self.n_waiting > MOST_WAITING:
                self._merge()
        if self.n_waiting > WAITING_SHARE * self.k * len(self.queries):
            self._merge()

    def _survivors(self, part: np.ndarray, block: Block):
        with np.errstate(invalid="ignore", over="ignore"):
            values = self.screen[part] @ block.screen.T
            if self.metric == "euclidean":
                values += block.squares
        size = 1.0 if self.metric == "cosine" else float(self.norms[part].max())
        if not (block.sound and self.sound[part].all() and (size + block.top) ** 2 < 1e37):
            finite = np.isfinite(values)
            if not finite.all():
                values[~finite] = -np.inf
        if not block.defined.all():
            values[:, ~block.defined] = np.inf
        with np.errstate(over="ignore"):
            limit = self._limit(part, values, block.top).astype(np.float32)
        limit = np.nextafter(limit, np.float32(np.inf))
        spots = np.flatnonzero(values <= limit[:, None])
        at, spot = spots // values.shape[1], spots % values.shape[1]
        query = part[at]
        width = max(1, SCORE_CELLS // max(1, block.vectors.shape[1]))
        for start in range(0, len(query), width):
            q, s = query[start : start + width], spot[start : start + width]
            gap = pair_distance(self.queries[q], block.vectors[s], self.metric)
            near = gap <= self.bound[q]
            if near.any():
                yield block.expand(q[near], s[near], gap[near])

    def _limit(self, part: np.ndarray, values: np.ndarray, top: float) -> np.ndarray:
        """Screen value above which a row cannot be among the best ``k`` of a query."""
        size = self.queries.shape[1]
        bound, qn = self.bound[part], self.norms[part]
        if self.metric == "euclidean":
            error = 4 * (size + 8) * UNIT * (qn + top) ** 2
            known = bound**2 - qn**2
        else:
            error = 2 * (size + 8) * UNIT * (np.ones(len(part)) if self.metric == "cosine" else qn * top)
            known = bound - 1.0 if self.metric == "cosine" else bound
        error = np.where(np.isfinite(error), error, np.inf)
        limit = known + error
        fresh = ~np.isfinite(bound)
        if fresh.any() and values.shape[1] > self.k:
            limit[fresh] = kth_of_minima(values if fresh.all() else values[fresh], self.k) + 2 * error[fresh]
        return np.where(np.isnan(limit), np.inf, limit)

    def _merge(self) -> None:
        if not self.waiting:
            return
        every = pa.concat_tables(([] if self.held is None else [self.held]) + self.waiting)
        self.waiting, self.n_waiting = [], 0
        query, gap = every["query"].to_numpy(), every["distance"].to_numpy()
        order = _by_id_in_ties(np.lexsort((gap, query)), query, gap, every["node_id"])
        query = query[order]
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
        last = place == self.k - 1
        self.bound[query[last]] = gap[order[last]]
        self.held = every.take(pa.array(np.sort(order[place < self.k]))).combine_chunks()

    def _payload(self, query: np.ndarray, row: np.ndarray, gap: np.ndarray, block: Block) -> pa.Table:
        taken = block.rows.take(pa.array(row)).append_column("query", pa.array(query.astype(np.int32)))
        taken = taken.append_column("distance", pa.array(gap))
        if not self.with_cosine:
            return taken
        apart = gap if self.metric == "cosine" else pair_distance(self.queries[query], block.vector_of(row), "cosine")
        return taken.append_column("cosine", _defined(1.0 - apart))

    def result(self, qids: pa.Array, names: list[str]) -> list[pa.RecordBatch]:
        """Best rows as batches of query id, the travelling columns and the distance."""
        best = self.best
        if best is None:
            return []
        best = best.sort_by([("query", "ascending"), ("distance", "ascending"), ("node_id", "ascending")])
        found = {"query_id": qids.take(best["query"].combine_chunks())}
        found |= {name: best[name] for name in names}
        found["distance"] = _defined(best["distance"].to_numpy())
        if self.with_cosine:
            found["cosine"] = best["cosine"]
        return pa.table(found).to_batches(max_chunksize=10_000)


def kth_of_minima(values: np.ndarray, k: int) -> np.ndarray:
    """For each row a bound for its ``k``-th least value: columns are folded on one another while there are many.

    Values of minus infinity are unknown and don't count.
    """
    if np.isneginf(values.min()):
        values = np.where(np.isneginf(values), np.float32(np.inf), values)
    while values.shape[1] >= 2 * max(SEED_MINIMA, 4 * k):
        half = values.shape[1] // 2
        folded = np.minimum(values[:, :half], values[:, half : 2 * half])
        if values.shape[1] % 2:
            np.minimum(folded[:, 0], values[:, -1], out=folded[:, 0])
        values = folded
    return np.partition(values, k - 1, axis=1)[:, k - 1]


def _by_id_in_ties(order: np.ndarray, query: np.ndarray, gap: np.ndarray, ids: pa.ChunkedArray) -> np.ndarray:
    """An order by query and distance, with rows equal in both put in the order of their ids."""
    q, g = query[order], gap[order]
    same = (q[1:] == q[:-1]) & (g[1:] == g[:-1])
    if not same.any():
        return order
    tied = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
    group = np.cumsum(~np.r_[False, same])[tied]
    keys = pa.table({"group": group, "node_id": ids.take(pa.array(order[tied]))})
    sorted_ = pc.sort_indices(keys, sort_keys=[("group", "ascending"), ("node_id", "ascending")]).to_numpy()
    order[tied] = order[tied][sorted_]
    return order


def _defined(values: np.ndarray) -> pa.Array:
    return pa.array(values, type=pa.float64(), mask=~np.isfinite(values))

"""The block helper against brute force, without Spark."""

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nearspan.operators import kernel
from nearspan.operators.kernel import Block, NearestRows, equal_rows, matrix, pair_distance
from nearspan.schema import METRICS


def brute(vectors, ids, queries, k, metric):
    out = []
    for i, q in enumerate(queries):
        gaps = pair_distance(np.repeat(q[None], len(vectors), axis=0), vectors, metric) if len(vectors) else []
        out += [(i, ids[j]) for _, _, j in sorted((g, ids[j], j) for j, g in enumerate(gaps))[:k]]
    return out


def found(vectors, ids, queries, k, metric, pieces):
    near = NearestRows(queries, k, metric, with_cosine=True)
    for spots in np.array_split(np.arange(len(vectors)), pieces):
        if len(spots):
            near.offer(Block(vectors[spots], pa.table({"node_id": pa.array([ids[s] for s in spots])}), k, metric))
    batches = near.result(pa.array(range(len(queries))), ["node_id"])
    rows = pa.Table.from_batches(batches).to_pylist() if batches else []
    return [(r["query_id"], r["node_id"]) for r in rows], rows


@settings(max_examples=150, deadline=None)
@given(
    seed=st.integers(0, 10**6),
    rows=st.integers(1, 80),
    dim=st.integers(1, 9),
    k=st.integers(1, 12),
    pieces=st.integers(1, 4),
    metric=st.sampled_from(METRICS),
    scale=st.sampled_from([1e-20, 1e-3, 1.0, 1e4, 1e25]),
    wide=st.booleans(),
)
def test_against_brute_force(seed, rows, dim, k, pieces, metric, scale, wide):
    rng = np.random.default_rng(seed)
    kind = np.float64 if wide else np.float32
    vectors = (rng.integers(-2, 3, (rows, dim)) * scale).astype(kind)
    vectors[rng.random(rows) < 0.3] = vectors[0]
    vectors[rng.random(rows) < 0.1] = 0
    vectors[rng.random(rows) < 0.05] = np.nan
    queries = np.concatenate([vectors[:3], (rng.normal(size=(3, dim)) * scale).astype(kind)])
    ids = [f"{i:03d}" for i in rng.permutation(rows)]
    assert found(vectors, ids, queries, k, metric, pieces)[0] == brute(vectors, ids, queries, k, metric)


@pytest.mark.parametrize("metric", METRICS)
def test_many_rows_and_close_distances(metric):
    rng = np.random.default_rng(1)
    base = rng.normal(size=16).astype(np.float32)
    vectors = (base + rng.normal(size=(5000, 16)) * 1e-6).astype(np.float32)
    ids = [f"{i:05d}" for i in range(5000)]
    queries = np.concatenate([base[None], vectors[:5]])
    got, rows = found(vectors, ids, queries, 10, metric, 3)
    assert got == brute(vectors, ids, queries, 10, metric)
    for row in rows:
        v = vectors[int(row["node_id"])]
        wanted = 1 - pair_distance(queries[row["query_id"]][None], v[None], "cosine")[0]
        assert abs(row["cosine"] - wanted) < 1e-12


def test_copies_are_compared_once():
    vectors = np.repeat(np.eye(3, dtype=np.float32), 1000, axis=0)
    block = Block(vectors, pa.table({"node_id": [f"{i:04d}" for i in range(3000)][::-1]}), 2, "cosine")
    assert block.vectors.shape == (3, 3)
    near = NearestRows(np.eye(3, dtype=np.float32), 2, "cosine")
    near.offer(block)
    table = pa.Table.from_batches(near.result(pa.array([0, 1, 2]), ["node_id"]))
    assert table["node_id"].to_pylist() == ["2000", "2001", "1000", "1001", "0000", "0001"]


def test_groups_of_equal_rows():
    assert equal_rows(np.eye(4)) is None
    group = equal_rows(np.array([[1.0, 2], [3, 4], [1, 2]]))
    assert group[0] == group[2] != group[1]


def test_matrix_of_lists():
    column = pa.array([[1.0, 2.0], None, [3.0, 4.0]], type=pa.list_(pa.float32()))
    rows = matrix(column)
    assert rows.shape == (3, 2) and np.isnan(rows[1]).all() and rows[2].tolist() == [3.0, 4.0]
    assert matrix(column.slice(2)).tolist() == [[3.0, 4.0]]
    assert matrix(pa.array([None], type=pa.list_(pa.float32())), 2).shape == (1, 2)
    with pytest.raises(ValueError):
        matrix(pa.array([[1.0], [1.0, 2.0]]))
    with pytest.raises(ValueError):
        matrix(column, 3)


@pytest.mark.parametrize("metric", METRICS)
def test_few_rows_of_a_first_block_are_scored(metric, monkeypatch):
    rng = np.random.default_rng(8)
    rows, queries = (rng.normal(size=(n, 16)).astype(np.float32) for n in (8192, 40))
    scored = []
    exact = kernel.pair_distance
    monkeypatch.setattr(kernel, "pair_distance", lambda a, b, m: scored.append(len(a)) or exact(a, b, m))
    near = NearestRows(queries, 10, metric)
    near.offer(Block(rows, pa.table({"node_id": [f"{i:05d}" for i in range(8192)]}), 10, metric))
    got = near.result(pa.array(range(40)), ["node_id"])
    # A limit from the first 1024 rows alone let 80 rows pass per query.
    assert sum(scored) < 40 * 30
    for i, q in enumerate(queries):
        gaps = exact(np.repeat(q[None], 8192, axis=0), rows, metric)
        want = [f"{j:05d}" for j in np.lexsort((np.arange(8192), gaps))[:10]]
        assert pa.Table.from_batches(got).filter(pa.compute.field("query_id") == i)["node_id"].to_pylist() == want

"""Compressed codes: exact by bounds, approximate with a measured recall."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearspan import nearest_join
from nearspan.operators import codes, ivf
from nearspan.operators.kernel import Block, NearestRows
from nearspan.schema import METRICS
from nearspan.session import scratch_path
from tests.test_cells import clustered
from tests.test_search import as_frame, as_queries, brute, collected, hard_vectors
from workload.tables import vectors


def coded(spark, corpus, metric="euclidean", n_cells=9, **options):
    index = ivf.build_index(as_frame(spark, corpus), scratch_path(spark, "index"), metric, n_cells=n_cells)
    return codes.build_codes(index, scratch_path(spark, "codes"), **options)


@pytest.mark.parametrize("metric", METRICS)
def test_search_by_bounds_is_exact(spark, metric):
    corpus = hard_vectors()
    queries = np.concatenate([corpus[::15], np.random.default_rng(5).normal(size=(4, 6))])
    built = coded(spark, corpus, metric, subspaces=4)
    want = sorted(brute(corpus, queries, 7, metric))
    assert collected(codes.search_codes(built, as_queries(spark, queries), 7)) == want
    assert collected(codes.search_codes(built, as_queries(spark, queries), 7, max_sent=5)) == want
    assert collected(codes.search_codes(built, as_queries(spark, queries), 7, rerank=len(corpus))) == want


def test_few_rows_are_reranked(spark):
    corpus = clustered(groups=40, each=50)
    built = coded(spark, corpus, n_cells=20)
    asked = as_queries(spark, corpus[::100])
    sent = ivf.gather_queries(asked.select(F.col("qid").alias("query_id"), F.col("embedding").alias("vector")))
    assert codes._shortlist(built, sent, 5, None).count() < 0.2 * 20 * len(corpus)


def test_recall(spark):
    rows = vectors(spark, "/root/testdata/sf0.1")
    index = ivf.build_index(rows, scratch_path(spark, "index"))
    built = codes.build_codes(index, scratch_path(spark, "codes"))
    asked = rows.where("CAST(node_id AS LONG) % 50 = 0").select(F.col("node_id").alias("qid"), "embedding")
    found = codes.search_codes(built, asked, 10, recall=0.95)
    truth = nearest_join(rows, asked, 10)
    share = found.join(truth, ["qid", "node_id"], "left_semi").count() / truth.count()
    assert share >= 0.9 and codes.rerank_for(built, 10, 0.95) < 2000 * 0.5
    sizes = codes.code_sizes(built).first()
    assert sizes["n_rows"] == rows.count() and sizes["code_bytes"] * 9 < sizes["vector_bytes"]


def test_codes_and_changes(spark):
    corpus = clustered(groups=5, each=9)
    built = coded(spark, corpus, n_cells=3)
    assert codes.search_codes(built, as_queries(spark, corpus[:0]), 3).count() == 0
    assert codes.search_codes(built, as_queries(spark, corpus[:1]), 100).count() == 45
    ivf.add_changes(built.index, as_frame(spark, corpus[:2]), as_frame(spark, corpus[:2]).select("node_id"))
    with pytest.raises(ValueError):
        codes.search_codes(built, as_queries(spark, corpus[:1]), 3)
    for bad in ({"rerank": 0}, {"recall": 0.0}, {"rerank": 5, "recall": 0.9}):
        with pytest.raises(ValueError):
            codes.search_codes(coded(spark, corpus, n_cells=2), as_queries(spark, corpus[:1]), 3, **bad)


@pytest.mark.parametrize("metric", METRICS)
def test_exact_search_lists_rows_and_no_pairs(spark, metric, monkeypatch):
    corpus = np.random.default_rng(7).normal(size=(300, 6))
    built = coded(spark, corpus, metric, subspaces=2)
    listed, admit = [], codes._admitted

    def admitted(*args):
        rows, asking = admit(*args)
        listed.append(rows.count())
        return rows, asking

    def pairs(*args, **options):
        raise AssertionError("pairs of query and row are listed")

    monkeypatch.setattr(codes, "_admitted", admitted)
    monkeypatch.setattr(codes, "_scan", pairs)
    found = codes.search_codes(built, as_queries(spark, corpus), 5, max_sent=120)
    assert collected(found) == sorted(brute(corpus, corpus, 5, metric))
    assert len(listed) == 3 and max(listed) <= 300


def test_cells_that_no_bound_admits_meet_no_query(spark):
    corpus = clustered(groups=40, each=50)
    built = coded(spark, corpus, n_cells=20)
    asked = as_queries(spark, corpus[::100]).select(F.col("qid").alias("query_id"), F.col("embedding").alias("vector"))
    sent = ivf.gather_queries(asked)
    rows, asking = codes._admitted(built, sent, codes._limits(built, sent, 5))
    assert sum(map(len, asking.values())) < 0.2 * 20 * sent.num_rows and rows.count() <= len(corpus)


def sent_of(spark, queries):
    asked = as_queries(spark, queries).select(F.col("qid").alias("query_id"), F.col("embedding").alias("vector"))
    return ivf.gather_queries(asked)


@pytest.mark.parametrize("metric", METRICS)
def test_what_bounds_in_double_admit_is_admitted(spark, metric):
    corpus = np.concatenate([hard_vectors(), clustered(groups=30, each=40)[:, :6] * 50])
    queries = corpus[::7]
    built = coded(spark, corpus, metric, n_cells=12, subspaces=3)
    sent = sent_of(spark, queries)
    most = codes._limits(built, sent, 4)
    table = built.rows().toArrow().combine_chunks()
    known = codes._Queries(codes.matrix(sent["vector"]), built.books(), *codes._gather_centroids(built.index.centroids()), metric)
    hit = np.zeros((len(queries), table.num_rows), bool)
    for some, gap, off in known.bounds(table.to_batches()[0]):
        hit[some] = codes._lower(gap, off) <= most[some][:, None]
    rows, asking = codes._admitted(built, sent, most)
    found, cell = {r["node_id"] for r in rows.collect()}, table["cell"].to_numpy()
    assert {x for x, h in zip(table["node_id"].to_pylist(), hit.any(axis=0)) if h} <= found
    for c in np.unique(cell):
        assert set(np.flatnonzero(hit[:, cell == c].any(axis=1))) <= set(asking.get(int(c), ()))


def test_limits_of_an_exact_search_are_distances(spark):
    corpus = clustered(groups=40, each=50)
    built = coded(spark, corpus, n_cells=20, subspaces=2)
    limits = codes._limits(built, sent_of(spark, corpus[::20]), 5)
    gaps = np.sqrt(((corpus[::20, None].astype(np.float32).astype(float) - corpus[None].astype(np.float32)) ** 2).sum(axis=2))
    least = np.sort(gaps, axis=1)[:, 4]
    assert (limits >= least * (1 - 1e-9)).all() and (limits <= least * (1 + 1e-9)).mean() > 0.9


def test_blocks_are_few_and_share_the_index(spark, monkeypatch):
    corpus = np.random.default_rng(3).normal(size=(60, 6))
    built = coded(spark, corpus, subspaces=2)
    blocks, listed, search, rows = [], [], codes._search_block, ivf.IvfIndex.rows

    def block(*args):
        blocks.append(1)
        return search(*args)

    def list_rows(*args):
        listed.append(1)
        return rows(*args)

    monkeypatch.setattr(codes, "_search_block", block)
    monkeypatch.setattr(ivf.IvfIndex, "rows", list_rows)
    queries = np.tile(corpus, (200, 1))
    assert codes.search_codes(built, as_queries(spark, queries), 2).count() == 2 * len(queries)
    assert len(blocks) == len(listed) == 1
    assert collected(codes.search_codes(built, as_queries(spark, corpus), 3, max_sent=20)) == sorted(brute(corpus, corpus, 3, "euclidean"))
    assert len(blocks) == 4 and len(listed) == 2


def test_cells_with_most_rows_listed_are_read_whole(spark):
    corpus = clustered(groups=3, each=30)
    built = coded(spark, corpus, n_cells=3)
    known = codes._Known.of(built)
    rows = known.vectors.select("cell", "node_id").toPandas()
    by_cell = {c: sorted(g) for c, g in rows.groupby("cell")["node_id"]}
    first, second = [c for c in sorted(by_cell) if len(by_cell[c]) > 3][:2]
    most, few = by_cell[first][: -1], by_cell[second][:2]
    listed = spark.createDataFrame([(c, n) for c, some in ((first, most), (second, few)) for n in some], "cell int, node_id string")
    found = sorted(r["node_id"] for r in codes._admitted_vectors(known, listed).collect())
    assert found == sorted(by_cell[first] + few)
    assert codes._admitted_vectors(known, known.vectors.select("cell", "node_id")) is known.vectors


def test_no_more_bounds_than_show_that_a_row_is_admitted(monkeypatch):
    vectors = np.random.default_rng(2).normal(size=(3000, 8))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    test = codes._Test(vectors[:2000], np.full(2000, 1.4), "euclidean")
    met, admits = [], test.admits

    def counted(queries, right):
        met.append(len(queries) * len(right))
        return admits(queries, right)

    monkeypatch.setattr(test, "admits", counted)
    marks = np.zeros(2000, bool)
    wanted = test.mark(test.right(vectors[2000:], np.zeros(1000)), np.arange(2000), marks)
    assert marks.all() and wanted.all() and sum(met) < 0.1 * 2000 * 1000


@pytest.mark.parametrize("metric", METRICS)
def test_rows_beyond_a_limit_are_left_out(metric):
    points = np.random.default_rng(4).normal(size=(80, 5)).astype(np.float32)
    block = Block(points, pa.table({"node_id": pa.array([f"{i:02d}" for i in range(80)])}), 6, metric)
    near = NearestRows(points[:9], 6, metric)
    near.offer(block)
    third = np.sort(near.best["distance"].to_numpy().reshape(-1)).mean()
    short = NearestRows(points[:9], 6, metric, limits=np.full(9, third))
    short.offer(block)
    kept = {(q, n) for q, n, d in zip(*(near.best[c].to_pylist() for c in ("query", "node_id", "distance"))) if d <= third}
    assert kept == set(zip(short.best["query"].to_pylist(), short.best["node_id"].to_pylist())) and len(kept) < 54

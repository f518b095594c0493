import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from nearspan import nearest_diverse, nearest_join, nearest_to
from nearspan.functions.distance import distance, similarity
from nearspan.functions.vectors import decode_vector, dimension_audit, encode_vector, vector_fault
from nearspan.operators import ivf, knn, lsh
from nearspan.operators.mmr import default_candidates, pick_diverse, rerank
from nearspan.schema import METRICS
from nearspan.session import scratch_path

DIM = 6


def as_frame(spark, matrix, prefix="n"):
    rows = [(f"{prefix}{i:04d}", [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "node_id string, embedding array<float>").repartition(3)


def as_queries(spark, matrix):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "qid int, embedding array<float>")


def brute(corpus, queries, k, metric):
    corpus = np.asarray(corpus, dtype=np.float32).astype(np.float64)
    queries = np.asarray(queries, dtype=np.float32).astype(np.float64)
    out = []
    for i, q in enumerate(queries):
        scored = []
        for j, v in enumerate(corpus):
            if metric == "euclidean":
                d = math.sqrt(((v - q) ** 2).sum())
            else:
                p = (v * q).sum()
                n = math.sqrt((v * v).sum()) * math.sqrt((q * q).sum())
                d = -p if metric == "inner_product" else (1 - p / n if n else math.nan)
            scored.append((d if not math.isnan(d) else math.inf, f"n{j:04d}"))
        for rank, (d, node) in enumerate(sorted(scored)[:k], 1):
            out.append((i, rank, node, None if math.isinf(d) else round(d, 6)))
    return out


def collected(frame):
    rows = frame.select("qid", "rank", "node_id", "distance").collect()
    return sorted((r[0], r[1], r[2], None if r[3] is None else round(r[3], 6) + 0.0) for r in rows)


def hard_vectors():
    """A third are copies of one vector, some are zero, some are tiny or large."""
    rng = np.random.default_rng(3)
    free = rng.normal(size=(90, DIM))
    copies = np.repeat(rng.normal(size=(1, DIM)), 60, axis=0)
    return np.concatenate([free, copies, np.zeros((12, DIM)), free[:9] * 1e-3, free[:9] * 1e3])


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("options", [{}, {"max_sent": 0, "slice_rows": 20}, {"max_sent": 0, "part_queries": 5}])
def test_join_matches_brute_force(spark, metric, options):
    corpus = hard_vectors()
    queries = np.concatenate([corpus[::15], np.random.default_rng(5).normal(size=(4, DIM))])
    found = nearest_join(as_frame(spark, corpus), as_queries(spark, queries), 7, metric, **options)
    assert collected(found) == sorted(brute(corpus, queries, 7, metric))


@pytest.mark.parametrize("metric", METRICS)
def test_one_vector_matches_join(spark, metric):
    corpus = as_frame(spark, hard_vectors())
    point = [0.3, -1.0, 0.5, 2.0, 0.0, 1.0]
    one = nearest_to(corpus, point, 9, metric).withColumn("qid", F.lit(0))
    assert collected(one) == collected(nearest_join(corpus, as_queries(spark, [point]), 9, metric))


def test_more_than_there_is_and_nothing(spark):
    corpus = as_frame(spark, np.eye(DIM)[:3])
    asked = as_queries(spark, [np.eye(DIM)[0]])
    assert nearest_join(corpus, asked, 50).count() == 3
    assert nearest_join(corpus.limit(0), asked, 5).count() == 0
    assert nearest_join(corpus.limit(0), asked, 5, max_sent=0).count() == 0
    assert nearest_join(corpus, asked.limit(0), 5).count() == 0
    assert nearest_to(corpus.limit(0), [1.0] * DIM, 5).count() == 0


def test_ties_go_to_the_lower_id(spark):
    corpus = as_frame(spark, np.ones((40, DIM)))
    found = nearest_join(corpus, as_queries(spark, [np.ones(DIM)]), 4).orderBy("rank").collect()
    assert [r.node_id for r in found] == ["n0000", "n0001", "n0002", "n0003"]


def test_undefined_distance_is_last_with_zero_similarity(spark):
    rows = [("a", [0.0, 0.0]), ("b", [-1.0, 0.0]), ("c", [float("nan"), 1.0]), ("d", None)]
    corpus = spark.createDataFrame(rows, "node_id string, embedding array<float>")
    found = nearest_join(corpus, as_queries(spark, [[1.0, 0.0]]), 4).orderBy("rank").collect()
    assert [r.node_id for r in found] == ["b", "a", "c", "d"]
    assert [r.similarity for r in found] == [-1.0, 0.0, 0.0, 0.0]
    assert found[1].distance is None


def test_undefined_distance_in_expressions(spark):
    rows = [("a", [0.0, 0.0]), ("b", [-1.0, 0.0]), ("c", [float("nan"), 1.0])]
    corpus = spark.createDataFrame(rows, "node_id string, embedding array<float>")
    found = nearest_to(corpus, [1.0, 0.0], 3).orderBy("rank").collect()
    assert [r.node_id for r in found] == ["b", "a", "c"]
    assert [r.distance for r in found] == [2.0, None, None]


def test_wrong_sizes_are_errors(spark):
    rows = [("a", [1.0, 0.0]), ("b", [1.0, 0.0, 0.0])]
    corpus = spark.createDataFrame(rows, "node_id string, embedding array<float>")
    asked = as_queries(spark, [[1.0, 0.0]])
    for frame in (nearest_join(corpus, asked, 2), nearest_to(corpus, [1.0, 0.0], 2)):
        with pytest.raises(Exception, match="dimension audit"):
            frame.collect()


@pytest.mark.parametrize("options", [{}, {"max_sent": 0}])
def test_bad_queries(spark, options):
    corpus = as_frame(spark, np.eye(2))
    schema = "qid int, embedding array<float>"
    for rows in ([(0, None)], [(0, [1.0, 2.0]), (1, [1.0])]):
        with pytest.raises(ValueError):
            nearest_join(corpus, spark.createDataFrame(rows, schema), 2, **options)
    with pytest.raises(ValueError):
        nearest_to(corpus, None, 2)
    with pytest.raises(ValueError):
        nearest_join(corpus, as_queries(spark, [[1.0, 0.0]]), 0)
    with pytest.raises(ValueError):
        nearest_join(corpus, as_queries(spark, [[1.0, 0.0]]), 1, "manhattan")


def test_similarity_formulas(spark):
    row = spark.range(1).select(
        similarity(F.lit(0.25), "cosine").alias("c"),
        similarity(F.lit(3.0), "euclidean").alias("e"),
        similarity(F.lit(-0.5), "euclidean").alias("below"),
        similarity(F.lit(-7.0), "inner_product").alias("p"),
        similarity(F.lit(None).cast("double"), "euclidean").alias("none"),
        distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0)), "euclidean").alias("d"),
    ).first()
    assert (row.c, row.e, row.below, row.p, row.none) == (0.75, 0.25, 1.0, 7.0, 0.0)
    assert round(row.d, 6) == 1.414214


def test_carried_columns(spark):
    corpus = as_frame(spark, np.eye(3)).withColumn("text", F.concat(F.lit("t"), "node_id"))
    for options in ({}, {"max_sent": 0, "slice_rows": 2}):
        found = nearest_join(corpus, as_queries(spark, np.eye(3)), 1, carry=["text", "embedding"], **options)
        assert {(r.qid, r.text) for r in found.collect()} == {(i, f"tn000{i}") for i in range(3)}
        assert all(r.embedding[r.qid] == 1.0 for r in found.collect())


def test_vector_audit_and_codecs(spark):
    rows = [("a", "[1, 2]"), ("b", "[1, 2, 3]"), ("c", "nonsense"), ("d", None), ("e", "[1, null]")]
    table = spark.createDataFrame(rows, "node_id string, t string").select("node_id", decode_vector(F.col("t")).alias("embedding"))
    report = {(r.reason, r.dimension): (r.n_rows, r.first_node_id) for r in dimension_audit(table, 2).collect()}
    assert report[("no embedding", None)] == (2, "c")
    assert report[("wrong dimension", 3)] == (1, "b")
    assert report[("missing value", 2)] == (1, "e")
    good = table.where(vector_fault(F.col("embedding"), 2).isNull()).select(encode_vector(F.col("embedding"))).collect()
    assert [r[0] for r in good] == ["[1.0,2.0]"]


# Diversity


def relevance(query, vectors):
    query, vectors = np.asarray(query, float), np.asarray(vectors, float)
    return vectors @ query / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))


def slow_picks(query, vectors, k, weight):
    rel = relevance(query, vectors)
    unit = np.asarray(vectors) / np.linalg.norm(vectors, axis=1)[:, None]
    picks = [int(np.argmax(rel))]
    while len(picks) < min(k, len(vectors)):
        scores = {
            i: weight * rel[i] - (1 - weight) * max(float(unit[i] @ unit[j]) for j in picks)
            for i in range(len(vectors))
            if i not in picks
        }
        picks.append(max(scores, key=lambda i: (round(scores[i], 12), -i)))
    return picks


def test_picks():
    angles = np.radians([75.0, 40.0, 38.0, -60.0])
    vectors = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    east = relevance([2.0, 0.0], vectors)
    assert pick_diverse(east, vectors, 2, 1.0) == [2, 1]
    assert pick_diverse(east, vectors, 2, 0.6) == [2, 3]
    assert pick_diverse(np.zeros(0), np.zeros((0, 2)), 7) == []
    assert pick_diverse(east[:1], vectors[:1], 7) == [0]
    twins = np.tile(vectors[3], (6, 1))
    assert pick_diverse(relevance([0.0, -1.0], twins), twins, 3, 0.0) == [0, 1, 2]


def test_picks_match_slow_version():
    rng = np.random.default_rng(311)
    for weight in (0.0, 0.15, 0.45, 0.8, 1.0):
        vectors, query = rng.uniform(-1, 1, size=(33, 7)), rng.uniform(-1, 1, size=7)
        assert pick_diverse(relevance(query, vectors), vectors, 12, weight) == slow_picks(query, vectors, 12, weight)


def test_picks_without_direction_or_score():
    zero = np.array([[1.0, 0], [0, 0], [0, 1.0]])
    assert pick_diverse(np.array([1.0, np.nan, 0.0]), zero, 2) == [0, 1]
    nan = np.full((3, 2), np.nan)
    assert len(pick_diverse(np.full(3, np.nan), nan, 2)) == 1


def test_lambda_one_is_distance_order(spark):
    corpus = as_frame(spark, np.random.default_rng(1).normal(size=(50, DIM)))
    asked = as_queries(spark, np.random.default_rng(2).normal(size=(6, DIM)))
    plain = collected(nearest_join(corpus, asked, 5))
    assert collected(nearest_diverse(corpus, asked, 5, fetch_k=20, lambda_mult=1.0)) == plain
    assert collected(nearest_diverse(corpus, asked, 5, fetch_k=5, lambda_mult=0.0)) == plain
    assert collected(nearest_diverse(corpus, asked, 5, fetch_k=20, lambda_mult=0.2)) != plain
    assert default_candidates(5) == 20 and default_candidates(10) == 30


def test_missing_embedding_keeps_distance_order(spark):
    rows = [(0, 1, "a", 0.1, 1.0, [1.0, 0.0]), (0, 2, "b", 0.2, 1.0, None), (0, 3, "c", 0.3, 0.1, [0.0, 1.0])]
    schema = "qid int, rank int, node_id string, distance double, cosine double, embedding array<float>"
    found = rerank(spark.createDataFrame(rows, schema), 2, 0.0).orderBy("rank").collect()
    assert [(r["rank"], r.node_id) for r in found] == [(1, "a"), (2, "b")]


# Index


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows are copies that all fall into one cell."""
    rng = np.random.default_rng(9)
    return np.concatenate([rng.normal(size=(100, DIM)), np.repeat(rng.normal(size=(1, DIM)), 100, axis=0)])


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("options", [{}, {"max_sent": 0, "slice_rows": 30, "part_queries": 2}])
def test_all_cells_are_exact(spark, skewed, metric, options):
    corpus, asked = as_frame(spark, skewed), as_queries(spark, skewed[::20])
    index = ivf.build_index(corpus, scratch_path(spark, "test"), metric, n_cells=5)
    found = ivf.search_index(index, asked, 6, probes=5, **options)
    assert collected(found) == collected(nearest_join(corpus, asked, 6, metric))
    few = ivf.search_index(index, asked, 6, probes=2)
    assert collected(few) == collected(ivf.search_index(index, asked, 6, probes=2, max_sent=0, slice_rows=30))
    assert sum(r.n_rows for r in ivf.index_stats(index, 205).collect()) == 200
    assert {r.n_not_indexed for r in ivf.index_stats(index, 205).collect()} == {5}


def test_index_rules(spark, skewed):
    corpus = as_frame(spark, skewed)
    path = scratch_path(spark, "test")
    index = ivf.build_index(corpus, path, "cosine", n_cells=4)
    with pytest.raises(ValueError):
        ivf.build_index(corpus, path, "cosine", n_cells=4)
    with pytest.raises(ValueError):
        ivf.open_index(spark, path, "euclidean")
    with pytest.raises(ValueError):
        ivf.search_index(index, as_queries(spark, skewed[:1]), 3, metric="euclidean")
    with pytest.raises(ValueError):
        ivf.search_index(index, as_queries(spark, skewed[:1]), 3, probes=0)
    assert ivf.search_index(index, as_queries(spark, skewed[:1]), 3, probes=10_001).count() == 3
    with pytest.raises(ValueError):
        ivf.build_index(corpus, scratch_path(spark, "test"), n_cells=0)
    with pytest.raises(ValueError):
        ivf.build_index(corpus.limit(0), scratch_path(spark, "test"), n_cells=2)
    assert ivf.open_index(spark, path, "cosine") is not None
    assert ivf.drop_index(spark, path) and not ivf.drop_index(spark, path)
    assert ivf.open_index(spark, path) is None


def test_index_reports(spark, skewed):
    corpus = as_frame(spark, skewed)
    index = ivf.build_index(corpus, scratch_path(spark, "test"), n_cells=4)
    health = {r.probes: r for r in ivf.index_health(index, corpus, as_queries(spark, skewed[::10]), 5, (1, 4)).collect()}
    assert health[4].recall == 1.0 and health[4].visited_share == 1.0
    assert health[1].recall <= 1.0 and health[1].visited_share < 1.0
    assert ivf.index_summary(index).first().n_rows == 200


def test_projection_join(spark, skewed):
    from nearspan.operators.lsh import nearest_by_projection

    corpus, asked = as_frame(spark, skewed), as_queries(spark, skewed[::20])
    options = {"metric": "euclidean", "parts": 4}
    found = collected(nearest_by_projection(corpus, asked, 6, bucket_length=2.0, **options))
    cut = collected(nearest_by_projection(corpus, asked, 6, bucket_length=2.0, slice_rows=7, part_queries=2, **options))
    assert found == cut
    truth = {(q, n): d for q, _, n, d in collected(nearest_join(corpus, asked, 200, "euclidean"))}
    assert all(truth[(q, n)] == d for q, _, n, d in found)
    with pytest.raises(ValueError):
        nearest_by_projection(corpus, asked.limit(0), 6)


def test_queries_are_sent_once_per_task_and_not_per_slice(spark, monkeypatch):
    corpus = np.random.default_rng(3).normal(size=(300, 6))
    sent, meet = [], knn.meet_in_parts
    monkeypatch.setattr(knn, "meet_in_parts", lambda cut, spread, *rest: sent.append(spread.count()) or meet(cut, spread, *rest))
    found = nearest_join(as_frame(spark, corpus), as_queries(spark, corpus), 4, max_sent=0, slice_rows=2)
    assert collected(found) == sorted(brute(corpus, corpus, 4, "cosine"))
    assert sent[0] <= 300 * spark.sparkContext.defaultParallelism < 300 * 150


def test_each_part_has_a_task_of_its_own(spark):
    corpus = as_frame(spark, np.random.default_rng(4).normal(size=(64, 6)))
    rows = corpus.select("node_id", F.col("embedding").alias("vector"), (F.monotonically_increasing_id() % 8).alias("part"))
    asked = rows.select(F.col("node_id").alias("query_id"), "vector", "part")
    found = knn.meet_in_parts(rows, asked, 8, 1, "euclidean", False, 6)
    assert found.select(F.spark_partition_id()).distinct().count() == rows.select("part").distinct().count()


def test_projection_join_has_parts_for_all_cores(spark, monkeypatch):
    corpus = np.random.default_rng(5).normal(size=(200, 6))
    seen, meet = [], lsh.meet_in_parts
    monkeypatch.setattr(lsh, "MIN_SLICE_ROWS", 5)

    def watched(cut, spread, parts, *rest):
        seen.append((parts, spread.groupBy("part").count().agg(F.max("count")).first()[0]))
        return meet(cut, spread, parts, *rest)

    monkeypatch.setattr(lsh, "meet_in_parts", watched)
    rows, asked = as_frame(spark, corpus), as_queries(spark, corpus)
    found = lsh.nearest_by_projection(rows, asked, 5, tables=1, bucket_length=100.0, parts=1)
    cores = spark.sparkContext.defaultParallelism
    assert found.count() == 5 * 200
    assert seen[0][0] == 4 * cores and seen[0][1] < 60

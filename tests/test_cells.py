"""Bounded search in cells: equal to the exact search, few cells read, with filters and after writes."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan import FilterGroup, MetaColumn, MetaFilter, TableConfig, VectorStore, nearest_join
from nearspan.functions import synopsis
from nearspan.functions.filters import predicate
from nearspan.operators import cells, ivf
from nearspan.operators.lsh import nearest_by_projection
from nearspan.schema import METRICS
from nearspan.session import scratch_path
from tests.test_search import as_frame, as_queries, brute, collected, hard_vectors
from workload.tables import vectors

SPREAD = {"max_sent": 0, "slice_rows": 40, "part_queries": 9}
CONFIG = TableConfig(
    dim=6,
    promoted=(MetaColumn("lang", "VARCHAR(8)"), MetaColumn("size", "INT"), MetaColumn("price", "DOUBLE")),
)


def clustered(seed=1, groups=30, each=20, dim=6):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(groups, 1, dim)) * 10 + rng.normal(size=(groups, each, dim)) * 0.2).reshape(-1, dim)


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("options", [{}, SPREAD])
def test_bounded_search_is_exact(spark, metric, options):
    corpus = hard_vectors()
    queries = np.concatenate([corpus[::15], np.random.default_rng(5).normal(size=(4, 6))])
    index = ivf.build_index(as_frame(spark, corpus), scratch_path(spark, "index"), metric, n_cells=9)
    found = ivf.search_bounded(index, as_queries(spark, queries), 7, **options)
    assert collected(found) == sorted(brute(corpus, queries, 7, metric))


def read_share(found, n_queries, n_rows):
    return (found.visits.agg(F.sum(F.col("n_queries") * F.col("n_rows"))).first()[0] or 0) / (n_queries * n_rows)


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("options", [{}, SPREAD])
def test_few_cells_are_read_of_clustered_rows(spark, metric, options):
    corpus = clustered()
    queries = corpus[::20] + 0.01
    index = ivf.build_index(as_frame(spark, corpus), scratch_path(spark, "index"), metric)
    found = ivf.bounded(index, as_queries(spark, queries), 5, **options)
    assert collected(found.rows) == sorted(brute(corpus, queries, 5, metric))
    assert read_share(found, len(queries), len(corpus)) < 0.25


@pytest.mark.parametrize("metric", METRICS)
def test_pivot_join(spark, metric):
    corpus = clustered()
    queries = corpus[::3]
    found = ivf.pivot_join(as_frame(spark, corpus), as_queries(spark, queries), 5, metric, **SPREAD)
    assert collected(found.rows) == sorted(brute(corpus, queries, 5, metric))
    # The spread plan moves each query to every slice; here a query moves to few pivots.
    moved = found.visits.agg(F.sum("n_queries")).first()[0]
    if metric != "inner_product":
        assert moved < 0.3 * len(queries) * found.visits.count()


def test_pivot_join_of_odd_tables(spark):
    corpus = as_frame(spark, np.eye(6)[:3])
    asked = as_queries(spark, [np.eye(6)[0]])
    assert ivf.pivot_join(corpus, asked, 50).rows.count() == 3
    assert ivf.pivot_join(corpus.limit(0), asked, 5).rows.count() == 0
    assert ivf.pivot_join(corpus, asked.limit(0), 5).rows.count() == 0
    hard = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [-1.0, 0.0]), ("c", None)], "node_id string, embedding array<float>")
    got = ivf.pivot_join(hard, as_queries(spark, [[1.0, 0.0], [0.0, 0.0]]), 3).rows
    assert collected(got) == collected(nearest_join(hard, as_queries(spark, [[1.0, 0.0], [0.0, 0.0]]), 3))


def recall_of(found, truth):
    want = {(r["qid"], r["node_id"]) for r in truth.select("qid", "node_id").collect()}
    got = {(r["qid"], r["node_id"]) for r in found.select("qid", "node_id").collect()}
    return len(want & got) / len(want)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_on_every_fiftieth_row(spark, folder):
    rows = vectors(spark, folder)
    asked = rows.where("node_id % 50 = 0").select(F.col("node_id").alias("qid"), "embedding")
    truth = nearest_join(rows, asked, 10)
    index = ivf.build_index(rows, scratch_path(spark, "index"))
    assert recall_of(ivf.search_bounded(index, asked, 10, recall=0.9), truth) >= 0.9
    assert recall_of(ivf.search_bounded(index, asked, 10), truth) == 1
    assert recall_of(nearest_by_projection(rows, asked, 10, parts=8), truth) >= 0.9


def test_recall_curve_agrees_with_searches(spark):
    corpus = hard_vectors()[:90]
    rows, asked = as_frame(spark, corpus), as_queries(spark, corpus[::9])
    index = ivf.build_index(rows, scratch_path(spark, "index"), n_cells=7)
    truth = nearest_join(rows, asked, 5)
    health = {r["probes"]: r for r in ivf.index_health(index, rows, asked, 5, range(1, 8)).collect()}
    sizes = {r["cell"]: r["n_rows"] for r in ivf.index_stats(index).collect()}
    for probes in range(1, 8):
        assert health[probes]["recall"] == pytest.approx(recall_of(ivf.search_index(index, asked, 5, probes), truth))
        met = ivf.assign_cells(asked, index.centroids(), probes, asking=True).collect()
        share = sum(sizes[r["cell"]] for r in met) / len(corpus) / 10
        assert health[probes]["visited_share"] == pytest.approx(share)
    curve = ivf.calibrate(index, 5).collect()
    assert len(curve) == 7 and curve[-1]["recall"] == 1 and curve[-1]["visited_share"] == 1
    assert ivf.probes_for(index, 1.0) <= 7
    with pytest.raises(ValueError, match="recall"):
        ivf.probes_for(index, 1.5)
    with pytest.raises(ValueError, match="not both"):
        ivf.search_bounded(index, asked, 5, recall=0.9, probes=2)


def filter_rows(spark, corpus):
    rows = as_frame(spark, corpus).withColumn("i", F.substring("node_id", 2, 9).cast("int"))
    return rows.select(
        "node_id", "embedding",
        F.when(F.col("i") % 7 > 0, F.element_at(F.array(*map(F.lit, ("en", "de", "fr"))), F.col("i") % 3 + 1)).alias("lang"),
        F.when(F.col("i") % 5 > 0, F.col("i")).alias("size"),
        (F.col("i") / 10).alias("price"),
        F.to_json(F.struct((F.col("i") % 4).alias("k"))).alias("metadata"),
    )


FILTERS = [
    MetaFilter("lang", "en"),
    MetaFilter("lang", "xx"),
    MetaFilter("lang", None),
    MetaFilter("size", 20, "<"),
    MetaFilter("size", [3, 597, "9"], "in"),
    MetaFilter("size", [1, 2], "nin"),
    MetaFilter("price", 55.5, ">="),
    MetaFilter("k", 3),
    FilterGroup([MetaFilter("lang", "de"), FilterGroup([MetaFilter("size", 9, "<="), MetaFilter("k", "2")], "or"), FilterGroup()]),
]


@pytest.fixture(scope="module")
def filtered_index(spark):
    rows = filter_rows(spark, clustered())
    return rows, ivf.build_index(rows, scratch_path(spark, "index"), keep=["lang", "size", "price", "metadata"])


@pytest.mark.parametrize("tree", FILTERS, ids=repr)
def test_filters_are_answered_from_the_cells(spark, filtered_index, tree):
    rows, index = filtered_index
    asked = as_queries(spark, clustered()[::60])
    exact = collected(nearest_join(rows.where(predicate(tree, CONFIG)), asked, 5))
    assert collected(ivf.search_bounded(index, asked, 5, filters=tree, config=CONFIG)) == exact


def test_one_probe_still_finds_k_matches(spark, filtered_index):
    _, index = filtered_index
    asked = as_queries(spark, clustered()[::60])
    some = ivf.search_bounded(index, asked, 5, filters=FILTERS[4], config=CONFIG, probes=1)
    assert some.count() == 10 * 3


def test_filters_skip_cells(spark, filtered_index):
    rows, index = filtered_index
    asked = as_queries(spark, clustered()[::60])
    found = ivf.bounded(index, asked, 5, filters=MetaFilter("size", 20, "<"), config=CONFIG)
    assert found.visits.count() < 6
    assert recall_of(
        ivf.search_bounded(index, asked, 5, recall=0.9, filters=FILTERS[0], config=CONFIG),
        nearest_join(rows.where(predicate(FILTERS[0], CONFIG)), asked, 5),
    ) >= 0.9


def test_a_synopsis_never_hides_a_match(spark):
    schema = "g int, lang string, size int, price double"
    rng = np.random.default_rng(4)
    texts, sizes = [None, "", "a", "b", "10", "9", "ü"], [None, 0, 1, 5, -3, 2**31 - 1]
    prices = [None, 0.0, 1.5, -2.0, float("nan"), float("inf")]
    rows = [(g, *(c[rng.integers(len(c))] for c in (texts, sizes, prices))) for g in range(60) for _ in range(rng.integers(1, 4))]
    frame = spark.createDataFrame(rows, schema)
    fields = synopsis.summarised(f for f in frame.schema.fields if f.name != "g")
    groups = frame.groupBy("g").agg(F.count("*").alias("n_rows"), *synopsis.aggregates(fields))
    values = {"lang": [*texts, 9, 1.5, True], "size": [*sizes, 1.5, "1", 10**12], "price": [*prices[:4], 1, "1.5"]}
    trees = []
    for key, chosen in values.items():
        for value, operator in itertools.product(chosen, ("==", "!=", "<", ">=")):
            if value is not None or operator in ("==", "!="):
                trees.append(MetaFilter(key, value, operator))
        trees += [MetaFilter(key, chosen[1:4], "in"), MetaFilter(key, chosen[:3], "nin"), MetaFilter(key, chosen[1:], "nin")]
    trees.append(FilterGroup([MetaFilter("lang", "a"), MetaFilter("size", 1)], "or"))
    hits = frame.select("g", *(predicate(t, CONFIG).alias(f"t{i}") for i, t in enumerate(trees)))
    hits = {r["g"]: r for r in hits.groupBy("g").agg(*(F.bool_or(f"t{i}").alias(f"t{i}") for i in range(len(trees)))).collect()}
    can = groups.select("g", *(synopsis.possible(t, CONFIG, fields).alias(f"t{i}") for i, t in enumerate(trees))).collect()
    wrong = [(r["g"], trees[i]) for r in can for i in range(len(trees)) if hits[r["g"]][f"t{i}"] and not r[f"t{i}"]]
    assert wrong == []
    skipped = sum(not r[f"t{i}"] for r in can for i in range(len(trees)))
    assert skipped > len(can) * len(trees) / 5


def test_search_after_changes(spark):
    corpus = clustered(groups=12)
    rows = as_frame(spark, corpus)
    asked = as_queries(spark, corpus[::50])
    index = ivf.build_index(rows.where("node_id < 'n0150'"), scratch_path(spark, "index"), "euclidean")
    # Added, changed twice, removed, and added again.
    ivf.add_changes(index, rows.where("node_id >= 'n0150'"))
    moved = corpus + 3
    ivf.add_changes(index, as_frame(spark, moved).where("node_id < 'n0050'"), rows.where("node_id LIKE '%7'").select("node_id"))
    ivf.add_changes(index, rows.where("node_id < 'n0010'"))
    now = {f"n{i:04d}": (moved if 10 <= i < 50 else corpus)[i] for i in range(len(corpus)) if i % 10 != 7 or i < 50}
    current = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in now.items()], "node_id string, embedding array<float>")
    want = collected(nearest_join(current, asked, 6, "euclidean"))
    assert index.rows().count() == index.rows_of() == len(now)
    assert collected(ivf.search_bounded(index, asked, 6)) == want
    before = index.cells().where("n_rows > 0").agg(F.max("n_rows")).first()[0]
    assert ivf.split_cells(index, 1.2) > 0
    assert index.cells().where("n_rows > 0").agg(F.max("n_rows")).first()[0] < before
    assert index.rows_of() == len(now)
    assert collected(ivf.search_bounded(index, asked, 6)) == want
    assert collected(ivf.search_bounded(index, asked, 6, **SPREAD)) == want


def test_an_unfinished_change_does_not_count(spark):
    rows = as_frame(spark, clustered(groups=4))
    index = ivf.build_index(rows, scratch_path(spark, "index"))
    before = index.rows_of()
    rows.select("node_id", F.lit(0).alias("cell")).write.parquet(f"{index.path}/deltas/000001/gone")
    assert index.deltas() == [] and index.rows_of() == before == index.rows().count()
    ivf.add_changes(index, removed=rows.limit(1).select("node_id"))
    assert index.deltas() == [2] and index.rows().count() == before - 1


def test_store_serves_filters_and_writes_from_the_index(spark, monkeypatch):
    config = TableConfig(dim=6, promoted=(MetaColumn("lang", "VARCHAR(8)"),))
    store = VectorStore(spark, scratch_path(spark, "store"), config, buckets=3)
    corpus = clustered(groups=8)
    rows = as_frame(spark, corpus).withColumn("text", F.col("node_id"))
    number = F.substring("node_id", 2, 9).cast("int")
    rows = rows.withColumn("metadata", F.to_json(F.struct(F.when(number % 2 == 0, "en").otherwise("de").alias("lang"), (number % 5).alias("k"))))
    store.add(rows)
    store.apply_vector_index(n_cells=6)
    asked = as_queries(spark, corpus[::40])
    calls = []
    search = ivf.search_bounded
    monkeypatch.setattr(ivf, "search_bounded", lambda *a, **b: calls.append(1) or search(*a, **b))

    def agree(filters=None):
        exact = store.query(asked, 4, filters, search_type="knn", with_rows=False)
        near = store.query(asked, 4, filters, search_type="ann", probes=6, with_rows=False)
        assert collected(near) == collected(exact)
        assert recall_of(store.query(asked, 4, filters, search_type="ann", with_rows=False), exact) >= 0.9

    agree()
    agree(MetaFilter("lang", "en"))
    agree(FilterGroup([MetaFilter("k", 3), MetaFilter("lang", "de")]))
    store.add(rows.where("node_id < 'n0020'").withColumn("embedding", F.transform("embedding", lambda x: -x)))
    agree()
    assert store.delete_nodes(["n0040", "n0041"]) == 2
    assert store.delete_by_metadata(MetaFilter("k", 4)) > 0
    agree(MetaFilter("lang", "en"))
    assert len(calls) >= 10
    assert store.find_index().rows_of() == store.count()


@pytest.mark.parametrize("probes", [None, 5])
def test_queries_are_sent_once_per_bin_and_not_per_cell(spark, monkeypatch, probes):
    corpus = np.random.default_rng(6).normal(size=(400, 6))
    index = ivf.build_index(as_frame(spark, corpus), scratch_path(spark, "index"), n_cells=40)
    sent, meet = [], cells.meet_in_parts
    monkeypatch.setattr(cells, "meet_in_parts", lambda cut, spread, *rest: sent.append(spread.count()) or meet(cut, spread, *rest))
    asked, spread = as_queries(spark, corpus), {"max_sent": 0, "slice_rows": 200}
    if probes is None:
        found = ivf.search_bounded(index, asked, 4, **spread)
        assert collected(found) == sorted(brute(corpus, corpus, 4, "cosine"))
    else:
        found = ivf.search_index(index, asked, 4, probes, **spread)
        assert collected(found) == collected(ivf.search_index(index, asked, 4, probes))
    # Two bins hold the rows; before, a query was sent to each of its cells.
    assert all(n <= 2 * len(corpus) for n in sent)


def test_cells_over_several_bins():
    held = cells.CellSet(np.arange(6), np.zeros((6, 2)), np.array([0, 5, 90, 0, 5, 0]), np.zeros(6), "euclidean")
    bins = cells.bins_of(held, 2, 25, 8)
    assert bins.first.tolist() == [0, 0, 0, 3, 3, 3] and bins.count.tolist() == [1, 1, 4, 1, 1, 1]
    assert bins.begin.tolist() == [0, 2, 2, 2] and bins.end.tolist() == [3, 3, 3, 6]

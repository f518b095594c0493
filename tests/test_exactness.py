"""Values that must not be lost, rounded or cut, and filters that must reach the scan."""

import pytest
from pyspark.sql import functions as F

from nearspan import MetaColumn, MetaFilter, PartitionSpec, TableConfig, VectorStore, create_partitioned_table
from nearspan.functions.filters import predicate
from nearspan.operators import ivf
from nearspan.operators.knn import nearest_join
from nearspan.operators.lookup import browse, first_rows
from nearspan.operators.partition import insert_rows, is_broadcast_table, join_dimension, where_key, with_partition
from nearspan.session import scratch_path
from nearspan.sources.catalog import run_sql

PLAIN = TableConfig(dim=2)
TYPED = TableConfig(dim=2, promoted=(MetaColumn("n", "INT"), MetaColumn("tag", "VARCHAR(9)")))


def rows(spark, entries):
    return spark.createDataFrame(
        [(f"r{i}", "t", meta, [1.0, float(i)]) for i, meta in enumerate(entries)],
        "node_id string, text string, metadata string, embedding array<float>",
    )


@pytest.mark.parametrize("value", ['{"n": "abc"}', '{"n": 3000000000}', '{"n": [1]}'])
def test_values_that_do_not_fit_are_refused(spark, value):
    store = VectorStore(spark, scratch_path(spark, "test"), TYPED)
    with pytest.raises(ValueError, match="does not fit"):
        store.add(rows(spark, ['{"n": 1}', value]))
    assert store.count() == 0
    assert store.add(rows(spark, ['{"n": 1}', '{"n": null}', "{}", None])) == 4


def test_big_integers_compare_exactly(spark):
    big = (1 << 53) + 1
    table = rows(spark, [f'{{"big": {big + i}}}' for i in (-1, 0, 1)])
    assert [r.node_id for r in browse(table, PLAIN, filters=MetaFilter("big", big)).collect()] == ["r1"]
    assert browse(table, PLAIN, filters=MetaFilter("big", big, ">=")).count() == 2
    assert browse(table, PLAIN, filters=MetaFilter("big", [big, big + 1], "in")).count() == 2
    typed = table.withColumn("n", F.get_json_object("metadata", "$.big").cast("long"))
    config = TableConfig(dim=2, promoted=(MetaColumn("n", "BIGINT"),))
    assert typed.where(predicate(MetaFilter("n", str(big)), config)).count() == 1
    assert typed.where(predicate(MetaFilter("n", 10**25, "<"), config)).count() == 3


def test_lists_reach_the_scan(spark, capsys):
    path = scratch_path(spark, "test")
    spark.createDataFrame([(i, f"t{i % 5}") for i in range(50)], "n int, tag string").write.parquet(path)
    table = spark.read.parquet(path)
    for key, values in (("n", [3, 5, 7]), ("tag", ["t1", "t2"])):
        for operator in ("in", "nin"):
            table.where(predicate(MetaFilter(key, values, operator), TYPED)).explain()
            pushed = capsys.readouterr().out.split("PushedFilters: ")[1].split("]")[0]
            assert "In(" in pushed or "Or(" in pushed, pushed


def test_browse_has_no_cap_of_its_own(spark):
    table = spark.range(12_000).select(F.col("id").cast("string").alias("node_id"))
    assert browse(table, PLAIN).count() == 12_000
    want = sorted(str(i) for i in range(12_000))[:5000]
    assert [r.node_id for r in first_rows(table, 5000).collect()] == want
    missing = table.withColumn("node_id", F.when(F.col("node_id") != "7", F.col("node_id")))
    assert first_rows(missing, 2000).collect()[0].node_id is None


@pytest.mark.parametrize("sent", [0, 100])
def test_both_ways_of_the_join_agree_on_odd_vectors(spark, sent):
    asked = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "qid int, embedding array<float>")
    for vectors in ([None, None], [None, [float("nan"), 1.0]], [[0.0, 0.0], [1.0, 1.0], None]):
        corpus = spark.createDataFrame([(str(i), v) for i, v in enumerate(vectors)], "node_id string, embedding array<float>")
        got = nearest_join(corpus, asked, 3, max_sent=sent, slice_rows=1).orderBy("qid", "rank").collect()
        want = nearest_join(corpus, asked, 3).orderBy("qid", "rank").collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_inner_product_looks_where_products_are_large(spark):
    corpus = spark.createDataFrame([("near", [1.0, 0.0]), ("long", [10.0, 5.0])], "node_id string, embedding array<float>")
    centres = spark.createDataFrame([(0, [1.0, 0.0]), (1, [10.0, 5.0])], "cell int, centroid array<float>")
    index = ivf.build_index(corpus, scratch_path(spark, "test"), "inner_product", centroids=centres)
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "qid int, embedding array<float>")
    for sent in (0, 10):
        assert [r.node_id for r in ivf.search_index(index, asked, 1, 1, max_sent=sent).collect()] == ["long"]


def test_text_keys_are_hashed(spark):
    spec = PartitionSpec("HASH", "name", 4)
    frame = spark.createDataFrame([(f"k{i % 20}", i) for i in range(100)] + [(None, 0)], "name string, v int")
    placed = with_partition(frame, spec)
    assert placed.groupBy("name").agg(F.countDistinct("p").alias("n")).agg(F.max("n")).first()[0] == 1
    assert placed.select("p").distinct().count() == 4
    assert where_key(placed, spec, "k3").count() == 5


def test_declared_tables(spark):
    spark.sql("DROP TABLE IF EXISTS exact_dim")
    folder = scratch_path(spark, "it's")
    create_partitioned_table(spark, "exact_dim", [("id", "BIGINT NOT NULL"), ("v", "INT")], broadcast=True, path=folder)
    good = spark.createDataFrame([(1, 2), (2, None)], "id long, v int")
    insert_rows(good, "exact_dim")
    with pytest.raises(ValueError, match="needs values"):
        insert_rows(spark.createDataFrame([(None, 2)], "id long, v int"), "exact_dim")
    with pytest.raises(ValueError, match="needs values"):
        insert_rows(spark.createDataFrame([(2,)], "v int"), "exact_dim")
    assert is_broadcast_table(spark, "exact_dim") and spark.table("exact_dim").count() == 2
    assert join_dimension(good, "exact_dim", "id").count() == 2
    spark.sql("DROP TABLE exact_dim")


def test_sql_distances_are_undefined_for_nan(spark):
    text = "SELECT vec_distance_{}(array(float('NaN'), float(1)), array(float(1), float(1))) AS d"
    for name in ("euclidean", "cosine", "inner_product"):
        assert run_sql(spark, text.format(name)).first().d is None


def test_indexes_are_dropped_by_name(spark):
    store = VectorStore(spark, scratch_path(spark, "test"), PLAIN)
    store.add(rows(spark, ["{}"] * 8))
    store.apply_vector_index("one", 2)
    store.apply_vector_index("two", 2)
    assert store.drop_vector_index("two") and not store.drop_vector_index("two")
    assert store.find_index().info().first()["index_name"] == "one"
    assert len(store.optimize() and store._index_paths()) == 1
    assert store.query([1.0, 1.0], 3, search_type="auto").count() == 3
    assert store.get_documents(limit=3).count() == 3 and store.get_documents().count() == 8

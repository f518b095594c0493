import json
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan import FilterGroup, MetaColumn, MetaFilter, TableConfig, VectorStore
from nearspan.operators.mutate import delete_counted, latest, upsert
from nearspan.operators.vector_table import (
    assert_writable,
    merged_metadata,
    not_null_report,
    rebuilt_rows,
    stable_columns,
    vector_table,
    write_audit,
)
from nearspan.session import scratch_path
from nearspan.sources.snapshots import SnapshotTable
from nearspan.streaming.ingest import ingest, upsert_batches

DIM = 4
WATERS = ["spring", "brook", "river", "lake", "fen"]


def source(spark, count=5, prefix="", start=0):
    rng = np.random.default_rng(count)
    rows = []
    for i in range(start, start + count):
        metadata = {"water": WATERS[i % 5], "lang": "gd", "depth": 7 * (i % 5) + 2, "ref_doc_id": f"doc{i // 2}"}
        vector = [float(x) for x in rng.normal(size=DIM)]
        rows.append((f"n{i}", f"{prefix}text {i}", json.dumps(metadata), vector))
    return spark.createDataFrame(rows, "node_id string, text string, metadata string, embedding array<float>")


def store(spark, config=None, buckets=3):
    return VectorStore(spark, scratch_path(spark, "store"), config or TableConfig(dim=DIM), buckets)


def names(frame):
    return sorted(r["node_id"] for r in frame.collect())


def test_story(spark):
    table = store(spark)
    assert table.count() == 0 and table.rows().count() == 0
    assert table.add(source(spark, 20)) == 20
    asked = source(spark, 20).select(F.col("node_id").alias("qid"), "embedding")
    best = table.query(asked, 1).collect()
    assert len(best) == 20 and all(r.qid == r.node_id and r.text for r in best)
    diverse = table.query(asked, 4, mode="mmr", lambda_mult=0.1)
    assert diverse.count() == 80
    wanted = MetaFilter("water", ["lake", "river"], "in")
    near = table.query([1.0, 0.0, 0.0, 0.0], 50, wanted)
    assert near.count() == 8
    assert {json.loads(r.metadata)["water"] for r in near.collect()} == {"lake", "river"}
    assert table.delete("doc0") == 2
    assert table.delete_nodes(["n5", "unknown"]) == 1
    assert table.delete_by_metadata(MetaFilter("depth", 16, ">")) == 8
    assert table.count() == 9 == table.rows().count()
    assert table.delete_nodes() == 0 and table.delete_nodes(filters=FilterGroup()) == 0
    assert table.delete("nothing") == 0
    table.clear()
    table.clear()
    assert table.count() == 0 and table.rows().count() == 0
    assert table.query([1.0, 0.0, 0.0, 0.0], 3).count() == 0
    assert table.add(source(spark, 3)) == 3
    table.drop()
    assert VectorStore(spark, table.path, table.config, 3).count() == 0


def test_upsert_twice_is_once(spark):
    table = store(spark)
    table.add(source(spark, 10))
    ids = {r.node_id: r.id for r in table.rows().collect()}
    for _ in range(2):
        assert table.add(source(spark, 6, "second ", start=5)) == 11
    rows = {r.node_id: r for r in table.rows().collect()}
    assert rows["n5"].text == "second text 5" and rows["n4"].text == "text 4"
    assert all(rows[n].id == i for n, i in ids.items())
    again = VectorStore(spark, table.path, table.config, 3)
    assert again.count() == 11


def test_add_is_all_or_nothing(spark):
    table = store(spark)
    table.add(source(spark, 4))
    bad = source(spark, 4).withColumn("embedding", F.when(F.col("node_id") == "n2", F.array(F.lit(1.0))).otherwise(F.col("embedding")))
    with pytest.raises(ValueError, match="wrong dimension"):
        table.add(bad)
    with pytest.raises(ValueError, match="no embedding"):
        table.add(source(spark, 4).withColumn("embedding", F.lit(None).cast("array<float>")))
    assert table.count() == 4
    assert table.add(source(spark, 4).limit(0)) == 4


def test_last_row_of_a_batch_wins(spark):
    rows = source(spark, 1)
    many = rows.withColumn(
        "seq", F.explode(F.sequence(F.lit(0), F.lit(30)))
    ).withColumn("text", F.concat(F.lit("v"), "seq"))
    table = store(spark)
    assert table.add(many, seq="seq") == 1
    assert table.rows().first().text == "v30"


def test_without_sequence_the_choice_is_stable(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", None), ("b", "z")], "node_id string, text string")
    first = sorted(map(tuple, latest(rows, seq=None).collect()), key=str)
    second = sorted(map(tuple, latest(rows.repartition(4).orderBy(F.rand()), seq=None).collect()), key=str)
    assert first == second and len(first) == 2


def test_upsert_with_a_hot_key(spark):
    base = spark.range(100).select(F.concat(F.lit("k"), "id").alias("node_id"), F.lit("old").alias("text"))
    hot = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("k1")).otherwise(F.concat(F.lit("k"), F.col("id") % 150)).alias("node_id"),
        F.col("id").cast("string").alias("text"),
        F.col("id").alias("seq"),
    )
    rows = {r.node_id: r.text for r in upsert(base, hot).collect()}
    expected = {f"k{i}": "old" for i in range(100)}
    for i in range(5000):
        expected["k1" if i % 3 == 0 else f"k{i % 150}"] = str(i)
    assert rows == expected


def test_nodes_and_documents(spark):
    table = store(spark)
    table.add(source(spark, 6))
    assert names(table.get_nodes(["n1", "n3", "zz"])) == ["n1", "n3"]
    assert names(table.get_nodes(filters=MetaFilter("depth", 2))) == ["n0", "n5"]
    assert table.get_nodes().count() == 6 and table.get_nodes([]).count() == 6
    ids = spark.createDataFrame([("n2",), ("n2",)], "node_id string")
    assert names(table.get_nodes(ids)) == ["n2"]
    document = table.get_documents(["n1"]).first()
    assert document.metadata["water"] == "brook"
    assert names(table.search_by_metadata(MetaFilter("lang", "gd"), limit=2)) == ["n0", "n1"]
    assert table.embeddings(["n0", "n9"]).count() == 1


def test_query_rules(spark):
    table = store(spark)
    table.add(source(spark, 6))
    point = [1.0, 0.0, 0.0, 0.0]
    with pytest.raises(NotImplementedError):
        table.query(point, mode="sparse")
    with pytest.raises(ValueError):
        table.query(None)
    with pytest.raises(ValueError):
        table.query(point, search_type="fast")
    with pytest.raises(ValueError):
        table.query(point, probes=0)
    assert table.query(point, 3, FilterGroup([FilterGroup()])).count() == 3
    assert table.query(point, 3, search_type="ann").count() == 3


def test_index_follows_the_table(spark):
    table = store(spark)
    table.add(source(spark, 40))
    assert table.find_index() is None and table.get_stats() is None
    assert not table.drop_vector_index()
    table.apply_vector_index(n_cells=4)
    asked = source(spark, 40).select(F.col("node_id").alias("qid"), "embedding")
    exact = sorted(map(tuple, table.query(asked, 3, search_type="knn", with_rows=False).select("qid", "rank", "node_id").collect()))
    near = table.query(asked, 3, search_type="ann", probes=4, with_rows=False).select("qid", "rank", "node_id")
    assert sorted(map(tuple, near.collect())) == exact
    assert table.query(asked, 3, mode="mmr", search_type="ann", probes=4).count() == 120
    table.add(source(spark, 5, start=100))
    # The index follows the write.
    assert {r.n_not_indexed for r in table.get_stats().collect()} == {0} and table.find_index().deltas() == [1]
    found = table.query(source(spark, 5, start=100).select(F.col("node_id").alias("qid"), "embedding"), 1, search_type="ann")
    assert all(r.qid == r.node_id for r in found.collect())
    table.optimize()
    assert {r.n_not_indexed for r in table.get_stats().collect()} == {0}
    assert table.explain_index_health(asked, 3, (4,)).first().recall == 1.0
    with pytest.raises(ValueError):
        table.apply_vector_index(metric="euclidean")
    assert table.drop_vector_index() and table.find_index() is None


PROMOTED = TableConfig(
    dim=DIM,
    id_column="row_no",
    node_id_column="station",
    text_column="report",
    embedding_column="profile",
    metadata_column="notes",
    promoted=(MetaColumn("water", "VARCHAR(20)", False, "dry"), MetaColumn("lang", "VARCHAR(2)"), MetaColumn("depth")),
)


def test_promoted_columns(spark):
    table = store(spark, PROMOTED)
    table.add(source(spark, 5))
    row = table.rows().where("station = 'n1'").first()
    assert (row.water, row.lang, row.depth) == ("brook", "gd", "9")
    assert json.loads(row.notes) == {"ref_doc_id": "doc0"}
    assert table.get_nodes(["n1"]).columns == ["node_id", "text", "metadata", "water", "lang", "depth"]
    assert names(table.get_nodes(filters=MetaFilter("depth", 16, ">="))) == ["n2", "n3", "n4"]
    assert table.query([1.0, 0.0, 0.0, 0.0], 9, MetaFilter("water", "river")).count() == 1
    assert table.get_documents(["n1"]).first().metadata["depth"] == "9"
    assert table.delete("doc0") == 2


def test_not_null_and_default(spark):
    rows = vector_table(source(spark, 3).withColumn("metadata", F.lit('{"lang": "gd", "water": null}')), PROMOTED)
    assert write_audit(rows, PROMOTED)["missing water"] == 3
    with pytest.raises(ValueError, match="missing water"):
        assert_writable(rows, PROMOTED)
    assert not_null_report(rows, PROMOTED).collect() == [("water", 3, 3)]


def test_no_json_column(spark):
    config = TableConfig(dim=DIM, metadata_column=None, promoted=("water",))
    table = store(spark, config)
    table.add(source(spark, 5))
    assert table.get_nodes(["n0"]).columns == ["node_id", "text", "water"]
    assert table.get_documents(["n0"]).first().metadata == {"water": "spring"}
    for call in (lambda: table.get_nodes(filters=MetaFilter("lang", "gd")), lambda: table.delete("doc0")):
        with pytest.raises(ValueError):
            call()
    with_document = TableConfig(dim=DIM, metadata_column=None, promoted=("ref_doc_id",))
    other = store(spark, with_document)
    other.add(source(spark, 5))
    assert other.delete("doc1") == 2


def test_promotion_keeps_json_types(spark):
    metadata = '{"price": 19.99, "n": 7, "tags": ["a", {"b": null}], "deep": {"x": {"y": [1, 2]}}, "t": true, "e": null, "u": "é漢😀\\"q"}'
    config = TableConfig(dim=1, promoted=(MetaColumn("price", "DECIMAL(10,2)"), MetaColumn("n", "INT"), MetaColumn("u")))
    rows = spark.createDataFrame([("a", metadata, [1.0])], "node_id string, metadata string, embedding array<float>")
    row = vector_table(rows, config).first()
    assert str(row.price) == "19.99" and row.n == 7 and row.u == 'é漢😀"q'
    assert json.loads(row.metadata) == {k: v for k, v in json.loads(metadata).items() if k not in ("price", "n", "u")}


def test_merge_rules(spark):
    config = TableConfig(dim=1, promoted=(MetaColumn("depth", "DECIMAL(6,3)"), MetaColumn("water")))
    schema = "node_id string, text string, metadata string, depth decimal(6,3), water string"
    data = [
        ("both", "ford", '{"bridges": [3, 4], "_page": 7}', Decimal("1.250"), "salt"),
        ("json only", None, '{"water": "fresh", "mouth": "north"}', None, None),
        ("column first", "weir", '{"water": "fresh"}', None, "brackish"),
        ("broken", "lock", "{water", None, None),
        ("a list", "dam", '["water"]', None, "salt"),
        (None, "pier", '{"node_id": "named inside"}', None, None),
    ]
    rows = spark.createDataFrame(data, schema)
    merged = {r.node_id: r.m for r in rows.select("node_id", merged_metadata(config).alias("m")).collect()}
    assert merged["both"] == {"bridges": "[3,4]", "_page": "7", "depth": "1.250", "water": "salt"}
    assert merged["json only"] == {"water": "fresh", "mouth": "north"}
    assert merged["column first"] == {"water": "brackish"}
    assert merged["broken"] == {} and merged["a list"] == {"water": "salt"}
    back = {r.node_id: r for r in rebuilt_rows(rows, config).collect()}
    assert back["json only"].text == "" and "_page" not in back["both"].metadata
    assert "named inside" in back


def test_stable_names(spark):
    rows = vector_table(source(spark, 2), PROMOTED).select(*stable_columns(PROMOTED))
    assert rows.columns[:3] == ["node_id", "text", "metadata"]


def test_hard_texts_survive(spark):
    texts = ["it's; DROP--", "back\\slash", "two\nlines", "漢字 😀 é", "<b>&amp;</b>", ""]
    rows = [(f"n{i}", t, json.dumps({"t": t, "d": {"a": {"b": [t]}}}), [1.0, 0.0, 0.0, float(i)]) for i, t in enumerate(texts)]
    table = store(spark)
    table.add(spark.createDataFrame(rows, "node_id string, text string, metadata string, embedding array<float>"))
    back = {r.node_id: r for r in table.rows().collect()}
    assert [back[f"n{i}"].text for i in range(len(texts))] == texts
    assert all(json.loads(back[f"n{i}"].metadata)["t"] == t for i, t in enumerate(texts))
    assert names(table.get_nodes(filters=MetaFilter("t", texts[0]))) == ["n0"]


def test_counted_delete(spark, tmp_path):
    rows = vector_table(source(spark, 10), TableConfig(dim=DIM))
    left, seen = delete_counted(rows, MetaFilter("depth", 9, "<="), TableConfig(dim=DIM))
    left.write.parquet(str(tmp_path / "left"))
    assert seen.get["n_deleted"] == 4
    assert spark.read.parquet(str(tmp_path / "left")).count() == 6


# Snapshots

PAIR = T.StructType([T.StructField("node_id", T.StringType()), T.StructField("x", T.LongType())])


def numbers(spark, count, start=0):
    return spark.range(start, start + count).select(F.col("id").cast("string").alias("node_id"), F.col("id").alias("x"))


def test_emptied_bucket_stays_empty(spark):
    table = SnapshotTable(spark, scratch_path(spark, "t"), PAIR, "node_id", 4)
    table.replace(numbers(spark, 100))
    gone = table.read({2})
    kept = 100 - gone.count()
    table.replace(gone.limit(0).drop("bucket"), {2})
    assert table.read().count() == kept == table.count()
    assert table.read({2}).count() == 0


def test_failed_write_changes_nothing(spark):
    table = SnapshotTable(spark, scratch_path(spark, "t"), PAIR, "node_id", 2)
    table.replace(numbers(spark, 20))
    broken = table.read().drop("bucket").withColumn("x", F.raise_error(F.lit("stop")).cast("long"))
    with pytest.raises(Exception, match="stop"):
        table.replace(broken)
    assert table.count() == 20 and table.read().agg(F.sum("x")).first()[0] == 190
    table.replace(table.read().drop("bucket").where("x < 5"))
    assert table.count() == 5


def test_only_touched_buckets_are_written(spark):
    table = SnapshotTable(spark, scratch_path(spark, "t"), PAIR, "node_id", 8)
    table.replace(numbers(spark, 200))
    touched = table.touched_by(numbers(spark, 1))
    assert len(touched) == 1
    table.replace(table.read(touched).drop("bucket").withColumn("x", F.lit(1).cast("long")), touched)
    written = {b for b, s in table.state().items() if s.folder.startswith("2-")}
    assert written == touched
    with pytest.raises(ValueError):
        SnapshotTable(spark, table.root, PAIR, "node_id", 4).read()


# Streaming


def test_stream_and_replay(spark, tmp_path):
    table = store(spark)
    folder = str(tmp_path / "in")
    for part in range(3):
        source(spark, 10, f"batch{part} ", start=part * 5).coalesce(1).write.mode("append").parquet(folder)
    schema = source(spark, 1).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    ingest(stream, table, str(tmp_path / "cp")).start().awaitTermination()
    assert table.count() == 20
    replay = upsert_batches(table)
    before = sorted(map(str, table.rows().collect()))
    batch = spark.createDataFrame(table.get_nodes(["n3"]).collect()).join(table.embeddings(["n3"]), "node_id")
    replay(batch, 0)
    replay(batch, 0)
    assert sorted(map(str, table.rows().collect())) == before


def test_existing_table(spark, tmp_path):
    from nearspan.sources.existing import existing_table

    rows = source(spark, 5).withColumn("price", F.lit(1.5).cast("decimal(8,2)"))
    rows.write.parquet(str(tmp_path / "t"))
    config = TableConfig(dim=DIM, promoted=("price",))
    table, actual = existing_table(spark, config, path=str(tmp_path / "t"))
    assert table.count() == 5 and actual.promoted_type("price") == T.DecimalType(8, 2)
    for bad in (TableConfig(dim=DIM, promoted=("cost",)), TableConfig(dim=DIM, embedding_column="text", text_column="node_id2")):
        with pytest.raises(ValueError):
            existing_table(spark, bad, path=str(tmp_path / "t"))
    with pytest.raises(ValueError):
        existing_table(spark, config)

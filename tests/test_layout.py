"""Bucketed and clustered tables, and metadata whose values keep their types."""

import json

import pytest
from pyspark.sql import functions as F

from nearspan import MetaColumn, TableConfig
from nearspan.operators import buckets, lookup
from nearspan.operators.vector_table import merged_metadata_typed, rebuilt_rows
from nearspan.session import scratch_path


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def bucketed(spark, rows, n=4, keys=("k",), **more):
    path = scratch_path(spark, "test")
    return buckets.write_bucketed(rows, "t_" + path[-12:], list(keys), n, path, **more)


def test_bucketed_tables_shuffle_nothing(spark):
    left = bucketed(spark, spark.range(4000).select((F.col("id") % 500).alias("k"), F.col("id").alias("x")))
    right = bucketed(spark, spark.range(0, 1000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y")))
    assert left.hot_table is None and right.hot_table is None
    joined = buckets.join_bucketed(spark, left, right)
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert joined.count() == 2000 and joined.where("y <> 2 * k").isEmpty()
    totals = buckets.aggregate_bucketed(spark, left, F.sum("x").alias("s"))
    assert "Exchange" not in plan(totals)
    assert totals.where("s <> 8 * k + 500 * 28").isEmpty() and totals.count() == 500


def test_hot_and_null_keys_lie_apart(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 200))
    left = spark.range(3000).select(key.alias("k"), F.col("id").alias("x"))
    other = F.when(F.col("id") < 400, F.lit("k1")).otherwise(F.concat(F.lit("k"), F.col("id") % 90))
    right = spark.range(500).select(other.alias("k"), F.col("id").alias("y"))
    right = right.unionByName(spark.createDataFrame([("hot", -1), (None, -2)], "k string, y long"))
    one, two = bucketed(spark, left), bucketed(spark, right)
    assert sorted(one.hot(spark).groupBy("k").count().collect(), key=str) == [("hot", 1000), (None, 1000)]
    assert [r.k for r in two.hot(spark).select("k").distinct().collect()] == ["k1"]
    assert one.rows(spark).count() == 3000 and two.rows(spark).count() == 502
    want = sorted(map(tuple, left.join(right, "k").select("k", "x", "y").collect()))
    assert sorted(map(tuple, buckets.join_bucketed(spark, one, two).select("k", "x", "y").collect())) == want
    totals = buckets.aggregate_bucketed(spark, one, F.count("*").alias("n"))
    assert sorted(map(repr, totals.collect())) == sorted(map(repr, left.groupBy("k").agg(F.count("*").alias("n")).collect()))


def test_empty_and_faulty_buckets(spark):
    empty = spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("x"))
    table = bucketed(spark, empty)
    assert table.rows(spark).count() == 0 and buckets.join_bucketed(spark, table, bucketed(spark, empty.drop("x"))).count() == 0
    with pytest.raises(ValueError):
        buckets.join_bucketed(spark, table, table)
    with pytest.raises(ValueError):
        buckets.join_bucketed(spark, table, bucketed(spark, empty.drop("x"), 8))
    for bad in ({"n": 0}, {"keys": ()}, {"hot_share": 0.0}):
        with pytest.raises(ValueError):
            bucketed(spark, empty, **bad)


def rows_read(frame):
    """Rows that the scan of a frame gave when it ran."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().get("numOutputRows").get().value()


def test_point_rows_read_few_row_groups(spark, tmp_path):
    rows = spark.range(0, 40_000, 2).select(F.format_string("n%06d", "id").alias("node_id"), F.repeat(F.lit("text "), F.lit(40)).alias("text"), F.rand(1).alias("r"))
    path = str(tmp_path / "t")
    lookup.write_clustered(rows, path, row_group_bytes=64 << 10)
    table = spark.read.parquet(path)
    found = lookup.point_rows(table, ["n000008", "n030000", "n000009"])
    assert {r.node_id for r in found.collect()} == {"n000008", "n030000"}
    assert 2 <= rows_read(found) < 20_000 * 0.2
    # Ids inside the ranges that no row has: only the Bloom filters can rule them out.
    absent = lookup.point_rows(table, [f"n{i:06d}" for i in range(1, 40_000, 2002)])
    assert absent.count() == 0 and rows_read(absent) < 20_000 * 0.2


def test_point_rows_by_frame(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(7).alias("node_id"), F.col("id").alias("x"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1)], "node_id long, x long"))
    lookup.write_clustered(rows, str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert table.count() == 3001
    for n in (0, 5, 2500):
        ids = spark.range(n).select(F.when(F.col("id") != 1, F.col("id")).alias("node_id"), F.lit(1).alias("more"))
        want = sorted(map(tuple, rows.join(ids.select("node_id").distinct(), "node_id", "left_semi").collect()))
        assert sorted(map(tuple, lookup.point_rows(table, ids).collect())) == want


def test_typed_metadata(spark):
    config = TableConfig(dim=2, promoted=(MetaColumn("year", "INT"), MetaColumn("rate", "DOUBLE"), MetaColumn("day", "DATE")))
    data = [
        ("all", '{"year": "old", "n": 12345678901234567, "on": true, "tags": [1, "a", null], "in": {"x": 0.5}, "no": null, "_p": 1}', 1999, 2.5, None),
        ("broken", "{year", 2000, None, None),
        ("list", "[1]", None, None, None),
        ("null", None, None, 1.0, "2024-02-29"),
        ("empty", "{}", None, None, None),
        (None, '{"node_id": "inside"}', None, None, None),
    ]
    rows = spark.createDataFrame([(a, "t", b, c, d, e) for a, b, c, d, e in data], "node_id string, text string, metadata string, year int, rate double, day string")
    rows = rows.withColumn("day", F.col("day").cast("date"))
    merged = {r[0]: json.loads(r[1]) for r in rows.select("node_id", F.to_json(merged_metadata_typed(rows, config))).collect()}
    assert merged["all"] == {"year": 1999, "rate": 2.5, "n": 12345678901234567, "on": True, "tags": [1, "a", None], "in": {"x": 0.5}, "no": None, "_p": 1}
    assert merged["broken"] == {"year": 2000} and merged["list"] == merged["empty"] == {}
    assert merged["null"] == {"rate": 1.0, "day": "2024-02-29"}
    back = {r[0]: json.loads(r[1]) for r in rebuilt_rows(rows, config, typed=True).select("node_id", F.to_json("metadata")).collect()}
    assert "inside" in back and "_p" not in back["all"] and back["all"]["on"] is True

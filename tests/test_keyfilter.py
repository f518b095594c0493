"""Anti joins behind a filter of keys."""

import pytest
from pyspark.sql import functions as F

from nearspan.operators import keyfilter, mutate


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n_keys", [0, 1, 300, 5000])
@pytest.mark.parametrize("bits", [1 << 6, 1 << 28])
def test_large_anti_join(spark, monkeypatch, n_keys, bits):
    monkeypatch.setattr(keyfilter, "MAX_BITS", bits)
    base = spark.range(2000).select(F.when(F.col("id") % 97 > 0, F.concat(F.lit("k"), "id")).alias("node_id"), F.col("id").alias("x"))
    keys = spark.range(n_keys).select(F.when(F.col("id") != 7, F.concat(F.lit("k"), F.col("id") * 3)).alias("node_id"))
    keys = keys.unionByName(keys.limit(50))
    want = sorted(map(repr, base.join(keys, "node_id", "left_anti").collect()))
    assert sorted(map(repr, keyfilter.without_keys(base, keys, ["node_id"], 0).collect())) == want


def test_only_rows_that_the_filter_lets_through_move(spark):
    base = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("node_id"), F.lit("text").alias("text"))
    keys = base.where("crc32(node_id) % 100 = 0").select("node_id")
    marked = keyfilter._marked(base, keys, ["node_id"], keys.count())
    passed, met = marked.where("NOT __met"), marked.where("__met")
    # The words of the bitmap are the only thing that moves for rows that pass on.
    assert "hashpartitioning(node_id" not in plan(passed.select("node_id", "text"))
    assert keys.count() <= met.count() < 20_000 * 0.08
    found = mutate.upsert(base, keys.withColumn("text", F.lit("new")), seq=None, max_bytes=0)
    assert "Union" in plan(found) and "SortMergeJoin" in plan(found)
    assert found.count() == 20_000 and found.where("text = 'new'").count() == keys.count()


def test_keys_of_another_type(spark):
    base = spark.range(100).select(F.col("id").cast("int").alias("k"))
    assert keyfilter.without_keys(base, spark.range(10).toDF("k"), ["k"], 0).count() == 90

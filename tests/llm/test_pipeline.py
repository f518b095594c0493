"""The pipeline over tables of odd rows: empty ones, nulls in every column, repeated rows, further columns."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _id string, _key long, size long, shard int,"
    " key binary, mixed string, `a b.c` string"
)
ITEM = "the seventh comet returned over the quiet harbour while nine old sailors counted lanterns and sang of winter storms"


def prose(seed, n=160):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(3, 9))) for _ in range(n))


def run(spark, root, rows, items=(ITEM,)):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return corpus_pipeline.run(spark, str(root))


def row(doc_id, text, source="a", lang="en"):
    return (doc_id, text, lang, source, None, "x", 3, None, None, b"k", "m", None)


@pytest.mark.parametrize("items", [(ITEM,), ()])
def test_empty_tables(spark, tmp_path, items):
    got = run(spark, tmp_path, [], items)
    assert got.collect() == [] and {"doc_id", "shard", "slot"} <= set(got.columns)


def test_odd_rows(spark, tmp_path):
    clean = {i: prose(i) for i in range(40)}
    rows = [row(i, t, ("a", "b", None)[i % 3], ("en", None)[i % 2]) for i, t in clean.items()]
    rows += [row(100, None), row(101, ""), row(102, " \n\t "), row(103, None, None, None)]
    # Copies of every kind: of a row, of a text, and nearly.
    rows += [rows[0], rows[0], row(50, clean[1]), row(51, clean[2] + " more"), row(None, prose(900))]
    rows += [row(60, f"{prose(60)} {ITEM} {prose(61)}"), row(61, prose(70, 30_000))]
    got = run(spark, tmp_path, rows).collect()
    kept = Counter(r["doc_id"] for r in got)
    assert set(kept) <= {*clean, 61, None} and not set(kept) & {50, 51, 60, 100, 101, 102, 103}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_stages_keep_clean_documents_and_all_columns(spark, tmp_path):
    rows = [row(i, prose(i), ("a", None)[i % 2]) for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = sorted(map(repr, docs.collect()))
    for name, stage in corpus_pipeline.STAGES[:3]:
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns, name
        assert sorted(map(repr, got.collect())) == want, name
    mixed = corpus_pipeline.source_mix(spark, docs, str(tmp_path))
    assert mixed.columns == docs.columns
    assert {repr(r) for r in mixed.collect()} <= set(want)
    sharded = corpus_pipeline.shards(spark, docs.withColumn("slot", F.lit(1)), str(tmp_path))
    assert sharded.count() == len(rows)

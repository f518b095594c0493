"""Postings of metadata keys: the same rows as a plain filter, from fewer files."""

import itertools

import pytest
from pyspark.sql import functions as F

from nearspan import FilterGroup, MetaColumn, MetaFilter, TableConfig
from nearspan.operators import lookup, postings

CONFIG = TableConfig(dim=2, promoted=(MetaColumn("lang", "VARCHAR(8)"),))
TEXTS = [
    '{"kind": "a", "n": 1, "deep": {"x": "p"}}',
    '{"kind": "b", "n": 2.5, "deep": {"x": "q"}}',
    '{"kind": "c", "n": "3", "deep": {"x": null}}',
    '{"kind": null, "n": true}',
    '{"kind": "ä \\"b", "n": "1e3"}',
    "not json",
    "{}",
    None,
]


def frame(spark, texts, first=0):
    rows = [(f"n{first + i:04d}", t, "en" if i % 2 else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "node_id string, metadata string, lang string")


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("a folder with blanks, 100%")
    path, where = str(root / "t"), str(root / "postings")
    postings.write_by_path(frame(spark, TEXTS * 5), path, CONFIG, "kind", 6)
    table = spark.read.parquet(path)
    assert postings.index_metadata(table, where, CONFIG, ["kind", "n", "deep.x"]) == len(table.inputFiles())
    return path, where


def ids(rows):
    return sorted(r["node_id"] for r in rows.select("node_id").collect())


def files_read(rows):
    rows.collect()
    scan = rows._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().get("numFiles").get().value() if scan.metrics().contains("numFiles") else 0


LEAVES = [
    MetaFilter("kind", "a"),
    MetaFilter("kind", 'ä "b'),
    MetaFilter("kind", "nowhere"),
    MetaFilter("kind", "a", "!="),
    MetaFilter("kind", "b", ">="),
    MetaFilter("kind", ["a", "c"], "in"),
    MetaFilter("kind", ["a", None], "in"),
    MetaFilter("kind", ["a", "c"], "nin"),
    MetaFilter("kind", ["a", None], "nin"),
    MetaFilter("kind", None),
    MetaFilter("kind", None, "!="),
    MetaFilter("n", 1),
    MetaFilter("n", 2.5),
    MetaFilter("n", 1000.0, ">="),
    MetaFilter("n", True),
    MetaFilter("n", [3, "1e3"], "in"),
    MetaFilter("deep.x", "p"),
    MetaFilter("deep.x", None),
    MetaFilter("other", "x"),
    MetaFilter("lang", "en"),
]


@pytest.mark.parametrize("leaf", LEAVES, ids=str)
def test_one_comparison(spark, indexed, leaf):
    table = spark.read.parquet(indexed[0])
    assert ids(postings.matching_indexed(table, indexed[1], leaf, CONFIG)) == ids(lookup.matching(table, leaf, CONFIG))


def test_trees(spark, indexed):
    table = spark.read.parquet(indexed[0])
    for (one, two), how in itertools.product(itertools.combinations(LEAVES[::3], 2), ("and", "or")):
        tree = FilterGroup([FilterGroup([one, FilterGroup()], "or"), FilterGroup([two, LEAVES[-1]], how)], how)
        assert ids(postings.matching_indexed(table, indexed[1], tree, CONFIG)) == ids(lookup.matching(table, tree, CONFIG))
    assert postings.matching_indexed(table, indexed[1], FilterGroup(), CONFIG).count() == table.count()


def test_only_possible_files_are_read(spark, indexed):
    table = spark.read.parquet(indexed[0])
    every = len(table.inputFiles())
    held = {r[0] for r in table.where("get_json_object(metadata, '$.kind') = 'a'").select("_metadata.file_path").collect()}
    one = postings.matching_indexed(table, indexed[1], LEAVES[0], CONFIG)
    assert files_read(one) == len(held) < every
    assert postings.matching_indexed(table, indexed[1], LEAVES[2], CONFIG).isEmpty()
    assert postings.possible_files(table, indexed[1], LEAVES[2], CONFIG) == []
    assert len(postings.possible_files(table, indexed[1], LEAVES[-2], CONFIG)) == every


def test_changes_of_the_table(spark, tmp_path):
    path, where = str(tmp_path / "t"), str(tmp_path / "p")
    frame(spark, TEXTS).coalesce(1).write.parquet(path)
    assert postings.index_metadata(spark.read.parquet(path), where, CONFIG, ["kind"]) == 1
    frame(spark, TEXTS, 100).coalesce(1).write.mode("append").parquet(path)
    grown = spark.read.parquet(path)
    assert ids(postings.matching_indexed(grown, where, LEAVES[0], CONFIG)) == ["n0000", "n0100"]
    assert len(postings.possible_files(grown, where, LEAVES[2], CONFIG)) == 1
    assert postings.index_metadata(grown, where, CONFIG, ["kind"]) == 1
    assert postings.index_metadata(grown, where, CONFIG, ["kind"]) == 0
    assert postings.possible_files(grown, where, LEAVES[2], CONFIG) == []
    with pytest.raises(ValueError):
        postings.index_metadata(grown, where, CONFIG, ["kind", "n"])
    with pytest.raises(ValueError):
        postings.index_metadata(grown, where, CONFIG, [])
    frame(spark, TEXTS[:1], 200).coalesce(1).write.mode("overwrite").parquet(path)
    assert ids(postings.matching_indexed(spark.read.parquet(path), where, LEAVES[0], CONFIG)) == ["n0200"]


def test_paths_of_a_table(spark):
    found = {r["path"]: r["n_rows"] for r in postings.metadata_paths(frame(spark, TEXTS), CONFIG).collect()}
    assert found == {"kind": 5, "n": 5, "deep": 3}
    assert postings.metadata_paths(frame(spark, TEXTS).limit(0), CONFIG).collect() == []

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from nearspan import FilterGroup, MetaColumn, MetaFilter, TableConfig
from nearspan.functions.filters import predicate
from nearspan.operators.lookup import browse, by_values, first_rows, search_by_metadata
from nearspan.operators.mutate import delete_by_filters, delete_nodes, keep_unless

JSON = TableConfig(dim=2)
TYPED = TableConfig(
    dim=2,
    promoted=(
        MetaColumn("score", "TEXT"),
        MetaColumn("price", "DECIMAL(10,2)"),
        MetaColumn("made", "DATETIME"),
        MetaColumn("ok", "BOOLEAN"),
    ),
)


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        ("a", '{"s": 9, "c": "x", "b": true, "n": {"d": 1}, "n.d": 7}'),
        ("b", '{"s": 30, "c": "y", "b": false, "z": null}'),
        ("c", '{"s": 100, "c": "X"}'),
        ("d", '{"s": "zz"}'),
        ("e", "broken"),
        ("f", "[1, 2]"),
        ("g", None),
        ("h", '{"s": "30"}'),
    ]
    return spark.createDataFrame(data, "node_id string, metadata string")


@pytest.fixture(scope="module")
def typed(spark):
    data = [
        ("a", "9", Decimal("1.50"), datetime.datetime(2024, 1, 1), True),
        ("b", "30", Decimal("20.00"), datetime.datetime(2025, 1, 1), False),
        ("c", "100", None, None, None),
        ("d", "zz", Decimal("3.25"), datetime.datetime(2023, 5, 5), True),
    ]
    schema = "node_id string, score string, price decimal(10,2), made timestamp, ok boolean"
    return spark.createDataFrame(data, schema).withColumn("metadata", F.lit("{}"))


def ids(frame, tree, config=JSON):
    wanted = predicate(tree, config)
    return "".join(sorted(r["node_id"] for r in frame.where(wanted).collect()))


@pytest.mark.parametrize(
    "key, value, operator, expected",
    [
        ("s", 30, "==", "bh"),
        ("s", 30.0, "==", "bh"),
        ("s", "30", "==", "bh"),
        ("s", 30, "!=", "ac"),
        ("s", 9, ">", "bch"),
        ("s", 30, ">=", "bch"),
        ("s", 30, "<", "a"),
        ("s", 30, "<=", "abh"),
        ("s", "30", "<", "c"),
        ("s", [9, 100], "in", "ac"),
        ("s", ["9", "zz"], "in", "ad"),
        ("s", [9, "zz"], "in", "ad"),
        ("s", [9, 100], "nin", "bh"),
        ("c", ["x"], "nin", "bc"),
        ("c", "x", "==", "a"),
        ("c", "x", "!=", "bc"),
        ("b", True, "==", "a"),
        ("b", False, "==", "b"),
        ("b", True, "!=", "b"),
        ("s", None, "==", "efg"),
        ("s", None, "!=", "abcdh"),
        ("z", None, "==", "abcdefgh"),
        ("n.d", 1, "==", "a"),
        ("n.d", 7, "==", ""),
        ("absent", 1, "!=", ""),
        ("s", [None, 9], "in", "a"),
        ("s", [None, 9], "nin", ""),
    ],
)
def test_json_keys(rows, key, value, operator, expected):
    assert ids(rows, MetaFilter(key, value, operator)) == expected


@pytest.mark.parametrize(
    "key, value, operator, expected",
    [
        ("score", 30, ">=", "bc"),
        ("score", "30", "==", "b"),
        ("price", 2, ">", "bd"),
        ("price", "20", "==", "b"),
        ("price", "oops", "==", ""),
        ("price", None, "==", "c"),
        ("price", [1.5, 3.25], "in", "ad"),
        ("price", [1.5], "nin", "bd"),
        ("made", "2024-01-01", ">=", "ab"),
        ("made", datetime.datetime(2024, 1, 1), "==", "a"),
        ("made", "never", "<", ""),
        ("ok", True, "==", "ad"),
        ("ok", "false", "==", "b"),
    ],
)
def test_promoted_columns(typed, key, value, operator, expected):
    assert ids(typed, MetaFilter(key, value, operator), TYPED) == expected


def test_trees(rows):
    small, big = MetaFilter("s", 10, "<"), MetaFilter("s", 90, ">")
    assert ids(rows, FilterGroup([small, big], "or")) == "ac"
    assert ids(rows, FilterGroup([small, big])) == ""
    deep = FilterGroup([FilterGroup([small, FilterGroup([big], "or")], "or"), MetaFilter("c", "x"), FilterGroup()])
    assert ids(rows, deep) == "a"
    assert predicate(FilterGroup([FilterGroup()]), JSON) is None


@pytest.mark.parametrize(
    "arguments",
    [
        ("k", [1], "=="),
        ("k", (1,), ">"),
        ("k", "abc", "in"),
        ("k", [], "in"),
        ("k", [], "nin"),
        ("k", 1, "in"),
        ("k", None, ">"),
        ("k", None, "in"),
        ("k", 1, "like"),
        ("k'x", 1, "=="),
    ],
)
def test_rejected_filters(arguments):
    with pytest.raises(ValueError):
        MetaFilter(*arguments)


def test_rejected_groups():
    with pytest.raises(ValueError):
        FilterGroup([MetaFilter("a", 1)], "not")
    with pytest.raises(ValueError):
        FilterGroup(["a = 1"])


def test_rejected_values_and_keys():
    with pytest.raises(ValueError):
        predicate(MetaFilter("a", {"x": 1}), JSON)
    config = TableConfig(dim=2, metadata_column=None, promoted=("a",))
    with pytest.raises(ValueError):
        predicate(MetaFilter("b", 1), config)


def test_promoted_filter_reaches_the_scan(spark, typed, tmp_path):
    typed.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = table.where(predicate(MetaFilter("price", Decimal("2.00"), ">"), TYPED))
    text = plan._jdf.queryExecution().toString()
    assert "GreaterThan(price,2.00)" in text


def test_values_frame(spark, rows):
    values = spark.createDataFrame([("x",), (None,), ("x",)], "v string")
    key = F.get_json_object("metadata", "$.c")
    assert sorted(r.node_id for r in by_values(rows, key, values).collect()) == ["a"]
    assert sorted(r.node_id for r in by_values(rows, key, values, negate=True).collect()) == ["b", "c"]


def test_delete_keeps_unknown(rows):
    left = delete_by_filters(rows, MetaFilter("s", 30), JSON)
    assert sorted(r.node_id for r in left.collect()) == list("acdefg")
    assert keep_unless(rows, F.lit(None).cast("boolean")).count() == 8
    with pytest.raises(ValueError):
        delete_by_filters(rows, FilterGroup([FilterGroup()]), JSON)


def test_delete_nodes_precedence(rows):
    assert delete_nodes(rows, JSON).count() == 8
    assert delete_nodes(rows, JSON, filters=FilterGroup()).count() == 8
    both = delete_nodes(rows, JSON, ["a", "nope"], MetaFilter("s", 30))
    assert sorted(r.node_id for r in both.collect()) == list("bcdefgh")


def test_browse(rows):
    assert browse(rows, JSON, [], None).count() == 8
    assert [r.node_id for r in browse(rows, JSON, limit=3).collect()] == ["a", "b", "c"]
    assert browse(rows, JSON, ["a", "zz", "a"], MetaFilter("s", 30)).count() == 1
    assert browse(rows, JSON, filters=FilterGroup([FilterGroup()])).count() == 8
    with pytest.raises(ValueError):
        search_by_metadata(rows, FilterGroup(), JSON)
    with pytest.raises(ValueError):
        search_by_metadata(rows, MetaFilter("s", 1), JSON, limit=0)


def test_large_limit_takes_the_first_rows(spark):
    frame = spark.range(0, 9000, numPartitions=7).select(F.format_string("%05d", "id").alias("node_id"))
    got = [r.node_id for r in first_rows(frame, 4000).collect()]
    assert got == [f"{i:05d}" for i in range(4000)]

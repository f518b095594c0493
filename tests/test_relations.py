import datetime

import pytest
from pyspark.sql import functions as F

from nearspan import PartitionSpec, create_partitioned_table, run_sql
from nearspan.functions.text import shorten
from nearspan.operators import partition
from nearspan.operators.sizing import broadcast_if_small
from nearspan.session import scratch_path
from nearspan.sources import catalog

RANGE = PartitionSpec(
    "range",
    "val",
    defs=[
        {"name": "low", "values_less_than": -4},
        {"name": "mid", "values_less_than": 37},
        {"name": "high", "values_less_than": 640},
        {"name": "rest", "values_less_than": "maxvalue"},
    ],
)
LIST = PartitionSpec(
    "LIST", "name", defs=[{"name": "a", "values_in": ["l'été", 'a "b"']}, {"name": "b", "values_in": ["y", None]}]
)


def homes(rows, spec):
    return [r.p for r in partition.with_partition(rows, spec).collect()]


def test_range_bounds(spark):
    rows = spark.createDataFrame([(-90,), (-5,), (-4,), (36,), (37,), (639,), (640,), (None,)], "val int")
    assert homes(rows, RANGE) == ["low", "low", "mid", "mid", "high", "high", "rest", "low"]
    assert RANGE.overlapping(-5, 36) == ["low", "mid"]
    assert RANGE.overlapping(low=640) == ["rest"]
    assert RANGE.overlapping(high=-5) == ["low"]


def test_range_without_top(spark):
    spec = PartitionSpec("RANGE", "val", defs=[{"name": "only", "values_less_than": 8}])
    rows = spark.createDataFrame([(7,), (8,), (9,)], "val int")
    assert homes(rows, spec) == ["only", None, None]
    with pytest.raises(ValueError, match="2 rows"):
        partition.write_partitioned(rows, scratch_path(spark, "t"), spec)


def test_range_of_dates(spark):
    spec = PartitionSpec(
        "RANGE", "at", defs=[{"name": "old", "values_less_than": "2024-01-01"}, {"name": "new", "values_less_than": "MAXVALUE"}]
    )
    rows = spark.createDataFrame([(datetime.datetime(2023, 12, 31, 23),), (datetime.datetime(2024, 1, 1),)], "at timestamp")
    assert homes(rows, spec) == ["old", "new"]
    assert homes(spark.createDataFrame([("2023-05-05",), ("2025-01-01",)], "at string"), spec) == ["old", "new"]


def test_list_values(spark):
    rows = spark.createDataFrame([("l'été",), ("y",), (None,), ("other",)], "name string")
    assert homes(rows, LIST) == ["a", "b", "b", None]
    with pytest.raises(ValueError, match="1 rows"):
        partition.assert_partitioned(rows, LIST)
    strict = PartitionSpec("LIST", "name", defs=[{"name": "a", "values_in": ["x"]}])
    assert homes(spark.createDataFrame([("x",), (None,)], "name string"), strict) == ["a", None]


def test_hash_and_key(spark):
    rows = spark.createDataFrame([(0,), (5,), (-3,), (None,)], "val long")
    assert homes(rows, PartitionSpec("HASH", "val", 4)) == [0, 1, 1, 0]
    names = spark.createDataFrame([("a",), ("b",), ("a",)], "val string")
    found = homes(names, PartitionSpec("KEY", "val", 8))
    assert found[0] == found[2] and all(0 <= p < 8 for p in found)


@pytest.mark.parametrize(
    "arguments",
    [
        {"kind": "HASH", "column": "a"},
        {"kind": "KEY", "column": "a", "partitions": -1},
        {"kind": "HASH", "column": "a b", "partitions": 2},
        {"kind": "ROUND", "column": "a", "partitions": 2},
        {"kind": "RANGE", "column": "a"},
        {"kind": "LIST", "column": "a", "defs": []},
        {"kind": "RANGE", "column": "a", "defs": [{"values_less_than": 1}]},
        {"kind": "RANGE", "column": "a", "defs": [{"name": "p"}]},
        {"kind": "RANGE", "column": "a", "defs": [{"name": "p-1", "values_less_than": 1}]},
        {"kind": "LIST", "column": "a", "defs": [{"name": "p"}]},
        {"kind": "LIST", "column": "a", "defs": [{"name": "p", "values_in": []}]},
        {"kind": "RANGE", "column": "a", "defs": [{"name": "p", "values_less_than": 5}, {"name": "q", "values_less_than": 5}]},
        {
            "kind": "RANGE",
            "column": "a",
            "defs": [{"name": "p", "values_less_than": "MAXVALUE"}, {"name": "q", "values_less_than": 5}],
        },
        {"kind": "LIST", "column": "a", "defs": [{"name": "p", "values_in": [1]}, {"name": "p", "values_in": [2]}]},
    ],
)
def test_rejected_specs(arguments):
    with pytest.raises(ValueError):
        PartitionSpec(**arguments)


def test_written_table_prunes(spark):
    path = scratch_path(spark, "t")
    rows = spark.range(2000).select(F.col("id").alias("val"), (F.col("id") * 2).alias("other"))
    partition.write_partitioned(rows, path, RANGE)
    table = partition.read_partitioned(spark, path)
    assert {r.p: r["count"] for r in table.groupBy("p").count().collect()} == {"mid": 37, "high": 603, "rest": 1360}
    one = partition.where_key(table, RANGE, 150)
    assert one.count() == 1
    scans = [line for line in one._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in line]
    assert scans and "high" in scans[-1]
    assert len(one.inputFiles()) < len(table.inputFiles()) or len(table.inputFiles()) == 3
    assert partition.where_between(table, RANGE, 90, 110).count() == 21
    with pytest.raises(Exception):
        partition.write_partitioned(rows, path, RANGE)
    partition.write_partitioned(rows, path, RANGE, mode="ignore")
    assert partition.read_partitioned(spark, path).count() == 2000


def test_hot_key_keeps_every_row(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("val"))
    spec = PartitionSpec("KEY", "val", 16)
    path = scratch_path(spark, "t")
    partition.write_partitioned(rows, path, spec)
    table = partition.read_partitioned(spark, path)
    assert table.count() == 3000
    assert table.groupBy("val").agg(F.count_distinct("p").alias("n")).where("n > 1").count() == 0
    assert partition.where_key(table, spec, 7).count() == 1001


def test_report_shows_unmatched(spark):
    spec = PartitionSpec("LIST", "val", defs=[{"name": "one", "values_in": [1]}])
    report = {r.p: r for r in partition.partition_report(spark.createDataFrame([(1,), (1,), (3,)], "val int"), spec).collect()}
    assert report["one"].n_rows == 2 and report[None].min_key == 3


def test_catalog_table(spark):
    name = "tides_" + scratch_path(spark, "x")[-8:]
    spec = PartitionSpec("HASH", "gauge", 3)
    columns = [("reading", "BIGINT"), ("gauge", "BIGINT"), ("level", "DECIMAL(7,3)")]
    path = scratch_path(spark, "t")
    create_partitioned_table(spark, name, columns, spec, path=path)
    create_partitioned_table(spark, name, columns, spec, path=path)
    with pytest.raises(Exception):
        create_partitioned_table(spark, name, columns, spec, path=path, if_not_exists=False)
    partition.insert_rows(spark.createDataFrame([(1, 10, "0.125"), (2, 9, None)], "reading int, gauge int, level string"), name, spec)
    partition.insert_rows(spark.createDataFrame([(3, 5)], "reading int, gauge int"), name, spec)
    rows = {r.reading: (r.p, r.level) for r in spark.table(name).collect()}
    assert rows[1][0] == 1 and str(rows[1][1]) == "0.125" and rows[3] == (2, None)
    with pytest.raises(ValueError):
        partition.insert_rows(spark.createDataFrame([(3, 5)], "reading int, nope int"), name)
    with pytest.raises(ValueError):
        create_partitioned_table(spark, "t", columns, spec, broadcast=True)
    with pytest.raises(ValueError):
        create_partitioned_table(spark, "bad name", columns)
    assert name in {r.table_name for r in catalog.list_tables(spark).collect()}
    spark.sql(f"DROP TABLE {name}")


def test_broadcast_is_checked(spark):
    facts, small = spark.range(1000).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    joined = partition.join_dimension(facts, small, "k")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    large = broadcast_if_small(facts, max_rows=10)
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    wide = spark.range(5).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert "ResolvedHint" not in broadcast_if_small(wide, max_bytes=1000)._jdf.queryExecution().analyzed().toString()


# Catalog and SQL


def test_usable_tables():
    assert catalog.usable_tables("abc") == ["a", "b", "c"]
    assert catalog.usable_tables("abc", include=["b"]) == ["b"]
    assert catalog.usable_tables("abc", ignore=["b"]) == ["a", "c"]
    for options in ({"include": ["a"], "ignore": ["b"]}, {"include": ["z"]}, {"ignore": ["z"]}):
        with pytest.raises(ValueError):
            catalog.usable_tables("abc", **options)


def test_views_on_request(spark):
    spark.range(3).createOrReplaceTempView("some_view")
    assert "some_view" not in {r.table_name for r in catalog.list_tables(spark).collect()}
    assert "some_view" in {r.table_name for r in catalog.list_tables(spark, views=True).collect()}


def test_broken_table_is_skipped(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good.parquet"))
    (tmp_path / "bad.parquet").write_text("not parquet")
    tables, status = catalog.load_tables(spark, catalog.folder_tables(spark, str(tmp_path)))
    assert list(tables) == ["good"]
    rows = {r.table_name: r for r in status.collect()}
    assert rows["good"].status == "ok" and rows["bad"].status == "error" and rows["bad"].message
    assert catalog.profile_folder(spark, str(tmp_path)).count() == 1


def test_profile_with_distinct(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", [1]), (2, None, [1])], "x int, t string, l array<int>")
    profile = {r.column_name: r for r in catalog.table_profile({"t": rows}, "exact").collect()}
    assert (profile["x"].min_number, profile["x"].max_number, profile["x"].n_distinct) == (1.0, 2.0, 2)
    assert (profile["t"].n_nulls, profile["t"].min_text, profile["l"].n_nulls) == (1, "a", 1)
    assert catalog.table_profile({"t": rows}, "approx").where("column_name = 'x'").first().n_distinct == 2


def test_shorten(spark):
    def cut(text, n):
        return spark.createDataFrame([(text,)], "t string").select(shorten(F.col("t"), n)).first()[0]

    assert cut("short", 10) == "short"
    assert cut(None, 10) is None
    assert cut("one two three four", 13) == "one two..."
    assert cut("abcdefghijklmnop", 10) == "abcdefg..."
    assert cut("x" * 400, 300) == "x" * 297 + "..."
    assert cut("anything", 0) == "anything"


def test_sql(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "id int, e array<float>")
    rows = run_sql(spark, "SELECT id, vec_distance_cosine(e, vec_fromtext('[1, 0]')) AS d FROM t ORDER BY d, id", {"t": table})
    assert [tuple(r) for r in rows.collect()] == [(1, 0.0), (2, 1.0)]
    row = run_sql(
        spark,
        "SELECT vector_dim(e) AS n, vec_totext(e) AS t, vec_distance_euclidean(e, e) AS z,"
        " vec_distance_inner_product(e, e) AS p, vec_distance(e, array(0f, 0f)) AS undefined FROM t WHERE id = 2",
        {"t": table},
    ).first()
    assert tuple(row) == (2, "[0.0,2.0]", 0.0, -4.0, None)
    with pytest.raises(Exception):
        run_sql(spark, "SELECT nothing FROM nowhere")
    assert run_sql(spark, "SELECT repeat('ab ', 200) AS t", max_string_length=20).first().t == "ab ab ab ab ab..."


def test_damaged_files_are_told_apart(spark, tmp_path):
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.array("id").alias("list"))
    for name in ("good", "footer", "pages"):
        rows.repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    parts = {name: sorted((tmp_path / f"{name}.parquet").glob("part-*")) for name in ("good", "footer", "pages")}
    data = parts["footer"][1].read_bytes()
    parts["footer"][1].write_bytes(data[:-4] + b"XXXX")
    data = parts["pages"][0].read_bytes()
    parts["pages"][0].write_bytes(data[: len(data) // 3] + bytes(20_000) + data[len(data) // 3 + 20_000 :])
    (tmp_path / "empty.parquet").write_bytes(b"nothing")
    for name in ("footer", "pages"):
        for part in tmp_path.glob(f"{name}.parquet/.*.crc"):
            part.write_bytes(b"")
            part.unlink()
    paths = catalog.folder_tables(spark, str(tmp_path))
    files = catalog.file_report(spark, paths).collect()
    status = {(r["table_name"], r["file"]): r["status"] for r in files}
    assert {s for (t, _), s in status.items() if t == "good"} == {"ok"}
    assert [status["footer", p.name] for p in parts["footer"]] == ["ok", "footer", "ok"]
    assert [status["pages", p.name] for p in parts["pages"]] == ["pages", "ok", "ok"]
    assert status["empty", "empty.parquet"] == "footer"
    report = {r["table_name"]: (r["status"], r["n_files"]) for r in catalog.table_report(catalog.file_report(spark, paths)).collect()}
    assert report == {"good": ("ok", 3), "footer": ("error", 3), "pages": ("error", 3), "empty": ("error", 1)}
    tables, seen = catalog.load_tables(spark, paths, verify=True)
    assert list(tables) == ["good"] and seen.where("status = 'ok'").count() == 1
    profile = catalog.profile_folder(spark, str(tmp_path)).collect()
    assert {(r["table_name"], r["column_name"], r["n_rows"]) for r in profile} == {("good", c, 60_000) for c in rows.columns}


def test_exact_distinct_counts_go_column_by_column(spark):
    rows = spark.createDataFrame(
        [(1, "a", [1.0], {"k": 1}), (1, None, [1.0], None), (2, "b", None, {"k": 1})],
        "x int, t string, v array<double>, m map<string,int>",
    )
    profile = catalog.table_profile({"t": rows}, "exact")
    assert [r.n_distinct for r in profile.orderBy(F.expr("locate(column_name, 'xtvm')")).collect()] == [2, 2, 1, None]
    # Counted in one aggregate, each row is repeated per column and, with texts, sorted whole.
    assert "Expand" not in profile._jdf.queryExecution().toString()
    only = catalog.table_profile({"t": rows.select("m")}, "exact")
    assert [(r.n_rows, r.n_distinct) for r in only.collect()] == [(3, None)]

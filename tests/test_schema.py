import pytest
from pyspark.sql import types as T

from nearspan.schema import MetaColumn, TableConfig, check_key, check_name, spark_type


@pytest.mark.parametrize("name", ["", "1a", "a-b", "a b", "a;b", "x" * 65, "é"])
def test_bad_names(name):
    with pytest.raises(ValueError):
        check_name(name)


@pytest.mark.parametrize("key", ["", ".a", "a-b", "a'b", "a b", "$x"])
def test_bad_keys(key):
    with pytest.raises(ValueError):
        check_key(key)


def test_good_names():
    assert check_name("_a9") == "_a9"
    assert check_key("a.b_c") == "a.b_c"


@pytest.mark.parametrize(
    "declared, expected",
    [
        ("VARCHAR(64)", T.StringType()),
        ("decimal(10,2)", T.DecimalType(10, 2)),
        ("INT", T.IntegerType()),
        ("BIGINT UNSIGNED", T.LongType()),
        ("DATETIME", T.TimestampType()),
        ("LONGTEXT", T.StringType()),
        ("ENUM('a','b')", T.StringType()),
        ("JSON", T.StringType()),
    ],
)
def test_types(declared, expected):
    assert spark_type(declared) == expected


def test_unknown_type():
    with pytest.raises(ValueError):
        MetaColumn("a", "GEOMETRY")


def test_names_must_differ():
    with pytest.raises(ValueError):
        TableConfig(promoted=("text",))
    with pytest.raises(ValueError):
        TableConfig(text_column="metadata")
    with pytest.raises(ValueError):
        TableConfig(promoted=("a", "a"))


def test_some_place_for_metadata():
    with pytest.raises(ValueError):
        TableConfig(metadata_column=None)
    config = TableConfig(metadata_column=None, promoted=("a",))
    assert "metadata" not in config.schema.names


def test_bad_metric_and_dim():
    with pytest.raises(ValueError):
        TableConfig(metric="manhattan")
    with pytest.raises(ValueError):
        TableConfig(dim=0)
    with pytest.raises(ValueError):
        TableConfig(dim=True)

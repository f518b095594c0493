"""Postings of metadata: which files hold which values of a key that has no column of its own.

A posting is ``(path, value, file, n_rows)``.  Postings lie beside the table as Parquet in the order of path and value,
so a comparison with a text reads few of their row groups.  A filter is first asked of the postings, file by file; only
files that may hold a match are read, and the filter itself decides on their rows.  Files that were written after the
index are always read, files that are gone are forgotten, so a table may change under its index.

The driver holds names of files, as Spark does for every table, and never values or rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.functions.filters import FilterGroup, MetaFilter, compared, predicate
from nearspan.functions.metadata import read_key
from nearspan.schema import TableConfig, check_key
from nearspan.sources.files import exists

SCHEMA = "path string, value string, file string, n_rows long"
FILE = "_metadata.file_path"


def metadata_paths(table: DataFrame, config: TableConfig) -> DataFrame:
    """``path, n_rows`` of all top-level keys that a filter can name; the candidates for an index."""
    keys = table.select(F.explode(F.json_object_keys(config.metadata_column)).alias("path"))
    return keys.where(F.col("path").rlike("^[a-zA-Z_][a-zA-Z0-9_]*$")).groupBy("path").agg(F.count("*").alias("n_rows"))


def write_by_path(rows: DataFrame, where: str, config: TableConfig, path: str, files: int) -> None:
    """Rows written so that equal values of a key meet in few files; a value that fills files is spread over them."""
    value = read_key(F.col(config.metadata_column), check_key(path))
    spread = F.xxhash64(config.node_id_column)
    ordered = rows.withColumn("__value", value).repartitionByRange(files, "__value", spread)
    ordered.drop("__value").write.parquet(where)


def index_metadata(table: DataFrame, where: str, config: TableConfig, paths: Sequence[str]) -> int:
    """Postings of the files of a table that ``where`` has none of yet; the number of these files.

    ``table`` is a plain read of files.  A path may walk into nested objects.  The paths of an index are those of its
    first call; a later call with others is refused.  Rows in which a key is absent, or JSON null, count in
    the posting of its path that has no value.
    """
    spark, wanted = table.sparkSession, sorted({check_key(p) for p in paths})
    if not wanted:
        raise ValueError("an index of metadata needs at least one path")
    known: set[str] = set()
    if exists(spark, where):
        if indexed_paths(spark, where) != wanted:
            raise ValueError(f"the index has the paths {indexed_paths(spark, where)}, not {wanted}")
        known = _files(spark, where)
    new = _current(table) - known
    if not new:
        return 0
    rows = table.select(F.col(config.metadata_column).alias("json"), F.col(FILE).alias("file"))
    rows = rows.where(F.col("file").isin(sorted(new)))
    # The posting without a path counts the rows of the file and says that it is indexed.
    pairs = [F.struct(*[F.lit(None).cast("string").alias(c) for c in ("path", "value")])]
    pairs += [F.struct(F.lit(p).alias("path"), read_key(F.col("json"), p).alias("value")) for p in wanted]
    found = rows.select("file", F.explode(F.array(*pairs)).alias("p")).select("p.*", "file")
    counted = found.groupBy("path", "value", "file").agg(F.count("*").alias("n_rows"))
    ordered = counted.repartitionByRange("path", "value", "file").sortWithinPartitions("path", "value", "file")
    ordered.write.mode("append").parquet(where)
    return len(new)


def postings(spark: SparkSession, where: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(where)


def indexed_paths(spark: SparkSession, where: str) -> list[str]:
    rows = postings(spark, where).where("path IS NOT NULL").select("path").distinct().collect()
    return sorted(r["path"] for r in rows)


def _current(table: DataFrame) -> set[str]:
    """The files of a table, written as ``_metadata`` writes them (a local path with one slash)."""
    return {"file:/" + f.removeprefix("file:///") if f.startswith("file:///") else f for f in table.inputFiles()}


def _files(spark: SparkSession, where: str) -> set[str]:
    return {r["file"] for r in postings(spark, where).where("path IS NULL").select("file").distinct().collect()}


def possible_files(
    table: DataFrame, where: str, filters: MetaFilter | FilterGroup | None, config: TableConfig
) -> list[str]:
    """The current files of a table that may hold a match: those that the postings admit, and those without any."""
    spark = table.sparkSession
    current, known = _current(table), _files(spark, where)
    paths = set(indexed_paths(spark, where))
    leaves = [leaf for leaf in _leaves(filters) if _answers(leaf, config, paths)]
    if not leaves:
        return sorted(current)
    rows = postings(spark, where)
    # Only the postings of the named paths are read, and of a path that is compared with one text only that value's.
    wanted = reduce(lambda a, b: a | b, [_read(leaf) for leaf in leaves])
    flags = [F.sum(F.when(_holds(leaf), F.col("n_rows"))).alias(f"n{i}") for i, leaf in enumerate(leaves)]
    per_file = rows.where(F.col("path").isNull() | wanted)
    per_file = per_file.groupBy("file").agg(*flags)
    places = {id(leaf): F.coalesce(F.col(f"n{i}"), F.lit(0)) > 0 for i, leaf in enumerate(leaves)}
    admitted = per_file.where(_tree(filters, places)).select("file").collect()
    return sorted(({r["file"] for r in admitted} & current) | (current - known))


def matching_indexed(
    table: DataFrame, where: str, filters: MetaFilter | FilterGroup | None, config: TableConfig
) -> DataFrame:
    """``lookup.matching`` that reads only the files which the postings in ``where`` admit."""
    wanted = predicate(filters, config)
    if wanted is None:
        return table
    files = possible_files(table, where, filters, config)
    return table.where(F.col(FILE).isin(files) if files else F.lit(False)).where(wanted)


def _leaves(filters: MetaFilter | FilterGroup | None) -> Iterable[MetaFilter]:
    if isinstance(filters, MetaFilter):
        yield filters
    elif filters is not None:
        for part in filters.filters:
            yield from _leaves(part)


def _answers(leaf: MetaFilter, config: TableConfig, paths: set[str]) -> bool:
    return leaf.key in paths and config.promoted_type(leaf.key) is None


def _read(leaf: MetaFilter) -> Column:
    own = F.col("path") == leaf.key
    if leaf.operator == "==" and isinstance(leaf.value, str):
        return own & (F.col("value") == leaf.value)
    if leaf.operator == "in" and all(isinstance(v, str) for v in leaf.value):
        return own & F.col("value").isin(list(leaf.value))
    return own


def _holds(leaf: MetaFilter) -> Column:
    return (F.col("path") == leaf.key) & compared(F.col("value"), T.StringType(), leaf)


def _tree(filters: MetaFilter | FilterGroup, places: dict[int, Column]) -> Column:
    """Whether a file may hold a match; a comparison that the postings don't know may hold anywhere."""
    if isinstance(filters, MetaFilter):
        return places.get(id(filters), F.lit(True))
    parts = [_tree(p, places) for p in filters.filters if isinstance(p, MetaFilter) or any(True for _ in _leaves(p))]
    return reduce((lambda a, b: a & b) if filters.condition == "and" else (lambda a, b: a | b), parts)

"""Tables of a folder or of the catalog: listing, profiles, and SQL over them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.functions.distance import register_sql_functions
from nearspan.functions.text import shorten
from nearspan.operators.lookup import first_rows
from nearspan.sources.files import children, data_files
from nearspan.session import small_frame

SAMPLE_ROWS = 3
MAX_STRING_LENGTH = 300
PROFILE_COLUMNS = ["column_name", "data_type", "n_nulls", "min_number", "max_number", "min_text", "max_text"]


def usable_tables(
    names: Iterable[str], include: Iterable[str] | None = None, ignore: Iterable[str] | None = None
) -> list[str]:
    """The names asked for, or all but the ignored ones; unknown names are an error."""
    known, wanted, unwanted = set(names), set(include or ()), set(ignore or ())
    if wanted and unwanted:
        raise ValueError("give tables to include or tables to ignore, not both")
    missing = (wanted | unwanted) - known
    if missing:
        raise ValueError(f"tables not found: {sorted(missing)}")
    return sorted(wanted or known - unwanted)


def list_tables(
    spark: SparkSession,
    include: Iterable[str] | None = None,
    ignore: Iterable[str] | None = None,
    views: bool = False,
    database: str | None = None,
) -> DataFrame:
    """Usable tables of the catalog, with views only on request."""
    found = {t.name: t.tableType for t in spark.catalog.listTables(database)}
    kinds = {n: k for n, k in found.items() if views or k not in ("VIEW", "TEMPORARY")}
    rows = [(name, kinds[name]) for name in usable_tables(kinds, include, ignore)]
    return small_frame(spark, rows, "table_name string, table_type string")


def folder_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and path of each Parquet table in a folder."""
    return {n.removesuffix(".parquet"): f"{folder}/{n}" for n in children(spark, folder) if n.endswith(".parquet")}


def file_report(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One row per file of the tables: ``(table_name, file, n_rows, n_read, status)``.

    ``n_rows`` is what the file's footer says and ``n_read`` how many rows could be read with all their columns.  The
    status is ``ok``, ``footer`` (no footer can be read) or ``pages`` (fewer rows than the footer says).  Files are
    checked by the tasks that read them, the whole table as one job; page checksums are verified where there are any.
    """
    rows = [row for name, path in sorted(paths.items()) for row in _files_of(spark, name, path)]
    return small_frame(spark, rows, "table_name string, file string, n_rows long, n_read long, status string")


def _files_of(spark: SparkSession, name: str, path: str) -> list[tuple]:
    """A row per file of a table; like the listing, that much is on the driver."""
    files = data_files(spark, path)
    reader = spark.read.option("ignoreCorruptFiles", "true").option("parquet.page.verify-checksum.enabled", "true")
    try:
        table = reader.parquet(path)
    except AnalysisException:
        # Not one footer tells a schema.
        counts = {}
    else:
        columns = [_hashed(F.col(f"`{f.name}`"), f.dataType) for f in table.schema.fields]
        file = F.element_at(F.split(F.url_decode("_metadata.file_path"), "/"), -1).alias("file")
        # Without columns only footers are read.
        rows = table.select(file).groupBy("file").agg(F.count("*").alias("n_rows"))
        read = table.select(file, F.xxhash64(*columns).alias("digest") if columns else F.lit(0).alias("digest"))
        # The digest is kept: a count alone would read no column.
        read = read.groupBy("file").agg(F.count("*").alias("n_read"), F.bit_xor("digest").alias("digest"))
        counts = {r["file"]: (r["n_rows"], r["n_read"] or 0) for r in rows.join(read, "file", "left").collect()}
    # A file of which no row came is empty, or has no footer.
    opens = _opening(spark, [f for n, f in files if n not in counts])
    out = []
    for short, full in files:
        n_rows, n_read = counts.get(short, (0, 0))
        status = "pages" if n_read < n_rows else "ok" if short in counts or full in opens else "footer"
        out.append((name, short, n_rows, n_read, status))
    return out


def _opening(spark: SparkSession, files: list[str]) -> set[str]:
    """Those of the files that have a footer; all footers are read in one job, and by halves if one is damaged."""
    if not files:
        return set()
    try:
        spark.read.option("mergeSchema", "true").parquet(*files)
        return set(files)
    except Exception:
        half = len(files) // 2
        return _opening(spark, files[:half]) | _opening(spark, files[half:]) if half else set()


def _hashed(value: Column, kind: T.DataType) -> Column:
    """The value in a form that can be hashed."""
    return F.to_json(F.struct(value)) if isinstance(kind, (T.MapType, T.VariantType)) else value


def table_report(files: DataFrame) -> DataFrame:
    """One row per table: ``(table_name, status, message, n_files, n_rows)``; a table is ``ok`` if all its files are."""
    bad = [F.count_if(F.col("status") == s) for s in ("footer", "pages")]
    return files.groupBy("table_name").agg(
        F.when(bad[0] + bad[1] > 0, "error").otherwise("ok").alias("status"),
        F.when(
            bad[0] + bad[1] > 0,
            F.format_string("%d of %d files have no readable footer, %d have unreadable pages", bad[0], F.count("*"), bad[1]),
        ).alias("message"),
        F.count("*").alias("n_files"),
        F.sum("n_rows").alias("n_rows"),
    )


def load_tables(
    spark: SparkSession, paths: Mapping[str, str], verify: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Every table that opens, and a status row per table; one that does not open is skipped.

    ``verify`` reads all tables through and skips those with a damaged file, too.
    """
    tables, status, bad = {}, [], {}
    if verify and paths:
        checked = table_report(file_report(spark, paths)).collect()
        bad = {r["table_name"]: r["message"] for r in checked if r["status"] != "ok"}
    for name, path in sorted(paths.items()):
        if name in bad:
            status.append((name, "error", bad[name]))
            continue
        try:
            tables[name] = spark.read.parquet(path)
            status.append((name, "ok", None))
        except Exception as error:
            status.append((name, "error", str(error).splitlines()[0][:MAX_STRING_LENGTH]))
    return tables, small_frame(spark, status, "table_name string, status string, message string")


def run_sql(
    spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None, max_string_length: int = 0
) -> DataFrame:
    """Result of a SQL text over the given tables, with the vector functions at hand."""
    register_sql_functions(spark)
    for name, table in (tables or {}).items():
        table.createOrReplaceTempView(name)
    result = spark.sql(text)
    if max_string_length:
        result = result.select(*_shortened(result, max_string_length))
    return result


def _shortened(rows: DataFrame, length: int) -> list:
    texts = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)}
    return [shorten(F.col(f"`{c}`"), length).alias(c) if c in texts else F.col(f"`{c}`") for c in rows.columns]


def table_profile(tables: Mapping[str, DataFrame], distinct: str | None = None) -> DataFrame:
    """One row per column: type, rows, nulls, smallest and largest value; one pass per table.

    ``distinct="approx"`` adds an estimate of the distinct values from the same pass,
    ``distinct="exact"`` a count, which reads every column once more and shuffles its distinct values.
    """
    return reduce(DataFrame.unionByName, [_profile(name, table, distinct) for name, table in tables.items()])


def _profile(name: str, table: DataFrame, distinct: str | None) -> DataFrame:
    names = [*PROFILE_COLUMNS, "n_distinct"] if distinct else PROFILE_COLUMNS
    aggregates, entries, counted = ["count(*) AS n_rows"], [], []
    for i, field in enumerate(table.schema.fields):
        column = "`" + field.name.replace("`", "``") + "`"
        aggregates.append(f"count_if({column} IS NULL) AS nulls_{i}")
        number = text = None
        if isinstance(field.dataType, T.NumericType):
            number = "double({end}_{i})"
        elif isinstance(field.dataType, T.StringType):
            text = "{end}_{i}"
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            text = "substring(string({end}_{i}), 1, 19)"
        if number or text:
            aggregates += [f"min({column}) AS min_{i}", f"max({column}) AS max_{i}"]
        parts = [str(i), _quoted(field.name), _quoted(field.dataType.simpleString()), f"nulls_{i}"]
        parts += [(number or "double(NULL)").format(end=end, i=i) for end in ("min", "max")]
        parts += [(text or "string(NULL)").format(end=end, i=i) for end in ("min", "max")]
        comparable = not isinstance(field.dataType, (T.MapType, T.VariantType))
        if distinct == "approx":
            aggregates.append(f"{f'approx_count_distinct({column})' if comparable else 'bigint(NULL)'} AS distinct_{i}")
            parts.append(f"distinct_{i}")
        elif distinct and comparable:
            # One column at a time: counted together, every row would be sorted once per column.
            values = table.select(F.expr(f"{column} AS value")).distinct()
            counted.append(values.agg(F.lit(i).alias("place"), F.count("value").alias("n_distinct")))
        entries.append("struct(" + ", ".join(f"{p} AS {n}" for p, n in zip(parts, ["place", *names])) + ")")
    counts = table.agg(*[F.expr(a) for a in aggregates])
    rows = counts.selectExpr("n_rows", f"inline(array({', '.join(entries)}))")
    if counted:
        rows = rows.join(F.broadcast(reduce(DataFrame.unionByName, counted)), "place", "left")
    elif distinct == "exact":
        rows = rows.withColumn("n_distinct", F.lit(None).cast("long"))
    texts = {f"{end}_text": shorten(F.col(f"{end}_text"), MAX_STRING_LENGTH) for end in ("min", "max")}
    return rows.withColumns({"table_name": F.lit(name), **texts}).select("table_name", *names, "n_rows")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def profile_folder(spark: SparkSession, folder: str, distinct: str | None = None) -> DataFrame:
    """Profiles of all tables of a folder that can be read through."""
    tables = load_tables(spark, folder_tables(spark, folder), verify=True)[0]
    if tables:
        return table_profile(tables, distinct)
    counts = ", n_distinct bigint" if distinct else ""
    kinds = "string, string, bigint, double, double, string, string".split(", ")
    columns = ", ".join(f"{n} {k}" for n, k in zip(PROFILE_COLUMNS, kinds))
    return small_frame(spark, [], f"table_name string, {columns}{counts}, n_rows bigint")


def sample_rows(
    table: DataFrame, key: str, rows: int = SAMPLE_ROWS, max_string_length: int = MAX_STRING_LENGTH
) -> DataFrame:
    """The first rows by key, long texts cut."""
    first = first_rows(table, rows, key)
    return first.select(*_shortened(first, max_string_length))

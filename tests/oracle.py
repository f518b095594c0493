"""Run registered queries beside their SQL in DuckDB and compare the values."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

import __spark_entry__ as registry  # noqa: E402
from workload.tables import TABLES  # noqa: E402


SAME_TYPE = {
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, (Decimal, float)):
        value = float(value)
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return value
    if isinstance(value, (datetime, date)):
        return str(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(row[i]) for i in order] for row in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = registry.queries()[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    want = rows_of(names, result.fetchall())
    types = {d[0]: str(d[1]) for d in result.description}
    other = [(c, t, types[c]) for c, t in frame.dtypes if SAME_TYPE.get(t, t) != types[c]]
    if other:
        return f"types differ {other}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    if not want:
        return "both sides are empty"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {str(wrong[0])[:600]}" if wrong else None


if __name__ == "__main__":
    from nearspan.session import local_session

    folder = sys.argv[1]
    chosen = sys.argv[2:] or list(registry.queries())
    spark = local_session(8)
    con = connection(folder)
    failed = 0
    for query in chosen:
        begin = time.time()
        try:
            problem = compare(spark, con, folder, query)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        print(f"{query:28s} {time.time() - begin:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} of {len(chosen)} failed")

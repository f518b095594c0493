"""Registered queries: partitioned tables, profiles and SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan import PartitionSpec, run_sql
from nearspan.operators import buckets, partition
from nearspan.session import scratch_path
from nearspan.sources import catalog
from workload.tables import CENTRES_SQL, DISTANCE_SQL, TABLES, VECTORS_SQL, label_centres, load

BY_CUSTOMER = PartitionSpec("HASH", "o_custkey", 16)
BY_USER = PartitionSpec("KEY", "event_type", 16)
BY_DATE = PartitionSpec(
    "RANGE",
    "o_orderdate",
    defs=(
        {"name": "p1996", "values_less_than": "1997-01-01"},
        {"name": "p1998", "values_less_than": "1999-01-01"},
        {"name": "rest", "values_less_than": "MAXVALUE"},
    ),
)
BY_VALUE = PartitionSpec(
    "RANGE",
    "value",
    defs=(
        {"name": "low", "values_less_than": 10},
        {"name": "middle", "values_less_than": 100},
        {"name": "high", "values_less_than": "MAXVALUE"},
    ),
)
BY_PRIORITY = PartitionSpec(
    "LIST",
    "o_orderpriority",
    defs=(
        {"name": "hot", "values_in": ["1-URGENT", "2-HIGH"]},
        {"name": "cold", "values_in": ["3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]},
    ),
)
DATE_SQL = (
    "CASE WHEN o_orderdate < '1997-01-01' THEN 'p1996' WHEN o_orderdate < '1999-01-01' THEN 'p1998' ELSE 'rest' END"
)
PRIORITY_SQL = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'hot' ELSE 'cold' END"


def _written(spark: SparkSession, sf_dir: str, table: str, spec: PartitionSpec) -> DataFrame:
    path = scratch_path(spark, "parted")
    partition.write_partitioned(load(spark, sf_dir, table), path, spec)
    return partition.read_partitioned(spark, path)


def parted_orders(spec: PartitionSpec):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _written(spark, sf_dir, "orders", spec).select("o_orderkey", "o_totalprice", "p")

    return run


def partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, rows, and keys found in more than one partition, which must be none."""
    rows = _written(spark, sf_dir, "events", BY_USER)
    keys = rows.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("p").alias("homes"))
    return keys.agg(
        F.count("*").alias("n_keys"), F.sum("n").alias("n_rows"), F.count_if(F.col("homes") > 1).alias("n_split_keys")
    )


def partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _written(spark, sf_dir, "orders", BY_PRIORITY)
    return partition.where_key(rows, BY_PRIORITY, ["2-HIGH", "5-LOW"]).select("o_orderkey", "o_orderpriority", "p")


def partition_prune_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _written(spark, sf_dir, "events", BY_VALUE)
    return partition.where_between(rows, BY_VALUE, 20, 80).select("event_id", "value", "p")


def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted into a declared catalog table; a column that is not given is NULL."""
    path = scratch_path(spark, "catalog")
    name = "t_" + path.rsplit("-", 1)[1][:16]
    spec = PartitionSpec("HASH", "user_id", 8)
    columns = [("id", "BIGINT"), ("user_id", "BIGINT"), ("amount", "DECIMAL(10,2)"), ("note", "VARCHAR(20)")]
    partition.create_partitioned_table(spark, name, columns, spec, path=path)
    rows = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("amount")
    )
    partition.insert_rows(rows, name, spec)
    result = spark.table(name)
    return result.select("id", F.col("amount").cast("double").alias("amount"), "note", "p")


def _bucketed_orders(spark: SparkSession, sf_dir: str) -> tuple[buckets.BucketedTable, buckets.BucketedTable]:
    """Orders and line items in buckets of the order."""
    path = scratch_path(spark, "buckets")
    name = "b_" + path.rsplit("-", 1)[1][:16]
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"), "o_custkey")
    items = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"), "l_linenumber", "l_quantity")
    return (
        buckets.write_bucketed(orders, name + "_o", ["order_key"], 16, path + "/orders"),
        buckets.write_bucketed(items, name + "_l", ["order_key"], 16, path + "/items"),
    )


def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders, joined bucket by bucket."""
    orders, items = _bucketed_orders(spark, sf_dir)
    joined = buckets.join_bucketed(spark, orders, items)
    return joined.select("order_key", "o_custkey", "l_linenumber", F.col("l_quantity").cast("double").alias("quantity"))


def bucketed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user from buckets of users, with the users of most events apart."""
    path = scratch_path(spark, "buckets")
    rows = load(spark, sf_dir, "events").select("user_id", "event_id")
    table = buckets.write_bucketed(rows, "b_" + path.rsplit("-", 1)[1][:16], ["user_id"], 16, path, hot_share=0.1)
    totals = F.count("*").alias("n_events"), F.max("event_id").alias("last_event")
    return buckets.aggregate_bucketed(spark, table, *totals)


def broadcast_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = load(spark, sf_dir, "customer")
    nations = load(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = load(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    joined = partition.join_dimension(partition.join_dimension(facts, nations, "c_nationkey"), regions, "n_regionkey")
    return joined.select("c_custkey", "c_name", "n_name", "r_name")


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: load(spark, sf_dir, name) for name in TABLES}


def sql_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"embeddings": load(spark, sf_dir, "embeddings"), "centres": label_centres(spark, sf_dir)}
    return run_sql(
        spark,
        """
        SELECT vec_id,
               vector_dim(embedding) AS dim,
               round(vec_distance(embedding, centre), 6) AS auto_distance,
               round(vec_distance_cosine(embedding, vec_fromtext(vec_totext(centre))), 6) AS cosine_distance,
               round(vec_distance_euclidean(embedding, centre), 6) AS euclidean_distance,
               round(vec_distance_inner_product(embedding, centre), 6) AS inner_product_distance
        FROM embeddings JOIN centres USING (label)
        """,
        tables,
    )


REVENUE_SQL = """
    SELECT n_name, l_returnflag, count(*) AS n_items, count(DISTINCT o_orderkey) AS n_orders,
           CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
         JOIN nation ON n_nationkey = c_nationkey
    GROUP BY n_name, l_returnflag
"""

TREND_SQL = """
    SELECT event_type, user_id, n, total,
           CAST(row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS INT) AS place
    FROM (SELECT event_type, user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM events GROUP BY event_type, user_id)
"""


def sql_text(text: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_sql(spark, text, _tables(spark, sf_dir))

    return run


def sql_short_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(
        spark, "SELECT doc_id, lang, text FROM documents", {"documents": load(spark, sf_dir, "documents")}, 300
    )


def table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable table of the folder with its status and rows."""
    paths = catalog.folder_tables(spark, sf_dir)
    wanted = catalog.usable_tables(paths, ignore=["benchmark"])
    tables, status = catalog.load_tables(spark, {name: paths[name] for name in wanted})
    counts = reduce(
        DataFrame.unionByName,
        [t.agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows")) for n, t in tables.items()],
    )
    return status.join(counts, "table_name", "left").select("table_name", "status", "n_rows")


def file_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table of the folder, read through file by file."""
    report = catalog.table_report(catalog.file_report(spark, catalog.folder_tables(spark, sf_dir)))
    return report.select("table_name", "status", "n_files", "n_rows")


def table_profile(distinct: str | None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        profile = catalog.table_profile({n: load(spark, sf_dir, n) for n in TABLES}, distinct)
        return profile.drop("data_type")

    return run


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.sample_rows(load(spark, sf_dir, "pages"), "page_id")


KINDS = {
    "region": "r_regionkey:n r_name:t",
    "nation": "n_nationkey:n n_name:t n_regionkey:n",
    "customer": "c_custkey:n c_name:t c_nationkey:n c_acctbal:n c_mktsegment:t",
    "supplier": "s_suppkey:n s_name:t s_nationkey:n s_acctbal:n",
    "part": "p_partkey:n p_name:t p_brand:t p_type:t p_size:n p_retailprice:n",
    "orders": "o_orderkey:n o_custkey:n o_orderstatus:t o_totalprice:n o_orderdate:d o_orderpriority:t",
    "lineitem": "l_orderkey:n l_partkey:n l_suppkey:n l_linenumber:n l_quantity:n l_extendedprice:n l_discount:n"
    " l_tax:n l_returnflag:t l_linestatus:t l_shipdate:d",
    "events": "event_id:n ts:d user_id:n event_type:t value:n props:t",
    "documents": "doc_id:n text:t lang:t source:t n_chars:n",
    "embeddings": "vec_id:n embedding:o label:n",
    "pages": "page_id:n url:t html:t",
    "benchmark": "item_id:n text:t",
    "labels": "doc_id:n quality:n toxic:n",
    "conversations": "conv_id:n turn:n role:t text:t",
}


def _short_sql(text: str) -> str:
    return (
        f"CASE WHEN length({text}) <= 300 THEN {text} ELSE regexp_replace(substring({text}, 1, 297), ' [^ ]*$', '')"
        " || '...' END"
    )


def _profile_sql(names, distinct: bool) -> str:
    parts = []
    for name in names:
        for item in KINDS[name].split():
            column, kind = item.split(":")
            low, high = f"min({column})", f"max({column})"
            numbers = [f"CAST({x} AS DOUBLE)" if kind == "n" else "CAST(NULL AS DOUBLE)" for x in (low, high)]
            if kind == "t":
                texts = [_short_sql(x) for x in (low, high)]
            elif kind == "d":
                texts = [f"strftime({x}, '%Y-%m-%d %H:%M:%S')" for x in (low, high)]
            else:
                texts = ["CAST(NULL AS VARCHAR)"] * 2
            count = f", count(DISTINCT {column}) AS n_distinct" if distinct else ""
            parts.append(
                f"SELECT '{name}' AS table_name, '{column}' AS column_name, count(*) FILTER ({column} IS NULL) AS"
                f" n_nulls, {numbers[0]} AS min_number, {numbers[1]} AS max_number, {texts[0]} AS min_text,"
                f" {texts[1]} AS max_text{count}, count(*) AS n_rows FROM {name}"
            )
    return " UNION ALL ".join(parts)


_gap = {m: DISTANCE_SQL[m].format(a="v.e", b="c.centre") for m in DISTANCE_SQL}

QUERIES = {
    "partition_hash": (
        parted_orders(BY_CUSTOMER),
        "SELECT o_orderkey, o_totalprice, CAST(o_custkey % 16 AS INTEGER) AS p FROM orders",
    ),
    "partition_key": (
        partition_key,
        "SELECT count(DISTINCT event_type) AS n_keys, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_split_keys FROM events",
    ),
    "partition_range": (parted_orders(BY_DATE), f"SELECT o_orderkey, o_totalprice, {DATE_SQL} AS p FROM orders"),
    "partition_list": (parted_orders(BY_PRIORITY), f"SELECT o_orderkey, o_totalprice, {PRIORITY_SQL} AS p FROM orders"),
    "partition_prune": (
        partition_prune,
        f"SELECT o_orderkey, o_orderpriority, {PRIORITY_SQL} AS p FROM orders WHERE o_orderpriority IN ('2-HIGH', '5-LOW')",
    ),
    "partition_prune_range": (
        partition_prune_range,
        "SELECT event_id, value, 'middle' AS p FROM events WHERE value BETWEEN 20 AND 80",
    ),
    "partition_report": (
        lambda spark, sf_dir: partition.partition_report(load(spark, sf_dir, "events"), BY_VALUE),
        "SELECT CASE WHEN value < 10 THEN 'low' WHEN value < 100 THEN 'middle' ELSE 'high' END AS p, count(*) AS"
        " n_rows, min(value) AS min_key, max(value) AS max_key FROM events GROUP BY 1",
    ),
    "catalog_table": (
        catalog_table,
        "SELECT o_orderkey AS id, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS amount, CAST(NULL AS VARCHAR)"
        " AS note, CAST(o_custkey % 8 AS INTEGER) AS p FROM orders",
    ),
    "bucketed_join": (
        bucketed_join,
        "SELECT o_orderkey AS order_key, o_custkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS quantity FROM orders"
        " JOIN lineitem ON l_orderkey = o_orderkey",
    ),
    "bucketed_totals": (
        bucketed_totals,
        "SELECT user_id, count(*) AS n_events, max(event_id) AS last_event FROM events GROUP BY user_id",
    ),
    "broadcast_dim_join": (
        broadcast_dim_join,
        "SELECT c_custkey, c_name, n_name, r_name FROM customer JOIN nation ON n_nationkey = c_nationkey"
        " JOIN region ON r_regionkey = n_regionkey",
    ),
    "sql_distance": (
        sql_distance,
        f"WITH {VECTORS_SQL}, {CENTRES_SQL} SELECT v.id AS vec_id, CAST(len(v.e) AS INTEGER) AS dim,"
        f" round({_gap['cosine']}, 6) AS auto_distance, round({_gap['cosine']}, 6) AS cosine_distance,"
        f" round({_gap['euclidean']}, 6) AS euclidean_distance, round({_gap['inner_product']}, 6) AS"
        " inner_product_distance FROM v JOIN c ON c.cell = v.label",
    ),
    "run_sql": (sql_text(REVENUE_SQL), REVENUE_SQL),
    "run_sql_window": (sql_text(TREND_SQL), TREND_SQL),
    "run_sql_short_texts": (sql_short_texts, f"SELECT doc_id, lang, {_short_sql('text')} AS text FROM documents"),
    "table_inventory": (
        table_inventory,
        " UNION ALL ".join(
            f"SELECT '{n}' AS table_name, 'ok' AS status, count(*) AS n_rows FROM {n}" for n in TABLES if n != "benchmark"
        ),
    ),
    "table_profile": (table_profile(None), _profile_sql(TABLES, False)),
    "table_profile_distinct": (
        table_profile("exact"),
        _profile_sql(TABLES, True),
    ),
    "file_integrity": (
        file_integrity,
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, 'ok' AS status, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows FROM {t}"
            for t in TABLES
        ),
    ),
    "sample_rows": (
        sample_rows,
        f"SELECT page_id, {_short_sql('url')} AS url, {_short_sql('html')} AS html FROM pages ORDER BY page_id LIMIT 3",
    ),
}

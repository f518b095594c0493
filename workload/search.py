"""Registered queries: similarity search, re-ranking and the approximate index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan import FilterGroup, MetaFilter, nearest_diverse, nearest_join, nearest_to
from nearspan.functions.distance import distance, similarity
from nearspan.functions.filters import predicate
from nearspan.operators import codes, ivf
from nearspan.operators.knn import with_payload
from nearspan.operators.lsh import nearest_by_projection
from nearspan.operators.mmr import rerank
from nearspan.operators.vector_table import vector_table
from nearspan.schema import METRICS
from nearspan.session import scratch_path
from workload.tables import (
    CENTRES_SQL,
    DISTANCE_SQL,
    DOCS_SQL,
    PLAIN,
    PROMOTED,
    SIMILARITY_SQL,
    VECTORS_SQL,
    every_vector_asks,
    label_centres,
    source_rows,
    vectors,
)

K = 10


def _numbers(found: DataFrame, key: str = "qid") -> DataFrame:
    return found.select(
        key,
        "node_id",
        "rank",
        F.round("distance", 6).alias("distance"),
        F.round("similarity", 6).alias("similarity"),
    )


def _mean_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """Mean of all embeddings; one vector."""
    rows = vectors(spark, sf_dir).select(F.posexplode("embedding").alias("i", "x"))
    means = rows.groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return [r["x"] for r in means.orderBy("i").collect()]


def one_query(metric: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = nearest_to(vectors(spark, sf_dir), _mean_vector(spark, sf_dir), K, metric)
        return _numbers(found.withColumn("qid", F.lit(0)))

    return run


def many_queries(metric: str, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = nearest_join(vectors(spark, sf_dir), every_vector_asks(spark, sf_dir), K, metric, **options)
        return _numbers(found)

    return run


def knn_filtered_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = vector_table(source_rows(spark, sf_dir), PROMOTED)
    wanted = predicate(FilterGroup([MetaFilter("lang", "en"), MetaFilter("n_chars", 500, ">=")]), PROMOTED)
    return _numbers(nearest_join(table.where(wanted), every_vector_asks(spark, sf_dir), K))


def knn_filtered_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = vector_table(source_rows(spark, sf_dir), PLAIN)
    tree = FilterGroup([MetaFilter("source", ["src1", "src2", "src3"], "in"), MetaFilter("toxic", True)], "or")
    return _numbers(nearest_join(table.where(predicate(tree, PLAIN)), every_vector_asks(spark, sf_dir), K))


def knn_with_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered top ten of each label's mean vector with the text of the matches."""
    table = vector_table(source_rows(spark, sf_dir), PROMOTED)
    asked = label_centres(spark, sf_dir).select(F.col("label").alias("qid"), F.col("centre").alias("embedding"))
    found = nearest_join(table.where(predicate(MetaFilter("lang", "en"), PROMOTED)), asked, K)
    full = with_payload(_numbers(found), table, ["text", "lang", "n_chars"], asked, K)
    return full.select("qid", "rank", "node_id", "distance", "similarity", "text", "lang", "n_chars")


def similarity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance and similarity of every vector to the mean vector of its label."""
    rows = vectors(spark, sf_dir).join(label_centres(spark, sf_dir), "label")
    columns = []
    for metric in METRICS:
        gap = distance(F.col("embedding"), F.col("centre"), metric)
        columns.append(F.round(gap, 6).alias(f"{metric}_distance"))
        columns.append(F.round(similarity(gap, metric), 6).alias(f"{metric}_similarity"))
    return rows.select("node_id", *columns)


def mmr(fetch_k: int, k: int, lambda_mult: float, metric: str = "cosine", **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, asked = vectors(spark, sf_dir), every_vector_asks(spark, sf_dir)
        return _numbers(nearest_diverse(rows, asked, k, metric, fetch_k, lambda_mult, **options))

    return run


def _label_index(spark: SparkSession, sf_dir: str, metric: str = "cosine") -> ivf.IvfIndex:
    """An index whose cells are the label means, so that SQL can build the same one."""
    centres = label_centres(spark, sf_dir).select(F.col("label").alias("cell"), F.col("centre").alias("centroid"))
    return ivf.build_index(vectors(spark, sf_dir), scratch_path(spark, "index"), metric, centroids=centres)


def ann_all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ivf.build_index(vectors(spark, sf_dir), scratch_path(spark, "index"), n_cells=16)
    return _numbers(ivf.search_index(index, every_vector_asks(spark, sf_dir), K, probes=16))


def ann_probe(probes: int, metric: str = "cosine", **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        index = _label_index(spark, sf_dir, metric)
        return _numbers(ivf.search_index(index, every_vector_asks(spark, sf_dir), K, probes, **options))

    return run


def ann_kmeans_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many probes as gave 0.9 of the true neighbours when the index was measured."""
    index = ivf.build_index(vectors(spark, sf_dir), scratch_path(spark, "index"))
    return _numbers(ivf.search_bounded(index, every_vector_asks(spark, sf_dir), K, recall=0.9))


def _coded(spark: SparkSession, sf_dir: str, metric: str = "cosine") -> codes.CodedIndex:
    index = ivf.build_index(vectors(spark, sf_dir), scratch_path(spark, "index"), metric)
    return codes.build_codes(index, scratch_path(spark, "codes"))


def ann_codes(metric: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Exact neighbours of every vector, from the codes and the few vectors that their bounds admit."""
        return _numbers(codes.search_codes(_coded(spark, sf_dir, metric), every_vector_asks(spark, sf_dir), K))

    return run


def code_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.code_sizes(_coded(spark, sf_dir))


def ann_bounded(metric: str, **options):
    """Exact neighbours of every vector, from the cells that can hold them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        index = ivf.build_index(vectors(spark, sf_dir), scratch_path(spark, "index"), metric)
        return _numbers(ivf.search_bounded(index, every_vector_asks(spark, sf_dir), K, **options))

    return run


FILTERED = FilterGroup([MetaFilter("lang", "en"), MetaFilter("n_chars", 500, ">=")])


def ann_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered neighbours from an index that carries the promoted columns."""
    table = vector_table(source_rows(spark, sf_dir), PROMOTED)
    index = ivf.build_index(table, scratch_path(spark, "index"), keep=PROMOTED.promoted_names)
    found = ivf.search_bounded(index, every_vector_asks(spark, sf_dir), K, filters=FILTERED, config=PROMOTED)
    return _numbers(found)


def ann_after_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours after rows were added, turned round and removed, without a rebuild."""
    rows = vectors(spark, sf_dir).withColumn("id", F.col("node_id").cast("long"))
    index = ivf.build_index(rows.where("label != 3"), scratch_path(spark, "index"))
    turned = rows.where("id % 7 = 0").withColumn("embedding", F.transform("embedding", lambda x: -x))
    added = rows.where("label = 3 AND id % 7 != 0")
    index = ivf.add_changes(index, turned.unionByName(added))
    index = ivf.add_changes(index, removed=rows.where("id % 11 = 0"))
    ivf.split_cells(index, 1.5)
    return _numbers(ivf.search_bounded(index, every_vector_asks(spark, sf_dir), K))


def knn_pivots(metric: str, **options):
    """Exact neighbour join with the corpus split around pivots."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = ivf.pivot_join(vectors(spark, sf_dir), every_vector_asks(spark, sf_dir), K, metric, **options)
        return _numbers(found.rows)

    return run


def ann_mmr(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _label_index(spark, sf_dir)
    found = ivf.search_index(index, every_vector_asks(spark, sf_dir), 20, 3, carry=["embedding"], with_cosine=True)
    return _numbers(rerank(found, 5, 0.3))


def lsh_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, asked = vectors(spark, sf_dir), every_vector_asks(spark, sf_dir)
    return _numbers(nearest_by_projection(rows, asked, K, parts=8))


def index_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by cell after a rebuild over the current rows, and what is not indexed."""
    index = _label_index(spark, sf_dir)
    fresh = ivf.rebuild_index(index, vectors(spark, sf_dir), scratch_path(spark, "index"))
    return ivf.index_stats(fresh, vectors(spark, sf_dir).count()).agg(
        F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_cells"), F.max("n_not_indexed").alias("n_not_indexed")
    )


def index_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _label_index(spark, sf_dir)
    report = ivf.index_health(index, vectors(spark, sf_dir), every_vector_asks(spark, sf_dir), K, (1, 3, 10))
    return report.withColumn("recall", F.round("recall", 6)).withColumn("visited_share", F.round("visited_share", 6))


def _ranked_sql(body: str, metric: str, k: int = K, qid: str = "qid") -> str:
    """Top k per query of a relation ``p(qid, id, a, b)``."""
    gap = DISTANCE_SQL[metric].format(a="a", b="b")
    return (
        f"{body}, s AS (SELECT qid, CAST(id AS VARCHAR) AS node_id, {gap} AS d FROM p),"
        " r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, node_id) AS rn FROM s)"
        f" SELECT qid AS {qid}, node_id, CAST(rn AS INTEGER) AS rank, round(d, 6) AS distance,"
        f" round({SIMILARITY_SQL[metric].format(d='d')}, 6) AS similarity FROM r WHERE rn <= {k}"
    )


PAIRS_SQL = f"WITH {VECTORS_SQL}, p AS (SELECT q.id AS qid, v.id, q.e AS a, v.e AS b FROM v AS q, v)"
MEAN_SQL = (
    f"WITH {VECTORS_SQL}, m AS (SELECT i, avg(x) AS x FROM (SELECT unnest(e) AS x, generate_subscripts(e, 1) AS i"
    " FROM v) GROUP BY i), p AS (SELECT 0 AS qid, v.id, (SELECT CAST(CAST(list(x ORDER BY i) AS FLOAT[]) AS DOUBLE[]) FROM m) AS a, v.e AS b FROM v)"
)


def _filtered_sql(where: str) -> str:
    return (
        f"WITH {VECTORS_SQL}, {DOCS_SQL}, p AS (SELECT q.id AS qid, v.id, q.e AS a, v.e AS b FROM v AS q, v"
        f" JOIN d ON d.doc_id = v.id WHERE {where})"
    )


def _cells_sql(metric: str, asking: bool = False) -> str:
    """Cell of each vector, and the order in which a query prefers the cells."""
    if asking and metric == "inner_product":
        gap = DISTANCE_SQL[metric].format(a="v.e", b="c.centre")
        return (
            f"{_cells_sql(metric)}, oq AS (SELECT v.id, c.cell, row_number() OVER (PARTITION BY v.id ORDER BY"
            f" {gap}, c.cell) AS turn FROM v, c)"
        )
    gap = DISTANCE_SQL["cosine" if metric == "cosine" else "euclidean"].format(a="v.e", b="c.centre")
    return (
        f"{VECTORS_SQL}, {CENTRES_SQL}, o AS (SELECT v.id, c.cell, row_number() OVER (PARTITION BY v.id ORDER BY"
        f" {gap}, c.cell) AS turn FROM v, c)"
    )


def _probe_sql(probes: int, metric: str = "cosine") -> str:
    asked = "oq" if metric == "inner_product" else "o"
    return (
        f"WITH {_cells_sql(metric, True)}, p AS (SELECT q.id AS qid, x.id, q.e AS a, x.e AS b FROM v AS q"
        f" JOIN {asked} AS qo ON qo.id = q.id AND qo.turn <= {probes} JOIN o AS xo ON xo.cell = qo.cell AND xo.turn = 1"
        " JOIN v AS x ON x.id = xo.id)"
    )


def _mmr_sql(pairs: str, fetch_k: int, k: int, weight: float, metric: str = "cosine") -> str:
    gap = DISTANCE_SQL[metric].format(a="a", b="b")
    similar = SIMILARITY_SQL[metric].format(d="c.dist")
    recursive = pairs.replace("WITH ", "WITH RECURSIVE ", 1)
    return (
        f"{recursive}, s AS (SELECT qid, CAST(id AS VARCHAR) AS node_id, b AS e, {gap} AS dist,"
        " list_cosine_similarity(a, b) AS rel FROM p),"
        " cand AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, node_id)"
        f" - 1 AS i FROM s) WHERE i < {fetch_k}),"
        " big AS (SELECT qid, count(*) AS n, arg_max(i, {'a': round(rel, 12), 'b': -i}) AS first FROM cand GROUP BY qid),"
        " pick AS (SELECT qid, 1 AS step, [first] AS sel FROM big"
        f" WHERE n > {k} UNION ALL"
        " SELECT t.qid, t.step + 1, list_append(any_value(t.sel), arg_max(t.i, {'a': t.score, 'b': -t.i})) FROM"
        " (SELECT pick.qid, pick.step, pick.sel, c.i,"
        f" round({weight} * c.rel - (1 - {weight}) * max(list_cosine_similarity(c.e, o.e)), 12) AS score"
        " FROM pick JOIN cand AS c ON c.qid = pick.qid AND NOT list_contains(pick.sel, c.i)"
        " JOIN cand AS o ON o.qid = pick.qid AND list_contains(pick.sel, o.i)"
        f" WHERE pick.step < {k} GROUP BY pick.qid, pick.step, pick.sel, c.i, c.rel) AS t GROUP BY t.qid, t.step),"
        f" done AS (SELECT qid, unnest(sel) AS i, generate_subscripts(sel, 1) AS rn FROM pick WHERE step = {k}"
        f" UNION ALL SELECT cand.qid, cand.i, cand.i + 1 FROM cand JOIN big ON big.qid = cand.qid AND n <= {k})"
        " SELECT done.qid, c.node_id, CAST(done.rn AS INTEGER) AS rank, round(c.dist, 6) AS distance,"
        f" round({similar}, 6) AS similarity FROM done JOIN cand AS c ON c.qid = done.qid AND c.i = done.i"
    )


def _health_sql() -> str:
    exact = _ranked_sql("p AS (SELECT q.id AS qid, v.id, q.e AS a, v.e AS b FROM v AS q, v)", "cosine")
    parts = []
    for probes in (1, 3, 10):
        body = _probe_sql(probes).split(", p AS ", 1)[1]
        near = _ranked_sql("p AS " + body, "cosine")
        parts.append(
            f"SELECT {probes} AS probes, round((SELECT avg(CASE WHEN n.node_id IS NULL THEN 0.0 ELSE 1.0 END) FROM"
            f" truth LEFT JOIN (WITH {near}) AS n ON n.qid = truth.qid AND n.node_id = truth.node_id), 6) AS recall,"
            " round((SELECT avg(w) FROM (SELECT o.id, sum(z.n) AS w FROM o JOIN sizes AS z ON z.cell = o.cell WHERE"
            f" o.turn <= {probes} GROUP BY o.id)) / (SELECT count(*) FROM v), 6) AS visited_share"
        )
    return (
        f"WITH {_cells_sql('cosine')}, truth AS (WITH {exact}), sizes AS (SELECT cell, count(*) AS n FROM o WHERE"
        " turn = 1 GROUP BY cell) SELECT 'vi' AS index_name, 'IVF' AS algorithm, 'cosine' AS metric_type,"
        f" 64 AS dimension, (SELECT CAST(count(*) AS INTEGER) FROM c) AS n_cells, h.* FROM ({' UNION ALL '.join(parts)}) AS h"
    )


ALL_CELL_SIZES_SQL = (
    f"WITH {_cells_sql('cosine')} SELECT c.cell, count(o.id) AS n_rows FROM c LEFT JOIN o ON o.cell = c.cell AND"
    " o.turn = 1 GROUP BY c.cell"
)

_scores = ", ".join(
    f"round({DISTANCE_SQL[m].format(a='v.e', b='c.centre')}, 6) AS {m}_distance,"
    f" round({SIMILARITY_SQL[m].format(d=DISTANCE_SQL[m].format(a='v.e', b='c.centre'))}, 6) AS {m}_similarity"
    for m in METRICS
)

QUERIES = {
    "knn_cosine": (one_query("cosine"), _ranked_sql(MEAN_SQL, "cosine")),
    "knn_euclidean": (one_query("euclidean"), _ranked_sql(MEAN_SQL, "euclidean")),
    "knn_inner_product": (one_query("inner_product"), _ranked_sql(MEAN_SQL, "inner_product")),
    "knn_join": (many_queries("cosine"), _ranked_sql(PAIRS_SQL, "cosine")),
    "knn_join_euclidean": (many_queries("euclidean"), _ranked_sql(PAIRS_SQL, "euclidean")),
    "knn_join_inner_product": (many_queries("inner_product"), _ranked_sql(PAIRS_SQL, "inner_product")),
    "knn_join_spread": (many_queries("cosine", max_sent=0, slice_rows=400), _ranked_sql(PAIRS_SQL, "cosine")),
    "knn_filtered_promoted": (
        knn_filtered_promoted,
        _ranked_sql(_filtered_sql("d.lang = 'en' AND d.n_chars >= 500"), "cosine"),
    ),
    "knn_filtered_json": (
        knn_filtered_json,
        _ranked_sql(_filtered_sql("(d.source IN ('src1', 'src2', 'src3') OR d.toxic = 1)"), "cosine"),
    ),
    "knn_with_rows": (
        knn_with_rows,
        f"WITH {VECTORS_SQL}, {DOCS_SQL}, {CENTRES_SQL}, r AS (SELECT c.cell AS qid, v.id,"
        " list_cosine_distance(c.centre, v.e) AS g, row_number() OVER (PARTITION BY c.cell ORDER BY"
        " list_cosine_distance(c.centre, v.e), CAST(v.id AS VARCHAR)) AS rn FROM c, v JOIN d ON d.doc_id = v.id WHERE"
        " d.lang = 'en') SELECT r.qid, CAST(r.rn AS INTEGER) AS rank, d.node_id, round(r.g, 6) AS distance,"
        " round(1 - r.g, 6) AS similarity, d.text, d.lang, CAST(d.n_chars AS INTEGER) AS n_chars FROM r"
        " JOIN d ON d.doc_id = r.id WHERE r.rn <= 10",
    ),
    "similarity_scores": (
        similarity_scores,
        f"WITH {VECTORS_SQL}, {CENTRES_SQL} SELECT CAST(v.id AS VARCHAR) AS node_id, {_scores} FROM v"
        " JOIN c ON c.cell = v.label",
    ),
    "mmr": (mmr(20, 5, 0.3), _mmr_sql(PAIRS_SQL, 20, 5, 0.3)),
    "mmr_euclidean": (mmr(20, 5, 0.5, "euclidean"), _mmr_sql(PAIRS_SQL, 20, 5, 0.5, "euclidean")),
    "mmr_read_back": (mmr(20, 5, 0.3, carried=0), _mmr_sql(PAIRS_SQL, 20, 5, 0.3)),
    "mmr_few_candidates": (mmr(5, 5, 0.3), _mmr_sql(PAIRS_SQL, 5, 5, 0.3)),
    "ann_all_cells": (ann_all_cells, _ranked_sql(PAIRS_SQL, "cosine")),
    "ann_probe": (ann_probe(3), _ranked_sql(_probe_sql(3), "cosine")),
    "ann_probe_euclidean": (ann_probe(2, "euclidean"), _ranked_sql(_probe_sql(2, "euclidean"), "euclidean")),
    "ann_probe_inner_product": (
        ann_probe(2, "inner_product"),
        _ranked_sql(_probe_sql(2, "inner_product"), "inner_product"),
    ),
    "ann_probe_inner_product_spread": (
        ann_probe(2, "inner_product", max_sent=0, slice_rows=40),
        _ranked_sql(_probe_sql(2, "inner_product"), "inner_product"),
    ),
    "ann_probe_spread": (ann_probe(3, max_sent=0, slice_rows=40), _ranked_sql(_probe_sql(3), "cosine")),
    "ann_bounded": (ann_bounded("cosine"), _ranked_sql(PAIRS_SQL, "cosine")),
    "ann_bounded_euclidean": (ann_bounded("euclidean", max_sent=0), _ranked_sql(PAIRS_SQL, "euclidean")),
    "ann_bounded_inner_product": (ann_bounded("inner_product"), _ranked_sql(PAIRS_SQL, "inner_product")),
    "ann_filtered": (ann_filtered, _ranked_sql(_filtered_sql("d.lang = 'en' AND d.n_chars >= 500"), "cosine")),
    "ann_after_upsert": (
        ann_after_upsert,
        _ranked_sql(
            f"WITH {VECTORS_SQL}, p AS (SELECT q.id AS qid, v.id, q.e AS a, CASE WHEN v.id % 7 = 0 THEN"
            " list_transform(v.e, lambda x: -x) ELSE v.e END AS b FROM v AS q, v WHERE v.id % 11 != 0)",
            "cosine",
        ),
    ),
    "knn_pivots": (knn_pivots("euclidean"), _ranked_sql(PAIRS_SQL, "euclidean")),
    "knn_pivots_spread": (knn_pivots("cosine", max_sent=0, slice_rows=40), _ranked_sql(PAIRS_SQL, "cosine")),
    "ann_mmr": (ann_mmr, _mmr_sql(_probe_sql(3), 20, 5, 0.3)),
    "ann_codes_cosine": (ann_codes("cosine"), _ranked_sql(PAIRS_SQL, "cosine")),
    "ann_codes_euclidean": (ann_codes("euclidean"), _ranked_sql(PAIRS_SQL, "euclidean")),
    "code_sizes": (
        code_sizes,
        "SELECT count(*) AS n_rows, CAST(max(len(embedding)) // 4 + 12 AS INTEGER) AS code_bytes, CAST(4 * max(len("
        "embedding)) AS INTEGER) AS vector_bytes FROM embeddings",
    ),
    "ann_kmeans_probe": (ann_kmeans_probe, None),
    "lsh_join": (lsh_join, None),
    "index_stats": (
        lambda spark, sf_dir: ivf.index_stats(_label_index(spark, sf_dir)),
        ALL_CELL_SIZES_SQL,
    ),
    "index_rebuild": (
        index_rebuild,
        "SELECT count(*) AS n_rows, count(DISTINCT label) AS n_cells, CAST(0 AS BIGINT) AS n_not_indexed FROM embeddings",
    ),
    "index_health": (index_health, _health_sql()),
}

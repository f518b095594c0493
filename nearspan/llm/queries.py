"""Registered queries of the training-data operators, each beside the SQL it must agree with, if any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearspan.llm import (
    bpe,
    collocations,
    decontaminate,
    mixing,
    near,
    periodic,
    privacy,
    quality,
    repeats,
    scoring,
    secrets,
    sharding,
    wrappers,
)
from nearspan.llm.common import WORD, load


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 400 bytes."""
    return repeats.document_repeats(load(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word statistics and the cascade's verdict of every document."""
    rows = quality.measure(load(spark, sf_dir, "documents"))
    m = F.col("measured")
    base_failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(
        "doc_id",
        *(m[name].alias(name) for name in names),
        base_failed.alias("base_failed"),
        (~base_failed & m["rejected_by"].isNull()).alias("kept"),
    )


QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
s AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
  CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(regexp_extract_all(t, '[A-Z][A-Z]')) AS pairs
  FROM w LEFT JOIN cov ON cov.r = w.r),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * n_lines OR 4 * pairs > word_chars
  OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM b
"""


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret in the documents."""
    return secrets.document_secrets(load(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.document_shards(load(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near.document_groups(load(spark, sf_dir, "documents"))


# All pairs of distinct sets that share a shingle, so it suits small tables only.
NEAR_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
  ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s FROM d),
u AS MATERIALIZED (SELECT min(doc_id) AS id, s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
x AS MATERIALIZED (SELECT id, n, unnest(s) AS g FROM u),
e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM x a JOIN x b ON a.g = b.g AND a.id < b.id
  AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(id, root) AS (SELECT id, id FROM u UNION SELECT b, root FROM reach JOIN both_ways ON a = id),
c AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.root, s.doc_id) AS component_id,
  s.doc_id = coalesce(c.root, s.doc_id) AS kept
FROM s LEFT JOIN u ON u.s = s.s LEFT JOIN c ON c.id = u.id
"""


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item that stands in it."""
    return decontaminate.passages(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mixed_documents(load(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    return privacy.document_personal_data(load(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return scoring.score_documents(load(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.page_texts(load(spark, sf_dir, "pages"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text that they decode to, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(load(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language."""
    return collocations.collocations(load(spark, sf_dir, "documents"))


# Counts are HUGEINT, which holds the products.
COLLOCATION_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS MATERIALIZED (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
n AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
f1 AS MATERIALIZED (SELECT lang, w1, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY lang, w1),
f2 AS MATERIALIZED (SELECT lang, w1, w2, CAST(count(*) AS HUGEINT) AS f FROM g WHERE w2 IS NOT NULL GROUP BY lang, w1, w2),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, CAST(count(*) AS HUGEINT) AS f FROM g WHERE w3 IS NOT NULL
  GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10),
c2 AS (SELECT a.lang, a.w1 || ' ' || a.w2 AS phrase, a.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM f2 a JOIN f1 x ON x.lang = a.lang AND x.w1 = a.w1 JOIN f1 y ON y.lang = a.lang AND y.w1 = a.w2
  WHERE a.f >= 10 AND NOT EXISTS (SELECT 1 FROM f3 b WHERE b.lang = a.lang AND 100 * b.f >= 50 * a.f
    AND b.w1 = a.w1 AND b.w2 = a.w2) AND NOT EXISTS (SELECT 1 FROM f3 b WHERE b.lang = a.lang
    AND 100 * b.f >= 50 * a.f AND b.w2 = a.w1 AND b.w3 = a.w2)),
c3 AS (SELECT a.lang, a.w1 || ' ' || a.w2 || ' ' || a.w3 AS phrase, a.f AS a, x.f AS l, y.f AS r, 1 AS k
  FROM f3 a JOIN f1 x ON x.lang = a.lang AND x.w1 = a.w1
  JOIN f2 y ON y.lang = a.lang AND y.w1 = a.w2 AND y.w2 = a.w3
  UNION ALL SELECT a.lang, a.w1 || ' ' || a.w2 || ' ' || a.w3, a.f, x.f, y.f, 2
  FROM f3 a JOIN f2 x ON x.lang = a.lang AND x.w1 = a.w1 AND x.w2 = a.w2
  JOIN f1 y ON y.lang = a.lang AND y.w1 = a.w3),
s AS (SELECT *, (1000000 * a * a) // (l * r) AS score FROM (SELECT * FROM c2 UNION ALL SELECT * FROM c3)),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM s) WHERE o = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m)
SELECT r.lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n.n,
  CAST(score AS BIGINT) AS score
FROM r JOIN n ON n.lang = r.lang WHERE rank <= 2000
"""


def wrapped_words(docs: DataFrame) -> DataFrame:
    """Documents, of which about one in ten repeats a stretch of its words from some word on.

    With ``h`` the checksum of the id and ``g = h div 10``, the words from ``a = g % n`` on become the ``p`` words
    from there, over and over, if ``h % 10`` is 0.
    """
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    h, n = F.crc32(F.col("doc_id").cast("string")), F.size(words).cast("long")
    g = F.floor(h / 10)
    a = F.pmod(g, F.greatest(n, F.lit(1)))
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
    part = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int")))
    text = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int")))
    wrapped = F.when((h % 10 == 0) & (n > 0), F.array_join(text, " ")).otherwise(F.col("text"))
    return docs.select("doc_id", wrapped.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, the greatest one, and digests of all and of the collapsed text."""
    found = periodic.periodic_runs(wrapped_words(load(spark, sf_dir, "documents")))
    # Runs come by start and period, so the first of equal ones stays.
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.element_at("runs", F.when(F.size("runs") > 0, 1)),
        lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    rows = found.withColumn("best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_suffix_array_dedup": (op1_suffix_array_dedup, None),
    "op2_quality_rules": (op2_quality_rules, QUALITY_SQL),
    "op3_secret_scan": (op3_secret_scan, None),
    "op4_sharding": (op4_sharding, None),
    "op5_near_duplicates": (op5_near_duplicates, NEAR_SQL),
    "op6_decontamination": (op6_decontamination, None),
    "op7_mixing": (op7_mixing, None),
    "op8_personal_data": (op8_personal_data, None),
    "op9_lm_scoring": (op9_lm_scoring, None),
    "op10_html_extraction": (op10_html_extraction, None),
    "op11_bpe": (op11_bpe, None),
    "op12_phrase_collocations": (op12_phrase_collocations, COLLOCATION_SQL),
    "op13_periodic_runs": (op13_periodic_runs, None),
}

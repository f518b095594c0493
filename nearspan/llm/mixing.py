"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is laid out as a line of words in a permuted order of its documents and cut into
blocks.  Its target, in blocks, is its quota; quotas beyond one pass go around the line again.  A tree
splits the quotas of all sources among the output shards: at each node the blocks of the left half
are drawn without replacement from the node's quotas, so that every shard is a fair sample of the
mix and the quotas are met exactly.  A shard then owns a run of block numbers of each source; the runs
are disjoint.  Inside a shard, blocks are shuffled by a hash.

Only DataFrame functions are used.  Nothing is random: the order and all draws are hashes of a seed.
Sources are the distinct values of the column, null being one of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nearspan.llm.common import unit_hash, whole
from nearspan.llm.quality import bound, n_words

BLOCK_WORDS = 4096
LEAST_BLOCKS = 256
ROWS_PER_BIN = 1000


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source, source_size, n_rows, number, target`` from ``source, source_size, n_rows``.

    Sources in code point order (null last) weigh the given weights in turn and share ``share`` of
    all words; a target stops at ``most`` times its source and the rest goes to the others by weight.
    One row per source meets in one task here.
    """
    everything = W.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("number", F.row_number().over(by_name) - 1)
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod("number", F.lit(len(weights))))
    weighed = weighed.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    # Sources reach their caps in the order of cap per weight as the common level rises.
    rising = everything.orderBy(F.col("cap") / F.col("weight"), "number")
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (share * F.sum("source_size").over(everything) - capped) / weight_left
    leveled = weighed.withColumn("level", level).withColumn("rank", F.row_number().over(rising))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("rank", "level"))
    final = F.min(fits).over(everything)["level"]
    target = F.coalesce(F.least(F.col("cap"), final * F.col("weight")), F.col("cap"))
    return leveled.withColumn("target", target).select("source", "source_size", "n_rows", "number", "target")


def hypergeometric(population: Column, good: Column, draws: Column, unit: Column) -> Column:
    """The number of good ones among ``draws`` from ``population``, by inversion of ``unit`` in [0, 1).

    The distribution is summed over ten standard deviations around its mean, from ratios of
    neighbouring probabilities.
    """
    n, k, d = (c.cast("double") for c in (population, good, draws))
    mean = F.when(n > 0, d * k / n).otherwise(0.0)
    spread = F.when(n > 1, F.sqrt(mean * (1 - k / n) * (n - d) / (n - 1))).otherwise(0.0)
    low = F.greatest(F.lit(0), draws + good - population, F.floor(mean - 10 * spread - 10)).cast("long")
    high = F.least(good, draws, F.ceil(mean + 10 * spread + 10)).cast("long")

    def ratio(x: Column) -> Column:
        """Probability of x over that of x - 1."""
        x = x.cast("double")
        return (k - x + 1) * (d - x + 1) / (x * (n - k - d + x))

    def inverted(steps: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("sum"))

        def add(state: Column, x: Column) -> Column:
            p = state["p"] * ratio(x)
            return F.struct(p.alias("p"), (state["sum"] + p).alias("sum"))

        def search(limit: Column) -> Column:
            begin = F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("sum"), low.alias("x"))

            def step(state: Column, x: Column) -> Column:
                p = state["p"] * ratio(x)
                moved = F.struct(p.alias("p"), (state["sum"] + p).alias("sum"), x.alias("x"))
                return F.when(state["sum"] > limit, state).otherwise(moved)

            return F.aggregate(steps, begin, step, lambda state: state["x"])

        return bound(F.aggregate(steps, start, add)["sum"] * unit, search)

    return F.when(high > low, bound(F.sequence(low + 1, high), inverted)).otherwise(low)


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``leaf, number, quota`` from ``number, quota``: the quotas of the sources dealt to the shards.

    Every level of the tree halves the shards of a node; the left half draws its share of the node's
    blocks source by source.  Shards differ by rounding only in their number of blocks.
    """
    root = quotas.agg(F.sort_array(F.collect_list(F.struct("number", "quota"))).alias("parts"))
    nodes = root.select(
        F.lit(0).alias("first"), F.lit(shards).alias("width"), F.col("parts")["quota"].alias("blocks")
    )
    for _ in range(max(shards - 1, 0).bit_length()):
        left_width = F.floor(F.col("width") / 2).cast("int")

        def left_blocks(blocks: Column) -> Column:
            total = F.aggregate(blocks, F.lit(0).cast("long"), lambda s, x: s + x)
            draws = F.floor(total * left_width / F.col("width"))

            def draw(state: Column, item: Column) -> Column:
                unit = unit_hash("first", "width", item["i"], seed=seed)
                taken = hypergeometric(state["population"], item["blocks"], state["draws"], unit)
                return bound(
                    taken,
                    lambda x: F.struct(
                        (state["population"] - item["blocks"]).alias("population"),
                        (state["draws"] - x).alias("draws"),
                        F.concat(state["out"], F.array(x)).alias("out"),
                    ),
                )

            items = F.transform(blocks, lambda b, i: F.struct(i.alias("i"), b.alias("blocks")))
            start = F.struct(
                total.alias("population"), draws.alias("draws"), F.array().cast("array<bigint>").alias("out")
            )
            return F.aggregate(items, start, draw, lambda state: state["out"])

        left = F.when(F.col("width") > 1, left_blocks(F.col("blocks")))
        halves = nodes.withColumn("left", left)
        right = F.zip_with("blocks", "left", lambda all_, taken: all_ - taken)
        children = F.when(
            F.col("width") > 1,
            F.array(
                F.struct(F.col("first"), left_width.alias("width"), F.col("left").alias("blocks")),
                F.struct(
                    (F.col("first") + left_width).alias("first"),
                    (F.col("width") - left_width).cast("int").alias("width"),
                    right.alias("blocks"),
                ),
            ),
        ).otherwise(F.array(F.struct("first", "width", "blocks")))
        nodes = halves.select(F.explode(children).alias("node")).select("node.*")
    return nodes.select(F.col("first").alias("leaf"), F.posexplode("blocks").alias("number", "quota"))


def mix(
    documents: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    shards: int = 8,
    seed: int = 7,
    text: str = "text",
    source: str = "source",
    identity: str = "doc_id",
) -> DataFrame:
    """Every row with ``mixed``: a struct of ``size, source_size, target`` and the drawn ``pieces``.

    A piece is a stretch of words of the document: ``shard, block, turn, begin, words, place``; turn
    counts the passes over the source, ``begin`` is the piece's first word, and pieces of a shard
    stand in the order of ``place``.  A document is drawn at most ``ceil(most)`` times, in whole or in
    part; one without words has no piece.  A column ``mixed`` is replaced, and columns that begin with
    ``_m_`` are reserved.  The number of blocks of a source grows with it, its blocks don't.
    """
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(identity).cast("string"), F.md5(whole(text))))
    rows = documents.drop("mixed").withColumns({"_m_size": n_words(whole(text)), "_m_order": order})
    named = rows.select(F.col(source).alias("source"), F.col("_m_size").alias("size"))
    sizes = named.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    targets = source_targets(sizes, weights, share, most)
    width = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.ceil(F.col("source_size") / LEAST_BLOCKS)))
    targets = targets.withColumn("width", width.cast("long"))
    targets = targets.withColumn("blocks", F.ceil(F.col("source_size") / F.col("width")))
    targets = targets.withColumn("quota", F.round(F.col("target") / F.col("width")).cast("long"))

    leaves = split_quotas(targets.select("number", "quota"), shards, seed)
    ends = F.sum("quota").over(W.partitionBy("number").orderBy("leaf"))
    runs = leaves.withColumn("end", ends).groupBy("number").agg(F.sort_array(F.collect_list("end")).alias("ends"))
    plan = targets.join(runs, "number").select(
        F.struct("source_size", "target", "number", "width", "blocks", "quota", "ends").alias("_m_plan"),
        F.col("source").alias("_m_source"),
        F.ceil(F.col("n_rows") / ROWS_PER_BIN).alias("_m_bins"),
    )

    # Places on the source's line: sums over bins of the permuted order, then inside a bin.
    planned = rows.join(plan, F.col(source).eqNullSafe(F.col("_m_source")))
    unit = F.conv(F.substring("_m_order", 1, 8), 16, 10).cast("long") / float(1 << 32)
    planned = planned.withColumn("_m_bin", F.floor(unit * F.col("_m_bins")))
    key = [F.col("_m_plan.number").alias("_m_number"), F.col("_m_bin").alias("_m_place")]
    bins = planned.groupBy(*key).agg(F.sum("_m_size").alias("words"))
    before = W.partitionBy("_m_number").orderBy("_m_place").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.select("_m_number", "_m_place", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("_m_before"))
    placed = planned.join(
        bins, (F.col("_m_plan.number") == F.col("_m_number")) & (F.col("_m_bin") == F.col("_m_place"))
    )
    inside = (
        W.partitionBy("_m_number", "_m_place")
        .orderBy("_m_order", "_m_size")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    placed = placed.withColumn("_m_start", F.col("_m_before") + F.coalesce(F.sum("_m_size").over(inside), F.lit(0)))

    p, start, size = F.col("_m_plan"), F.col("_m_start"), F.col("_m_size")
    first, last = F.floor(start / p["width"]), F.floor((start + size - 1) / p["width"])

    def of_block(block: Column) -> Column:
        begin = F.greatest(start, block * p["width"])
        end = F.least(start + size, (block + 1) * p["width"])
        turns = F.sequence(F.lit(0), F.lit(int(-(-most // 1)) - 1))

        def piece(turn: Column) -> Column:
            number = block + turn * p["blocks"]
            owner = F.size(F.filter(p["ends"], lambda e: e <= number))
            return F.struct(
                number.alias("number"),
                owner.alias("shard"),
                block.alias("block"),
                turn.alias("turn"),
                (begin - start).alias("begin"),
                (end - begin).alias("words"),
                F.xxhash64(F.lit(seed), p["number"], number, F.col("_m_order")).alias("place"),
            )

        return F.filter(F.transform(turns, piece), lambda x: x["number"] < p["quota"])

    pieces = F.when(size > 0, F.flatten(F.transform(F.sequence(first, last), of_block)))
    shape = "array<struct<number:bigint,shard:int,block:bigint,turn:int,begin:bigint,words:bigint,place:bigint>>"
    pieces = F.coalesce(pieces.cast(shape), F.array().cast(shape))
    mixed = F.struct(
        size.alias("size"),
        p["source_size"].alias("source_size"),
        p["target"].alias("target"),
        pieces.alias("pieces"),
    )
    # Names may hold dots.
    own = [F.col("`" + name.replace("`", "``") + "`") for name in documents.drop("mixed").columns]
    return placed.withColumn("mixed", mixed).select(*own, "mixed")


def taken_words() -> Column:
    return F.aggregate("mixed.pieces", F.lit(0).cast("long"), lambda total, piece: total + piece["words"])


def mixed_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken, shards`` of every document."""
    return mix(documents).select(
        "doc_id",
        "mixed.size",
        "mixed.source_size",
        "mixed.target",
        taken_words().alias("taken"),
        F.array_sort(F.array_distinct(F.col("mixed.pieces")["shard"])).alias("shards"),
    )


def mixed_rows(
    documents: DataFrame, text: str = "text", source: str = "source", identity: str = "doc_id", **settings
) -> DataFrame:
    """The documents of the mix, whole, with their columns of any name: once for each turn that draws their first word."""
    names = documents.columns
    by_place = documents.toDF(*(f"c{i}" for i in range(len(names))))
    roles = {role: f"c{names.index(name)}" for role, name in (("text", text), ("source", source), ("identity", identity))}
    turns = F.filter("mixed.pieces", lambda piece: piece["begin"] == 0)
    mixed = mix(by_place, **roles, **settings)
    return mixed.withColumn("mixed", F.explode(turns)).drop("mixed").toDF(*names)

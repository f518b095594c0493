"""Near-duplicate groups by SetSketch registers, with exact confirmation.

A document's set are the hashes of its word shingles.  A SetSketch has ``m`` registers; each is the
minimum of exponential variables of the set's elements, on a scale whose steps grow by ``BASE``, cut
to one byte.  Registers of a union are the greatest of both, and two registers agree about as often as
the sets overlap.

* Bands of registers are bucket keys.  In a bucket every member is paired with the smallest one only,
  so a bucket of any size gives as many pairs as members.
* The overlap of a pair is estimated jointly, from registers that are greater, smaller and equal, by
  maximum likelihood.  A pair is dropped if overlaps of the threshold or more are far less likely.
* Of each document the likeliest pair is confirmed on the full sets.  This links most of every group.
* Documents that hang together by pairs of any kind form a family.  Where a family has several linked
  groups, its documents outside the largest group are compared with all others of the family, exactly
  and in blocks.  So a link is found although its two ends never met as a pair.
* Families also take pairs that fall short of the threshold ``t`` but may reach ``2 t - 1``.  The share
  that two sets don't have in common is a metric: if one of two linked documents is linked to their
  bucket's smallest member, the other overlaps with that member by ``2 t - 1`` at least.

Equal sets are one node from the start.  The sets are sorted 64-bit hashes of the shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.llm.bytesets import pieces, run_hashes, word_hashes
from nearspan.llm.common import settle, text_key, whole
from nearspan.llm.components import components
from nearspan.operators.sizing import broadcast_if_small

BASE = 1.1
TOP = 255
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
SCALE = 20.0
UNLIKELY = 10.0
BLOCK = 256
PART = 512
_rng = np.random.default_rng(5)
_FACTORS = _rng.integers(1 << 31, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The registers of a set of 64-bit hashes, one byte each.

    The least of uniform 32-bit values becomes an exponential minimum; register ``k`` stands for
    minima between ``BASE**(-k)`` and ``BASE**(1-k)``, cut to 0 .. 255.
    """
    x = (elements >> np.uint64(32)).astype(np.uint32) ^ elements.astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        part = x[at : at + 512]
        np.minimum(least, (_FACTORS[:, None] * part[None, :] + _SHIFTS[:, None]).min(axis=1), out=least)
    unit = (least.astype(np.float64) + 0.5) / 4294967296.0
    level = np.floor(1 - np.log(-np.log1p(-unit) / SCALE) / np.log(BASE))
    return np.clip(level, 0, TOP).astype(np.uint8)


def likely(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, threshold: float) -> np.ndarray:
    """For rows of registers: the likeliest overlap, or -1 where the threshold or more is far less likely."""
    size_a, size_b = size_a.astype(float), size_b.astype(float)
    greater = (a > b).sum(axis=1)[:, None]
    smaller = (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - greater - smaller
    most = np.minimum(size_a, size_b) / np.maximum(size_a, size_b)
    overlap = np.linspace(0, 1, 101)[None, :] * most[:, None]
    u = (size_a / (size_a + size_b))[:, None]

    def step(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = step(u - (1 - u) * overlap), step(1 - u - u * overlap)
    tiny = 1e-12
    fit = greater * np.log(up + tiny) + smaller * np.log(down + tiny) + equal * np.log(np.maximum(1 - up - down, tiny))
    best = fit.max(axis=1)
    high = np.where(overlap >= threshold - 1e-9, fit, -np.inf).max(axis=1)
    high = np.where(most >= threshold, np.maximum(high, fit[:, -1]), -np.inf)
    return np.where(best - high <= UNLIKELY, overlap[np.arange(len(u)), fit.argmax(axis=1)], -1.0)


def text_sets(batch: pa.RecordBatch, shingle: int, column: str = "text") -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of every text of a batch."""
    for first, _, buffer, offsets in pieces(batch, column):
        hashes, begin = word_hashes(buffer, offsets)
        runs, where = run_hashes(hashes, begin, shingle)
        for i in range(len(where) - 1):
            yield first + i, np.unique(runs[where[i] : where[i + 1]])


def _digest(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def sketches(texts: DataFrame, shingle: int) -> DataFrame:
    """``id, key, node, n_shingles, registers`` of ``id, key, text``; the node is a digest of the set, null if it is empty."""
    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, key binary, node binary, n_shingles long, registers binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, registers = [], [], []
            for _, elements in text_sets(batch, shingle):
                sizes.append(len(elements))
                nodes.append(_digest(elements) if len(elements) else None)
                registers.append(sketch(elements).tobytes() if len(elements) else None)
            made = [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(registers, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), *made], ["id", "key", "node", "n_shingles", "registers"]
            )

    return texts.mapInArrow(run, schema)


def _bands(nodes: DataFrame) -> DataFrame:
    """``node, bucket`` for every band."""
    parts = [
        F.xxhash64(F.lit(i), F.substring("registers", i * ROWS + 1, ROWS)).alias("bucket") for i in range(BANDS)
    ]
    return nodes.select("node", F.explode(F.array(*parts)).alias("bucket"))


def _stars(members: DataFrame) -> DataFrame:
    """``bucket, a, b``: every member b of a bucket with the bucket's smallest member a."""
    hubs = members.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("n"))
    hubs = hubs.filter("n > 1").drop("n")
    return members.join(hubs, "bucket").filter("node <> a").select("bucket", "a", F.col("node").alias("b"))


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """``a, b, overlap, related`` of distinct pairs.

    The overlap is -1 where it is surely below the threshold ``t``; ``related`` is false where it is
    surely below ``2 t - 1`` too.
    """
    sides = nodes.select("node", "n_shingles", "registers")
    left = sides.select(*(F.col(c).alias(f"{c}_a") for c in sides.columns))
    right = sides.select(*(F.col(c).alias(f"{c}_b") for c in sides.columns))
    joined = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(f"n_shingles_{s}").to_numpy() for s in "ab"]
            rows = [
                np.frombuffer(b"".join(batch.column(f"registers_{s}").to_pylist()), np.uint8).reshape(-1, REGISTERS)
                for s in "ab"
            ]
            overlaps = likely(*rows, *sizes, threshold)
            related = likely(*rows, *sizes, max(0.0, 2 * threshold - 1)) >= 0
            made = [pa.array(overlaps, pa.float64()), pa.array(related, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *made], ["a", "b", "overlap", "related"])

    columns = ["a", "b", "n_shingles_a", "n_shingles_b", "registers_a", "registers_b"]
    return joined.select(*columns).mapInArrow(run, "a binary, b binary, overlap double, related boolean")


def _enough(common: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (size_a + size_b - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets overlap enough."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("elements_a"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("elements_b"))
    joined = pairs.select("a", "b").join(right, "b").join(left, "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("elements_a"), batch.column("elements_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                keep.append(_enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "elements_a", "elements_b").mapInArrow(run, "a binary, b binary")


def _full_sets(texts: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``node, elements`` of the wanted ``key, node``, from one text of each."""
    chosen = texts.join(broadcast_if_small(wanted.select("key", "node")), "key").select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            elements = [x.tobytes() for _, x in text_sets(batch, shingle)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(elements, pa.binary())], ["node", "elements"])

    return chosen.mapInArrow(run, "node binary, elements binary").dropDuplicates(["node"])


def _against(members: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between the strays of a family and its members of other groups.

    ``members`` are ``family, node, root, main, elements``; strays are those outside the family's
    largest group.  Strays are dealt into blocks of about ``BLOCK`` and members into parts of about
    ``PART``; every block meets every part of its family in a task of their own, so no family has to fit
    anywhere.
    """
    counts = members.groupBy("family").agg(
        F.ceil(F.count("*") / PART).alias("parts"),
        F.ceil(F.count(F.when(F.col("root") != F.col("main"), 1)) / BLOCK).alias("blocks"),
    )
    counts = settle(counts, "counts")
    dealt = members.join(counts, "family").withColumn("deal", F.xxhash64("node"))
    block, part = F.pmod("deal", "blocks").alias("block"), F.pmod("deal", "parts").alias("part")
    every_part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    rows = ["node", "root", "elements"]
    strays = dealt.filter("root <> main").select("family", block, every_part, *rows)
    strays = strays.select(*(F.col(c).alias(f"stray_{c}") for c in strays.columns))
    others = dealt.select("family", every_block, part, *rows)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        held = _Block(left)
        found = [pair for row in right.select(rows).to_pylist() for pair in held.linked(row, percent)]
        return pa.table([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["a", "b"])

    def checked(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table([pa.array([], pa.binary())] * 2, ["a", "b"])
        return run(left, right) if left.num_rows and right.num_rows else empty

    key = ["family", "block", "part"]
    return strays.groupBy(*(f"stray_{c}" for c in key)).cogroup(others.groupBy(*key)).applyInArrow(checked, "a binary, b binary")


class _Block:
    """Strays of a family, ready to be compared with one set after another."""

    def __init__(self, strays: pa.Table) -> None:
        self.nodes, self.roots = strays.column("stray_node").to_pylist(), strays.column("stray_root").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in strays.column("stray_elements").to_pylist()]
        self.sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        elements = np.concatenate(sets)
        order = np.argsort(elements, kind="stable")
        self.elements, self.owner = elements[order], owner[order]

    def linked(self, row: dict, percent: int) -> list[tuple[bytes, bytes]]:
        """The row with one linked stray of every group that is not the row's own."""
        own = np.frombuffer(row["elements"], np.uint64)
        low = np.searchsorted(self.elements, own, "left")
        counts = np.searchsorted(self.elements, own, "right") - low
        at = np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        common = np.bincount(self.owner[at], minlength=len(self.nodes))
        hits = np.flatnonzero(_enough(common, self.sizes, len(own), percent))
        found = {self.roots[i]: self.nodes[i] for i in hits if self.roots[i] != row["root"]}
        return [(row["node"], stray) for stray in found.values()]


def near_groups(documents: DataFrame, shingle: int, percent: int = 80, text: str = "text") -> DataFrame:
    """``id, key, node, n_shingles, group`` of every row of ``id`` and the text column.

    Rows whose sets share at least ``percent`` of their union are linked, and ``group`` is the smallest
    node that links lead to.  Rows with an empty or null text have no node and no group.  ``key`` is a
    digest of the text.  Ids are only carried along: null and repeated ones are kept.
    """
    threshold = percent / 100
    filled = whole(text)
    texts = documents.select("id", text_key(filled).alias("key"), filled.alias("text"))
    rows = settle(sketches(texts, shingle), "sketches")
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("key").alias("key"), F.max("n_shingles").alias("n_shingles"), F.max("registers").alias("registers")
    )
    nodes = settle(nodes, "nodes")

    stars = settle(_stars(_bands(nodes)), "stars")
    guesses = settle(_estimated(stars.select("a", "b").distinct(), nodes, threshold), "guesses")
    # Members that only met a stranger get a second try among themselves, and hang together in any case.
    lone = stars.join(guesses.filter("overlap < 0").select("a", "b"), ["a", "b"])
    seconds = settle(_stars(lone.select("bucket", F.col("b").alias("node"))).select("a", "b").distinct(), "seconds")
    later = _estimated(seconds, nodes, threshold)
    guesses = settle(guesses.unionByName(later).filter("overlap >= 0 OR related"), "guesses")
    glue = guesses.select("a", "b").unionByName(seconds)
    guesses = guesses.filter("overlap >= 0")

    best = guesses.groupBy("b").agg(F.max(F.struct("overlap", "a"))["a"].alias("a")).select("a", "b")
    best = settle(best, "best")
    wanted = best.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "key"), "node")
    sets = settle(_full_sets(texts.drop("id"), wanted, shingle), "sets")
    links = settle(_confirmed(best, sets, percent), "links")

    families = components(glue).withColumnRenamed("root", "family")
    placed = families.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = settle(placed, "placed")
    counted = placed.groupBy("family", "root").count()
    largest = counted.groupBy("family").agg(
        F.max(F.struct("count", "root"))["root"].alias("main"), F.count("*").alias("parts")
    )
    largest = settle(largest.filter("parts > 1").drop("parts"), "largest")
    split = placed.join(largest, "family")
    missing = split.join(sets.select("node"), "node", "left_anti").join(nodes.select("node", "key"), "node")
    every = sets.unionByName(_full_sets(texts.drop("id"), missing, shingle))
    members = settle(split.join(every, "node").select("family", "node", "root", "main", "elements"), "members")

    final = components(settle(links.unionByName(_against(members, percent)), "links"))
    joined = rows.drop("registers").join(final.withColumnRenamed("root", "group"), "node", "left")
    return joined.select("id", "key", "node", "n_shingles", F.coalesce("group", "node").alias("group"))


def document_groups(documents: DataFrame, shingle: int = 2, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document.

    The component is named by its smallest doc_id; a null id names it only if there is no other.
    """
    groups = near_groups(documents.withColumn("id", F.col("doc_id")), shingle, percent)
    names = groups.filter("group IS NOT NULL").groupBy("group").agg(F.min("id").alias("least"))
    names = settle(names, "names")
    component = F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("least"))
    return groups.join(names, "group", "left").select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def one_of_each(documents: DataFrame, shingle: int = 5, percent: int = 80, identity: str = "doc_id") -> DataFrame:
    """The documents with one of each group: the one with the smallest id, and of equal ids the smallest digest.

    Documents without words stay, those with a null text too.  Rows that repeat an id and a text stay once.  Columns
    of any name are kept as they are.
    """
    groups = near_groups(documents.withColumn("id", F.col(identity)), shingle, percent)
    own = F.coalesce("group", F.unhex(F.md5(F.concat_ws(":", F.lit("alone"), F.col("id").cast("string")))))
    chosen = groups.withColumn("group", own).groupBy("group").agg(
        F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))).alias("first")
    )
    chosen = settle(chosen.select("first.id", "first.key"), "kept")
    # The columns travel as one, so that none can be taken for those of the join.
    keyed = documents.select(F.struct("*").alias("row"), F.col(identity).alias("row_id"), text_key(whole("text")).alias("row_key"))
    same = F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key"))
    kept = keyed.join(broadcast_if_small(chosen), same, "left_semi").select("row.*")
    return kept.dropDuplicates([identity, "text"])

"""Phrases of two and three words that stand together more often than their parts let expect, by language.

A text is lower-cased (A-Z) and cut into pieces at ``. , ; : ! ?`` and line ends, a piece into words at blanks and
tabs.  Phrases never cross pieces.  A phrase with ``a`` occurrences, cut after its first ``k`` words into parts with
``l`` and ``r`` occurrences, scores ``floor(10**6 * a * a / (l * r))``; its lowest-scoring cut counts.

The counts are streams of rows ``(lang, w1, w2, w3, a)``, one for each phrase length, written twice: in prefix order
(sorted by the words) and in suffix order (sorted by the words from the last to the first).

* In prefix order a phrase stands behind its first part, so merging the streams of two lengths gives left counts; a
  phrase's one-word extensions to the right stand together behind it.
* In suffix order the same holds for last parts, right counts and extensions to the left.

All lookups are therefore merge joins of sorted streams (Spark's sort-merge join, asked for by hint), and no table of
counts is held in memory or hashed.  A skewed first word is split by adaptive execution, as the other side has one
row for it.

Only phrases that can be candidates are counted to the end: three words that occur ``least`` times contain two pairs
that do.  The pairs that do are marked in a bitmap of fixed size (``FILTER_BITS``), which tasks ask before they count
three words; a pair that is marked by chance costs a row and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearspan.llm.bytesets import lower, mix, pieces, prefix_hashes, stretch_hashes
from nearspan.llm.common import settle, whole

CHUNK_BYTES = 4 << 20
HASHED_BYTES = 1 << 20
SENT_ROWS = 20_000
FILTER_BITS = 1 << 27
# A phrase and its language in one key: no word contains the line end between them.
COUNTS = "key string, a bigint"
# What separates pieces, and words in a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"


def _class_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


ENDS, GAPS = _class_table(PIECE_ENDS), _class_table(PIECE_ENDS + BLANKS)


class Words:
    """The words of a chunk of texts: codes equal for equal words only, and whether the next word goes on the piece."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray, langs: pa.Array):
        buffer = lower(buffer)
        n = len(buffer)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        inside = np.zeros(n + 1, bool)
        inside[:n] = ~GAPS[buffer]
        before = np.r_[False, inside[:-1]]
        begin, end = np.flatnonzero(inside & (~before | edge)), np.flatnonzero(before & (~inside | edge))
        row = np.searchsorted(offsets, begin, side="right") - 1
        piece = np.cumsum(ENDS[buffer], dtype=np.int64)[begin] if n else np.zeros(0, np.int64)
        steps = np.zeros(n + 1, np.int8)
        steps[begin] += 1
        steps[end] -= 1
        packed = buffer[np.cumsum(steps[:-1], dtype=np.int8).astype(bool)]
        bounds = np.r_[0, np.cumsum(end - begin)].astype(np.int64)
        texts = pa.Array.from_buffers(
            pa.large_string(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(packed)]
        ).dictionary_encode()
        self.code, self.names = texts.indices.to_numpy().astype(np.int64), texts.dictionary
        langs = langs.dictionary_encode()
        self.lang, self.langs = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row], langs.dictionary
        self.goes_on = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])

    def counted(self, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """One place of each different run of ``size`` words that begins at the places, and how many there are."""
        key = self.lang[places] * len(self.names) + self.code[places]
        for i in range(1, size):
            key = np.unique(key, return_inverse=True)[1] * len(self.names) + self.code[places + i]
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        return places[first], count

    def counts(self, places: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
        """Occurrences of the runs of ``size`` words that begin at the places, in batches of bounded size."""
        places, count = self.counted(places, size)
        for at in range(0, len(places), SENT_ROWS):
            yield self.rows(places[at : at + SENT_ROWS], size, count[at : at + SENT_ROWS])

    def rows(self, places: np.ndarray, size: int, count: np.ndarray) -> pa.RecordBatch:
        words = [self.names.take(pa.array(self.code[places + i])) for i in range(size)]
        phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if size > 1 else words[0]
        return _batch(phrase, self.langs.take(pa.array(self.lang[places])), count)

    def totals(self) -> pa.RecordBatch:
        """How many words each language has, as counts of the phrase of no word."""
        count = np.bincount(self.lang)
        langs = np.flatnonzero(count)
        return _batch(pa.array([""] * len(langs), pa.large_string()), self.langs.take(pa.array(langs)), count[langs])

    def marked(self, bits: np.ndarray) -> np.ndarray:
        """Places of the words that begin three words of which both pairs are marked."""
        word, lang = text_hashes(self.names), text_hashes(self.langs)
        places = np.flatnonzero(self.goes_on)
        mark = pair_marks(lang[self.lang[places]], word[self.code[places]], word[self.code[places + 1]])
        begins = np.zeros(len(self.code) + 1, bool)
        begins[places] = bits[mark >> 6] >> (mark & 63).astype(np.uint64) & np.uint64(1) > 0
        return np.flatnonzero(begins[:-1] & begins[1:])


def _batch(phrase: pa.Array, lang: pa.Array, count: np.ndarray) -> pa.RecordBatch:
    key = pc.binary_join_element_wise(phrase, lang.cast(pa.large_string()), pa.scalar("\n", pa.large_string()))
    return pa.RecordBatch.from_arrays([key.cast(pa.string()), pa.array(count.astype(np.int64))], names=["key", "a"])


def text_hashes(texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    for at, n, buffer, offsets in pieces(pa.record_batch({"text": texts}), "text", HASHED_BYTES):
        out[at : at + n] = stretch_hashes(prefix_hashes(buffer), offsets[:-1], offsets[1:])
    return out


def pair_marks(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Place in the bitmap of each pair of words of a language, from the three hashes."""
    mixed = mix(mix(mix(lang) + first) + second)
    return (mixed >> np.uint64(1)).astype(np.int64) & (FILTER_BITS - 1)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole("text").alias("text"))


def _counted(docs: DataFrame, count) -> DataFrame:
    """The counts that a function gives of each chunk of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, buffer, offsets in pieces(batch, "text", CHUNK_BYTES):
                yield from count(Words(buffer, offsets, batch.column("lang").slice(at, n)))

    return _texts(docs).mapInArrow(run, COUNTS)


def _first_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of words and pairs, and how many words there are, by chunk."""

    def count(words: Words) -> Iterator[pa.RecordBatch]:
        yield words.totals()
        yield from words.counts(np.arange(len(words.code)), 1)
        yield from words.counts(np.flatnonzero(words.goes_on), 2)

    return _counted(docs, count)


def _bitmap(pairs: DataFrame) -> np.ndarray:
    """One bit per mark of the pairs, ``FILTER_BITS`` in all; at most that many bits reach the driver."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(pair_marks(*(text_hashes(batch.column(name)) for name in ("lang", "w1", "w2"))))
            yield pa.record_batch({"slot": pa.array((at >> 6).astype(np.int32)), "bit": pa.array(at & 63)})

    marks = pairs.select("lang", "w1", "w2").mapInArrow(mark, "slot int, bit bigint")
    word = F.bit_or(F.expr("shiftleft(1L, cast(bit AS int))")).alias("word")
    table = marks.groupBy("slot").agg(word).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[table["slot"].to_numpy()] = table["word"].to_numpy().view(np.uint64)
    return bits


def _triple_counts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Occurrences of three words of which both pairs are marked, by chunk."""
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(pairs))
    return _counted(docs, lambda words: words.counts(words.marked(sent.value), 3))


def _totals(counts: DataFrame, least: int) -> DataFrame:
    """Summed counts ``(lang, size, phrase, a)`` of phrases with ``least`` occurrences, and of that of no word."""
    summed = counts.groupBy("key").agg(F.sum("a").alias("a"))
    phrase = F.substring_index("key", "\n", 1)
    size = F.when(phrase == "", 0).otherwise(1 + F.length(phrase) - F.length(F.translate(phrase, " ", "")))
    rows = summed.where((phrase == "") | (F.col("a") >= least))
    return rows.select(F.expr("substring(key, locate('\\n', key) + 1)").alias("lang"), size.alias("size"), phrase.alias("phrase"), "a")


def _stream(counts: DataFrame, size: int) -> DataFrame:
    """Counts of the phrases of a length, with their words."""
    word = F.split("phrase", " ")
    return counts.where(F.col("size") == size).select(
        "lang", *(word[i].alias(f"w{i + 1}") for i in range(size)), F.col("a")
    )


def _in_order(stream: DataFrame, order: list[str], label: str) -> DataFrame:
    return settle(stream.repartitionByRange("lang", *order).sortWithinPartitions("lang", *order), label)


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(10**6 * a * a / (left * right))`` in whole numbers of up to 38 digits; counts have up to 14."""
    a, left, right = (c.cast("decimal(18,0)") for c in (a, left, right))
    scaled = (F.lit(1_000_000).cast("decimal(7,0)") * a).cast("decimal(20,0)")
    return F.call_function("div", scaled * a, left * right)


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, percent: int = 50) -> DataFrame:
    """The ``top`` phrases of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    Candidates have two or three words and ``least`` occurrences or more; one whose words lie in a longer candidate
    with ``percent`` of its occurrences or more is dropped.  ``l`` and ``r`` are the counts of the parts at the
    lowest-scoring cut, the first of equal ones, and ``n`` is the number of words of the language.  The order is by
    score, then ``a``, both descending, then the phrase by its bytes.

    A null text has no words, a null language counts as ``und``; a language without candidates has no rows, and an
    empty table gives none.  Repeated rows count each time.  Long texts are taken whole.  Only ``lang`` and ``text``
    are read, so other columns may have any name.
    """
    first = settle(_totals(_first_counts(docs), least), "phrase-counts")
    third = settle(_totals(_triple_counts(docs, _stream(first, 2)), least), "phrase-triples")
    ones, twos, threes = _stream(first, 1), _stream(first, 2), _stream(third, 3)
    ones = _in_order(ones, ["w1"], "words")
    prefix = {2: _in_order(twos, ["w1", "w2"], "pairs-prefix"), 3: _in_order(threes, ["w1", "w2", "w3"], "triples-prefix")}
    suffix = {2: _in_order(twos, ["w2", "w1"], "pairs-suffix"), 3: _in_order(threes, ["w3", "w2", "w1"], "triples-suffix")}

    def merged(stream: DataFrame, other: DataFrame, names: list[str], count: str, how: str = "inner") -> DataFrame:
        """The stream with the counts of another one, whose words are called as ``names``."""
        renamed = other.toDF("lang", *names, count)
        return stream.join(renamed.hint("merge"), ["lang", *names], how)

    # Prefix order: first parts, and the most frequent extension to the right.
    longer_right = prefix[3].groupBy("lang", "w1", "w2").agg(F.max("a").alias("most"))
    pairs = merged(merged(prefix[2], ones, ["w1"], "l1"), longer_right, ["w1", "w2"], "most_right", "left")
    triples = merged(merged(prefix[3], ones, ["w1"], "l1"), prefix[2], ["w1", "w2"], "l2")
    # Suffix order: last parts, and the most frequent extension to the left.
    longer_left = suffix[3].groupBy("lang", "w2", "w3").agg(F.max("a").alias("most"))
    ends = merged(suffix[2], ones, ["w2"], "r1").select("lang", "w1", "w2", "r1")
    ends = ends.join(longer_left.toDF("lang", "w1", "w2", "most_left").hint("merge"), ["lang", "w1", "w2"], "left")
    last = merged(merged(suffix[3], ones, ["w3"], "r2"), suffix[2].select("lang", "w1", "w2", "a"), ["w2", "w3"], "r1")
    last = last.select("lang", "w1", "w2", "w3", "r1", "r2")
    pairs = pairs.join(ends.hint("merge"), ["lang", "w1", "w2"])
    triples = triples.join(last.hint("merge"), ["lang", "w1", "w2", "w3"])
    # Dropped by a longer phrase.
    longest = F.greatest(F.coalesce("most_right", F.lit(0)), F.coalesce("most_left", F.lit(0)))
    pairs = pairs.where(100 * longest < percent * F.col("a"))

    def cut(k: int) -> Column:
        left, right = F.col(f"l{k}"), F.col(f"r{k}")
        return F.struct(_score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", cut(1).alias("cut"))
    triples = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.least(cut(1), cut(2)).alias("cut"))
    found = pairs.unionByName(triples).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = first.where("size = 0").select("lang", F.col("a").alias("n"))
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

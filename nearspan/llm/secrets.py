"""Secrets in documents: candidates by form, a random forest against false positives.

A candidate (``kind``) is

* ``form``: a token of a public form (fixed prefixes of keys, signed web tokens, private-key blocks),
* ``assigned``: a value behind the name of a credential and an assignment sign, of any length and with any
  symbols: what stands between quotes on that line, else up to a blank, bracket, comma or the like,
* ``run``: a run of at least ``SHORTEST`` characters of ``A-Za-z0-9+/_-`` with its padding.

Of overlapping candidates the first kind in this order stays.  A candidate is described by

* its length and the shares of digits and capitals,
* character transitions: how often the character class changes, and how likely its letter pairs are in
  the corpus,
* dictionary coverage: the share of it that consists of words of the corpus; a word is in the dictionary
  if at least ``WORD_SHARE`` of all words are this one, so it has ``1 / WORD_SHARE`` entries at most,
* path: slashes in it, before it, and a file ending behind it,
* neighbouring words: names of credentials before it, an assignment sign, quotes; they are read from the
  ``BEFORE`` bytes before it and the ``AFTER`` bytes behind it.

The forest is fitted on labelled findings: those of a given table, or else those whose label is plain
from their form (``labelled``).  The fit takes a hash sample of at most about ``FIT_ROWS`` findings of
either label; everything else covers all rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.llm.bytesets import lower, pieces
from nearspan.llm.common import settle, unit_hash, whole

SHORTEST = 16
BEFORE, AFTER = 80, 16
WORD_SHARE = 1e-5
FIT_ROWS = 20_000
TREES, DEPTH = 30, 8
THRESHOLD = 0.5
FEATURES = (
    "length digits capitals changes likelihood unlikeliest distinct covered slashes after_slash ending"
    " named assigned quoted"
).split()

_BYTES = np.zeros(256, bool)
_BYTES[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True
# Classes of lower-cased bytes for transitions: letters, digit, other.
_CLASS = np.full(256, 27, np.int64)
_CLASS[97:123] = np.arange(26)
_CLASS[48:58] = 26
_NAMED = re.compile(r"(?i)(token|secret|passw(or)?d|pwd|api.?key|access.?key|private.?key|auth|bearer|credential)")
_ENDING = re.compile(r"\.[A-Za-z]{2,4}\b")
_PIECES = re.compile(r"[a-z]+")
# An identifier with the name of a credential, in lower-cased bytes, and the sign behind it, if there is one.  It
# matches without the sign, too, so that a long identifier is read once.
_ASSIGN = re.compile(
    rb"(?:token|secret|passw(?:or)?d|pwd|api.?key|access.?key|private.?key|auth|bearer|credential)[a-z0-9_.-]*+"
    rb"([\"'`\]]*+[ \t]*+(?:=>|:=|==?|:)[ \t]*+|(?<=bearer)[ \t]++)?+"
)
_QUOTED = re.compile(rb"(?:\"((?:[^\"\\\r\n]|\\.)*+)\"|'((?:[^'\\\r\n]|\\.)*+)'|`((?:[^`\\\r\n]|\\.)*+)`)")
_BARE = re.compile(rb"[\"'`]?([^\s\"'`,;<>()\[\]{}]++)")
_SCHEMES = (b"bearer", b"basic", b"token", b"digest")
# Public forms of access keys, tokens of services, signed web tokens and private keys.
_FORMS = re.compile(
    rb"(?<![A-Za-z0-9_-])(?:"
    rb"(?:AKIA|ASIA)[0-9A-Z]{16}"
    rb"|gh[pousr]_[A-Za-z0-9]{36,}"
    rb"|xox[abprs]-[A-Za-z0-9-]{10,}"
    rb"|AIza[0-9A-Za-z_-]{35}"
    rb"|[rs]k_live_[0-9A-Za-z]{24,}"
    rb"|eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++"
    rb")(?![A-Za-z0-9_-])"
    rb"|-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]++-----END [A-Z ]*PRIVATE KEY-----"
)
_HOLLOW = r"^(.)\1*$|^[$%<{]|^\*"


def transitions(documents: DataFrame) -> np.ndarray:
    """Log probability of each character class after each other, over all texts; 28 by 28 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(28 * 28, np.int64)
        for batch in batches:
            for _, _, buffer, offsets in pieces(batch):
                kinds = _CLASS[lower(buffer)]
                # No pair across the border of two texts.
                inside = np.ones(len(kinds), bool)
                inside[offsets[offsets < len(kinds)]] = False
                second = np.flatnonzero(inside[1:]) + 1
                sums += np.bincount(kinds[second - 1] * 28 + kinds[second], minlength=28 * 28)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(28 * 28)), pa.array(sums)], ["pair", "n"])

    rows = documents.select(whole("text").alias("text")).mapInArrow(run, "pair long, n long")
    counts = np.ones((28, 28))
    for pair, n in rows.groupBy("pair").agg(F.sum("n")).collect():
        counts[pair // 28, pair % 28] += n
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def dictionary(documents: DataFrame, share: float = WORD_SHARE) -> frozenset[str]:
    """The words of 4 to 15 letters that make up at least ``share`` of all such words."""
    pattern = F.lit("[a-z]{4,15}")
    text = F.lower(whole("text"))
    total = documents.agg(F.sum(F.regexp_count(text, pattern))).first()[0] or 0
    words = documents.select(F.explode(F.regexp_extract_all(text, pattern, F.lit(0))).alias("word"))
    common = words.groupBy("word").count().filter(F.col("count") >= F.lit(max(share * total, 1.0)))
    return frozenset(row[0] for row in common.select("word").collect())


def covered(candidate: str, words: frozenset[str]) -> float:
    """The largest share of a candidate that words of the dictionary cover without overlap."""
    total = 0
    for run in _PIECES.findall(candidate.lower()):
        best = [0] * (len(run) + 1)
        for end in range(1, len(run) + 1):
            best[end] = best[end - 1]
            for size in range(4, min(15, end) + 1):
                if best[end - size] + size > best[end] and run[end - size : end] in words:
                    best[end] = best[end - size] + size
        total += best[-1]
    return total / len(candidate)


def describe(before: str, candidate: str, after: str, table: np.ndarray, words: frozenset[str]) -> list[float]:
    """The features of a candidate between the text before it and after it, in the order of ``FEATURES``."""
    raw = np.frombuffer(candidate.encode(), np.uint8)
    kinds = _CLASS[lower(raw)]
    likely = table[kinds[:-1], kinds[1:]] if len(raw) > 1 else np.zeros(1)
    capital, digit = (raw >= 65) & (raw <= 90), kinds == 26
    sort = np.where(digit, 2, np.where(capital, 1, np.where(kinds < 26, 0, 3)))
    last = before.rstrip(" \t'\"")
    return [
        float(len(raw)),
        float(digit.mean()),
        float(capital.mean()),
        float((sort[1:] != sort[:-1]).sum() / max(len(raw) - 1, 1)),
        float(likely.mean()),
        float(likely.min()),
        len(set(candidate)) / len(candidate),
        covered(candidate, words),
        float(candidate.count("/")),
        float(before[-1:] in ("/", "\\")),
        float(bool(_ENDING.match(after))),
        float(bool(_NAMED.search(" ".join(before.split()[-3:])))),
        float(last[-1:] in ("=", ":") or last[-2:] == "=>"),
        float(before[-1:] in ("'", '"', "`") and after[:1] == before[-1:]),
    ]


def strong(text: bytes, small: bytes, low: int, high: int) -> list[tuple[int, int, str]]:
    """``(begin, end, kind)`` of the forms and the assigned values between two places, in order, none overlapping."""
    kept = [(m.start(), m.end(), "form") for m in _FORMS.finditer(text, low, high)]
    forms = list(kept)
    for m in _ASSIGN.finditer(small, low, high):
        if m[1] is None:
            continue
        value = _QUOTED.match(text, m.end(), high)
        begin, end = value.span(value.lastindex) if value else (m.end(), m.end())
        if not value and (value := _BARE.match(text, m.end(), high)):
            begin, end = value.start(1), value.start(1) + len(value[1].rstrip(b".:!?"))
        if not text[begin:end].strip() or small[begin:end] in _SCHEMES or _crosses(forms, begin, end):
            continue
        # A name inside a value that is taken already gives no second value there.
        if not kept or kept[-1][2] == "form" or kept[-1][1] <= begin:
            kept.append((begin, end, "assigned"))
    return sorted(kept)


def _crosses(spans: list[tuple], begin: int, end: int) -> bool:
    """Whether one of the spans, in order and apart from each other, overlaps a stretch."""
    at = bisect_left(spans, (end,))
    return at > 0 and spans[at - 1][1] > begin


def candidates(documents: DataFrame, table: np.ndarray, words: frozenset[str]) -> DataFrame:
    """``doc_id, begin, end, value, kind, features`` of every candidate; positions are code points."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "begin", "end", "value", "kind", "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, buffer, offsets in pieces(batch):
                yield one(batch, first, buffer, offsets)

    def runs(buffer: np.ndarray, offsets: np.ndarray) -> tuple[list[int], list[int], list[int]]:
        inside = np.append(_BYTES[buffer], False)
        edge = np.zeros(len(inside), bool)
        edge[offsets] = True
        before = np.append(False, inside[:-1])
        begin = np.flatnonzero(inside & (~before | edge))
        end = np.flatnonzero(before & (~inside | edge))
        long = end - begin >= SHORTEST
        begin, end = begin[long], end[long]
        row = np.searchsorted(offsets, begin, "right") - 1
        # Padding goes up to the next byte that is none, in the same text.
        stops = np.append(np.flatnonzero(buffer != 61), len(buffer))
        end = np.minimum(stops[np.searchsorted(stops, end)], offsets[row + 1])
        return row.tolist(), begin.tolist(), end.tolist()

    def one(batch: pa.RecordBatch, first: int, buffer: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        text, small = buffer.tobytes(), lower(buffer).tobytes()
        places = offsets.tolist()
        spans, held = [], {}
        for r, (low, high) in enumerate(zip(places, places[1:])):
            held[r] = strong(text, small, low, high)
            spans += [(r, *span) for span in held[r]]
        spans += [(r, b, e, "run") for r, b, e in zip(*runs(buffer, offsets)) if not _crosses(held[r], b, e)]
        rest = np.cumsum(np.append(0, (buffer & 0xC0) == 0x80))
        found = []
        for r, b, e, sort in sorted(spans):
            low, high = places[r], places[r + 1]
            value = text[b:e].decode()
            left = text[max(low, b - BEFORE) : b].decode("utf-8", "ignore")
            right = text[e : min(high, e + AFTER)].decode("utf-8", "ignore")
            at = b - low - int(rest[b] - rest[low])
            found.append((first + r, at, at + len(value), value, sort, describe(left, value, right, table, words)))
        ids = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64()))
        columns = [pa.array([f[i + 1] for f in found], t) for i, t in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([ids, *columns], names)

    schema = f"doc_id {kind}, begin long, end long, value string, kind string, features array<double>"
    return documents.select("doc_id", whole("text").alias("text")).mapInArrow(run, schema)


def _features() -> dict[str, Column]:
    return {name: F.col("features")[i] for i, name in enumerate(FEATURES)}


def _credential() -> Column:
    """Values of letters and digits, or more, that are assigned to the name of a credential, and known forms."""
    f = _features()
    mixed = (f["digits"] > 0) & (f["digits"] < 1) & (f["slashes"] < 2)
    hollow = F.col("value").rlike(_HOLLOW)
    return (F.col("kind") == "form") | ((f["named"] > 0) & (f["assigned"] > 0) & mixed & ~hollow)


def labelled(found: DataFrame) -> DataFrame:
    """The findings whose label is plain, with ``label`` 1.0 or 0.0.

    True are known forms and values of letters and digits that are assigned to the name of a credential.
    False are values without a name before them that are words (no digits), numbers (digits alone) or paths,
    and behind a name what only holds a place (one character repeated, a variable, a mask), words of the
    dictionary, and words without quotes.  Known forms come twice, the second time without the words around
    them, so that the forest also learns to know a token by itself.
    """
    f = _features()
    plain = (f["digits"] == 0) | (f["digits"] == 1) | (f["slashes"] >= 2) | (f["after_slash"] > 0)
    letters = F.col("value").rlike("^[A-Za-z]+$")
    empty = F.col("value").rlike(_HOLLOW) | (f["covered"] == 1) | (letters & (f["quoted"] == 0))
    false = F.when(f["named"] == 0, plain).otherwise(empty)
    rows = found.withColumn("label", F.when(_credential(), 1.0).when(false, 0.0)).filter("label IS NOT NULL")
    around = [F.lit(0.0) if n in ("named", "assigned", "quoted") else F.col("features")[i] for i, n in enumerate(FEATURES)]
    alone = rows.filter("kind = 'form'").withColumn("features", F.array(*around))
    return rows.unionByName(alone)


def fit(findings: DataFrame, fit_rows: int = FIT_ROWS) -> RandomForestClassificationModel | None:
    """The forest of ``features, label``; None unless there are findings of both labels."""
    counts = {row["label"]: row["count"] for row in findings.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("label") == 1.0, fit_rows / counts[1.0]).otherwise(fit_rows / counts[0.0])
    sample = findings.filter(unit_hash("features", "label", seed=3) < share)
    weight = F.when(F.col("label") == 1.0, F.greatest(F.lit(1.0), F.lit(counts[0.0] / counts[1.0] / 10)))
    rows = sample.select(
        array_to_vector("features").alias("vector"), "label", weight.otherwise(1.0).alias("weight")
    )
    forest = RandomForestClassifier(
        featuresCol="vector", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=3, featureSubsetStrategy="sqrt"
    )
    return forest.fit(rows)


def judged(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """The findings with ``probability`` of being a secret; without a model it is 1 for plainly true ones, else 0."""
    if model is None:
        return found.withColumn("probability", _credential().cast("double"))
    scored = model.transform(found.withColumn("vector", array_to_vector("features")))
    return scored.withColumn("probability", vector_to_array("probability")[1]).select(*found.columns, "probability")


def scan(documents: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, begin, end, value, probability`` of every secret.

    ``findings`` may give labels: ``doc_id, begin, end, label``.  Null and empty texts have no candidates and an
    empty table gives no rows; repeated rows give repeated findings, and null ids stay null.  Texts of any length are
    read whole and never cut.  A probability equal to the threshold counts as a secret.  Other columns are ignored.
    Where the labels are all of one kind there is no forest, and the plain rule decides.
    """
    found = settle(candidates(documents, transitions(documents), dictionary(documents)), "candidates")
    known = labelled(found)
    if findings is not None:
        known = found.join(findings.select("doc_id", "begin", "end", F.col("label").cast("double")), ["doc_id", "begin", "end"])
    rated = judged(found, fit(known))
    return rated.filter(F.col("probability") >= threshold).select("doc_id", "begin", "end", "value", "probability")


def document_secrets(documents: DataFrame) -> DataFrame:
    """``doc_id, begin, end, secret_sha256, probability`` of every secret in the documents."""
    rows = scan(documents.select("doc_id", "text"))
    return rows.select("doc_id", "begin", "end", F.sha2(F.col("value").cast("binary"), 256).alias("secret_sha256"), "probability")

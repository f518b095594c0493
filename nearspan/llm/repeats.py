"""Removal of long byte strings that occur more than once, by a hash-compared suffix sort.

Every window of ``width`` bytes is named by its anchor: the place of the least ``GRAM``-byte hash in
it.  Equal windows have equal anchors at equal distances, so windows need only be compared with
windows of the same anchor hash, and a string whose anchors occur once in all texts is settled by
counting.  Neighbouring windows with one anchor make a fragment.

* Fragments that are equal as a whole are found by counting too.
* Of the other fragments with a common anchor, the suffixes that begin at each window are sorted by
  mergesort.  Two suffixes are compared by their first differing byte, which a binary search over
  prefix polynomial hashes finds in ``log2(width)`` steps.  Windows next to each other in the order
  whose common extension reaches ``width`` are repeats; their bytes are compared to rule out collisions.
* An anchor with more than ``MOST_FRAGMENTS`` different fragments would load one task.  Its windows are
  dealt by two independent 64-bit hashes instead, so that only equal ones meet and are counted.

Texts are bytes of UTF-8, null is empty, and texts shorter than ``width`` have no window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearspan.llm.bytesets import mix, pieces, powers, prefix_hashes, stretch_hashes
from nearspan.llm.common import settle, text_key, whole
from nearspan.operators.sizing import broadcast_if_small

WIDTH = 400
GRAM = 128
MOST_FRAGMENTS = 4096
BATCH_BYTES = 1 << 20


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` values."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def fragments(buffer: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The fragments of joined texts: row, first window, anchor, number of windows and three hashes.

    ``key`` is the hash of the anchor's bytes; ``frag`` and ``check`` are independent hashes of the
    whole fragment that also cover the anchor's place in it.
    """
    none = np.zeros(0, np.int64)
    if len(buffer) < width:
        return dict.fromkeys(("row", "first", "anchor", "span", "key", "frag", "check"), none)
    sums = prefix_hashes(buffer)
    at = np.arange(len(buffer) - gram + 1)
    hashes = stretch_hashes(sums, at, at + gram)
    packed = (hashes >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)
    anchor = (_sliding_min(packed, width - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    valid = np.arange(width, width + len(anchor)) <= np.repeat(offsets[1:], np.diff(offsets))[: len(anchor)]
    window = np.flatnonzero(valid)
    row, anchor = row[window], anchor[window]
    if not len(window):
        return dict.fromkeys(("row", "first", "anchor", "span", "key", "frag", "check"), none)
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    span = np.diff(np.append(begin, len(window)))
    first, anchor, row = window[begin], anchor[begin], row[begin]
    lead = (anchor - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    end = first + span - 1 + width
    other = prefix_hashes(buffer, other=True)
    return {
        "row": row,
        "first": first,
        "anchor": anchor,
        "span": span,
        "key": hashes[anchor].view(np.int64),
        "frag": mix(stretch_hashes(sums, first, end) ^ lead).view(np.int64),
        "check": mix(stretch_hashes(other, first, end) ^ lead).view(np.int64),
    }


class Suffixes:
    """Suffixes of a byte buffer, compared over their first ``width`` bytes by prefix hashes."""

    def __init__(self, buffer: np.ndarray, width: int) -> None:
        self.buffer, self.width = buffer, width
        self.sums = prefix_hashes(buffer)
        self.scale = powers(len(buffer) + 1)[0]
        self.windows = np.lib.stride_tricks.sliding_window_view(buffer, width) if len(buffer) >= width else None

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension from places x and y, at most ``width``."""
        at_x, at_y, scale_x, scale_y = self.sums[x], self.sums[y], self.scale[x], self.scale[y]
        length = np.zeros(len(x), np.int64)
        step = 1 << (self.width.bit_length() - 1)
        while step:
            tried = length + step
            fits = tried <= self.width
            tried = np.where(fits, tried, length)
            same = (self.sums[x + tried] - at_x) * scale_y == (self.sums[y + tried] - at_y) * scale_x
            length = np.where(fits & same, tried, length)
            step >>= 1
        return length

    def before(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix x comes before y; where ``or_equal`` holds, equal ones count too."""
        length = self.common(x, y)
        differ = length < self.width
        last = len(self.buffer) - 1
        smaller = self.buffer[np.minimum(x + length, last)] < self.buffer[np.minimum(y + length, last)]
        return np.where(differ, smaller, or_equal)

    def mergesort(self, places: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sorts the suffixes of each group ``places[begin : begin + size]``, all groups at once.

        Runs double in every round; a suffix finds its place in the neighbouring run by binary search.
        """
        places = places.copy()
        width = 1
        while len(size) and width < size.max():
            open_groups = size > width
            begin, size = begin[open_groups], size[open_groups]
            start = np.repeat(begin, size)
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            at = start + inside
            run = inside // width
            right = (run & 1).astype(bool)
            low = np.minimum((run ^ 1) * width, np.repeat(size, size))
            high = np.minimum(low + width, np.repeat(size, size))
            first = low.copy()
            own = places[at]
            live = np.flatnonzero(low < high)
            while len(live):
                middle = (low[live] + high[live]) >> 1
                ahead = self.before(places[start[live] + middle], own[live], right[live])
                low[live] = np.where(ahead, middle + 1, low[live])
                high[live] = np.where(ahead, high[live], middle)
                live = live[low[live] < high[live]]
            target = start + (run & ~1) * width + inside % width + low - first
            places[target] = own
            width *= 2
        return places

    def repeated(self, places: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether a sorted suffix extends its neighbour of the same group over ``width`` bytes, byte by byte."""
        mark = np.zeros(len(places), bool)
        next_too = np.flatnonzero(group[1:] == group[:-1])
        next_too = next_too[self.common(places[next_too], places[next_too + 1]) == self.width]
        for at in range(0, len(next_too), 4096):
            i = next_too[at : at + 4096]
            i = i[(self.windows[places[i]] == self.windows[places[i + 1]]).all(axis=1)]
            mark[i] = mark[i + 1] = True
        return mark


def repeated_windows(keys: np.ndarray, leads: np.ndarray, spans: np.ndarray, parts: list[bytes], width: int) -> list:
    """For fragments sorted by key: per fragment the windows that another fragment of the key has too."""
    buffer = np.frombuffer(b"".join(parts), np.uint8)
    offset = np.cumsum([0, *(len(p) for p in parts)])[:-1]
    owner = np.repeat(np.arange(len(parts)), spans)
    window = np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans)
    key = np.unique(keys, return_inverse=True)[1].astype(np.int64)
    # Equal windows stand at the same distance from the anchor.
    group = key[owner] << np.int64(32) | (window - leads[owner] + (1 << 31))
    order = np.argsort(group, kind="stable")
    group = group[order]
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(begin, len(group)))
    suffixes = Suffixes(buffer, width)
    item = np.full(len(buffer) + 1, -1, np.int64)
    item[offset[owner] + window] = np.arange(len(owner))
    places = suffixes.mergesort((offset[owner] + window)[order], begin, size)
    hit = item[places[suffixes.repeated(places, group)]]
    found = np.zeros(len(owner), bool)
    found[hit] = True
    ends = np.cumsum(spans)
    return [np.flatnonzero(found[e - s : e]) for s, e in zip(spans, ends)]


def _runs(windows: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Windows in order as runs of bytes."""
    if not len(windows):
        return []
    cut = np.flatnonzero(np.diff(windows) > 1)
    begin = windows[np.append(0, cut + 1)]
    end = windows[np.append(cut, len(windows) - 1)] + width
    return list(zip(begin.tolist(), end.tolist()))


def _all_fragments(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """``doc, first, lead, span, key, frag, check`` of every fragment of ``doc, text``."""
    names = ["doc", "first", "lead", "span", "key", "frag", "check"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, buffer, offsets in pieces(batch, piece_bytes=BATCH_BYTES):
                f = fragments(buffer, offsets, width, gram)
                doc = batch.column("doc").take(pa.array(at + f["row"]))
                lead = f["anchor"] - f["first"]
                numbers = [f["first"] - offsets[f["row"]], lead, f["span"], f["key"], f["frag"], f["check"]]
                yield pa.RecordBatch.from_arrays([doc, *(pa.array(x, pa.int64()) for x in numbers)], names)

    return texts.mapInArrow(run, "doc binary, first long, lead long, span long, key long, frag long, check long")


def _cut(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The wanted fragments with their bytes, from one text of each document."""
    fields = F.struct("first", "lead", "span", "key", "frag", "check", "n", "m")
    lists = wanted.groupBy("doc").agg(F.collect_list(fields).alias("parts"))
    chosen = texts.join(broadcast_if_small(lists.select("doc")), "doc").dropDuplicates(["doc"])
    rows = chosen.join(lists, "doc").select("doc", F.col("text").cast("binary").alias("text"), F.explode("parts").alias("p"))
    piece = F.substring("text", (F.col("p.first") + 1).cast("int"), (F.col("p.span") - 1 + width).cast("int"))
    return rows.select("doc", "p.*", piece.alias("bytes"))


def _sorted_marks(cuts: DataFrame, width: int) -> DataFrame:
    """Repeated byte runs ``doc, begin, end`` of single fragments, from the suffix sort of each key."""
    names = ["key", "frag", "check", "doc", "first", "lead", "span", "n", "bytes"]
    dealt = cuts.select(*names).repartition("key").sortWithinPartitions("key", "frag", "check")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= BATCH_BYTES and held[-1]["key"] != row["key"]:
                    yield marks(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield marks(held)

    def marks(held: list[dict]) -> pa.RecordBatch:
        numbers = [np.array([r[c] for r in held], np.int64) for c in ("key", "lead", "span")]
        found = repeated_windows(*numbers, [r["bytes"] for r in held], width)
        rows = [
            (r["doc"], r["first"] + begin, r["first"] + end)
            for r, windows in zip(held, found)
            if r["n"] == 1
            for begin, end in _runs(windows, width)
        ]
        kinds = (pa.binary(), pa.int64(), pa.int64())
        columns = [pa.array([x[i] for x in rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, ["doc", "begin", "end"])

    return dealt.mapInArrow(run, "doc binary, begin long, end long")


def _counted_marks(cuts: DataFrame, width: int) -> DataFrame:
    """The same for keys with very many fragments: windows meet by two hashes of their bytes."""
    schema = "h long, g long, doc binary, begin long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, buffer, offsets in pieces(batch, "bytes", BATCH_BYTES):
                spans = np.diff(offsets) - width + 1
                owner = np.repeat(np.arange(len(spans)), spans)
                window = np.arange(len(owner)) - np.repeat(np.cumsum(spans) - spans, spans)
                begin = offsets[owner] + window
                hashes = [
                    stretch_hashes(prefix_hashes(buffer, other), begin, begin + width).view(np.int64)
                    for other in (False, True)
                ]
                row = pa.array(at + owner)
                first = batch.column("first").to_numpy()[at + owner] + window
                columns = [*map(pa.array, hashes), batch.column("doc").take(row), pa.array(first), batch.column("n").take(row)]
                yield pa.RecordBatch.from_arrays(columns, ["h", "g", "doc", "begin", "n"])

    windows = cuts.select("doc", "first", "n", "bytes").mapInArrow(run, schema)
    twice = windows.groupBy("h", "g").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    met = windows.filter("n = 1").join(twice, ["h", "g"])
    return met.select("doc", "begin", (F.col("begin") + width).alias("end"))


def repeat_marks(
    texts: DataFrame, width: int = WIDTH, gram: int = GRAM, most_fragments: int = MOST_FRAGMENTS
) -> DataFrame:
    """``doc, begin, end``: runs of bytes of ``doc, text`` that are covered by repeated windows.

    ``doc`` is a digest of the text; rows with equal texts count as often as they stand there.
    """
    every = settle(_all_fragments(texts, width, gram), "fragments")
    # Counts are written before they are joined, so that the join's partitions of hot keys can be split.
    keys = settle(every.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").drop("c"), "keys")
    shared = settle(every.join(keys, "key"), "shared")
    place = F.struct("doc", "first", "lead", "span")
    kinds = shared.groupBy("key", "frag", "check").agg(F.count("*").alias("n"), F.min(place).alias("place"))
    kinds = settle(kinds, "kinds")
    variants = settle(kinds.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "variants")
    open_ = settle(kinds.join(variants, "key").select("key", "frag", "check", "n", "m", "place.*"), "open")
    cuts = settle(_cut(texts, open_, width), "cuts")
    twice = kinds.filter("n > 1").select("key", "frag", "check")
    end = F.col("first") + F.col("span") - 1 + width
    equal = shared.join(twice, ["key", "frag", "check"]).select("doc", F.col("first").alias("begin"), end.alias("end"))
    sorted_ = _sorted_marks(cuts.filter(F.col("m") <= most_fragments), width)
    counted = _counted_marks(cuts.filter(F.col("m") > most_fragments), width)
    return equal.distinct().unionByName(sorted_).unionByName(counted)


def without_repeats(
    documents: DataFrame, width: int = WIDTH, gram: int = GRAM, most_fragments: int = MOST_FRAGMENTS
) -> DataFrame:
    """Every row with ``repeats``: a struct of the bytes kept and what was removed.

    Fields: ``kept`` (binary), ``n_bytes``, ``n_removed``, ``n_spans`` and ``spans`` (begin and end of
    each maximal removed run, in bytes).  A null text counts as empty.  A column ``repeats`` is
    replaced; ``_doc``, ``_text`` and ``_marks`` are reserved.
    """
    filled = whole("text")
    texts = documents.select(text_key(filled).alias("doc"), filled.alias("text"))
    marks = repeat_marks(texts.filter(F.octet_length("text") >= width), width, gram, most_fragments)
    lists = marks.groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("_marks"))
    lists = settle(lists.withColumnRenamed("doc", "_doc"), "marks")
    rows = documents.drop("repeats").withColumns({"_doc": text_key(filled), "_text": filled.cast("binary")})
    joined = rows.join(lists, "_doc", "left")
    kind = "struct<kept:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint,spans:array<struct<begin:bigint,end:bigint>>>"

    @F.pandas_udf(kind)
    def cut(texts: pd.Series, marks: pd.Series) -> pd.DataFrame:
        rows = [_removed(text, found) for text, found in zip(texts, marks)]
        return pd.DataFrame(rows, columns=["kept", "n_bytes", "n_removed", "n_spans", "spans"])

    return joined.withColumn("repeats", cut("_text", "_marks")).drop("_doc", "_text", "_marks")


def _removed(text: bytes, marks) -> tuple:
    if marks is None or not len(marks):
        return text, len(text), 0, 0, []
    spans: list[list[int]] = []
    for begin, end in sorted((m["begin"], m["end"]) for m in marks):
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([begin, end])
    edges = [0, *(x for span in spans for x in span), len(text)]
    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
    named = [{"begin": a, "end": b} for a, b in spans]
    return kept, len(text), len(text) - len(kept), len(spans), named


def document_repeats(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    r = F.col("repeats")
    rows = without_repeats(documents.select("doc_id", "text"))
    return rows.select(
        "doc_id", r["n_bytes"].alias("n_bytes"), r["n_removed"].alias("n_removed"), r["n_spans"].alias("n_spans"),
        F.sha2(r["kept"], 256).alias("kept_sha256"),
    )

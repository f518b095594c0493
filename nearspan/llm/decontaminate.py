"""Benchmark passages in documents, by q-gram lemma filtering and banded alignment.

A document holds an item if any stretch of ``STRETCH`` characters of the item, at any offset, stands
in its text within the edit budget; an item with fewer characters is one stretch.  A stretch of ``n``
characters that stands in a text with at most ``k`` edits shares at least ``n + 1 - q * (k + 1)``
q-grams with it, all within ``k + 1`` neighbouring diagonals.  So the shared q-grams of an item are
collected in diagonal bands that overlap by half; wherever enough of them lie within the length of a
stretch is a region, and every stretch that a region allows is verified by aligning it inside the
band.  Verbatim stretches show as runs on one diagonal and are compared directly.  Nothing is
estimated: a stretch within its edit budget is found.

Items of fewer than ``SHORTEST`` characters are found as they are, between word borders.

Characters are code points; A-Z are lower-cased, every ASCII blank counts as a space, and blanks at
the ends of an item don't count.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from nearspan.llm.bytesets import mix, pieces, powers

Q = 12
STRETCH = 80
SHORTEST = 20
ERROR_PERCENT = 6
BLOCK_CHARS = 4_000_000
ALIGNED = 2048
_CODES = np.random.default_rng(6).integers(1, 1 << 63, 1 << 16, dtype=np.uint64)


def code_points(text: bytes) -> np.ndarray:
    """Folded code points of UTF-8 bytes."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)
    return np.where((codes >= 9) & (codes <= 13), np.uint32(32), codes)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at every place that has one."""
    if len(codes) < Q:
        return np.zeros(0, np.uint64)
    up, down = powers(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_CODES[codes & np.uint32(0xFFFF)] * up[: len(codes)], out=sums[1:])
    return mix((sums[Q:] - sums[:-Q]) * down[: len(codes) - Q + 1])


class Items:
    """A block of items with an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        ids, codes = [], []
        short: dict[str, list] = {}
        for item, text in items:
            folded = code_points((text or "").encode("utf-8", "replace"))
            letters = np.flatnonzero(folded != 32)
            if not len(letters):
                continue
            folded = folded[letters[0] : letters[-1] + 1]
            if len(folded) < SHORTEST:
                short.setdefault(_as_text(folded), []).append(item)
            else:
                ids.append(item)
                codes.append(folded)
        self.words = ahocorasick.Automaton() if short else None
        self.ids = ids
        for text, owners in short.items():
            self.words.add_word(text, (len(text), range(len(ids), len(ids) + len(owners))))
            ids.extend(owners)
        if short:
            self.words.make_automaton()
        self.flat = np.concatenate([*codes, np.zeros(0, np.uint32)])
        self.start = np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int64)
        self.stretch = np.minimum(np.diff(self.start), STRETCH)
        self.budget = np.minimum(self.stretch * ERROR_PERCENT // 100, self.stretch // Q - 1)
        self.needed = self.stretch + 1 - Q * (self.budget + 1)
        grams = [gram_hashes(c) for c in codes]
        counts = [len(g) for g in grams]
        hashes = np.concatenate([*grams, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(grams)), counts)
        place = np.concatenate([*(np.arange(c) for c in counts), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.grams, self.first = np.unique(hashes[order], return_index=True)
        self.first = np.append(self.first, len(hashes))
        self.bits = max(16, int(16 * len(self.grams)).bit_length())
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[self.grams >> np.uint64(64 - self.bits)] = True
        self.step = int(self.budget.max(initial=0)) + 1

    def hits(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, place in the item and place in the joined texts of every shared q-gram."""
        hashes = gram_hashes(codes)
        spots = np.flatnonzero(self.filter[hashes >> np.uint64(64 - self.bits)])
        rank = np.searchsorted(self.grams, hashes[spots])
        rank = np.minimum(rank, max(len(self.grams) - 1, 0))
        known = self.grams[rank] == hashes[spots]
        inside = np.searchsorted(offsets, spots, "right") == np.searchsorted(offsets, spots + Q - 1, "right")
        spots, rank = spots[known & inside], rank[known & inside]
        counts = self.first[rank + 1] - self.first[rank]
        entry = _ranges(self.first[rank], counts)
        return self.owner[entry], self.place[entry], np.repeat(spots, counts)

    def verbatim(self, codes, item, place, spot) -> Iterator[tuple[int, int, int]]:
        """``item, begin, end`` in the joined texts of the runs on one diagonal that have a whole stretch."""
        order = np.lexsort((spot, spot - place, item))
        item, place, spot = item[order], place[order], spot[order]
        goes_on = (np.diff(item) == 0) & (np.diff(spot) == 1) & (np.diff(place) == 1)
        heads = np.flatnonzero(np.concatenate([[True], ~goes_on])) if len(item) else np.zeros(0, np.int64)
        length = np.diff(np.append(heads, len(item))) + Q - 1
        for at, n in zip(heads[length >= self.stretch[item[heads]]], length[length >= self.stretch[item[heads]]]):
            here = self.start[item[at]] + place[at]
            if (self.flat[here : here + n] == codes[spot[at] : spot[at] + n]).all():
                yield int(item[at]), int(spot[at]), int(spot[at] + n)

    def regions(self, text, item, place, spot) -> tuple[np.ndarray, ...]:
        """``text, item, band, offset`` of the stretches that share enough q-grams with a band of a text."""
        band = (spot - place) // self.step
        text, item, place = (np.concatenate([x, x]) for x in (text, item, place))
        band = np.concatenate([band, band - 1])
        order = np.lexsort((place, band, item, text))
        text, item, band, place = text[order], item[order], band[order], place[order]
        new = (np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(band) != 0)
        group = np.concatenate([[0], np.cumsum(new)])[: len(text)]
        last = np.arange(len(text)) + self.needed[item] - 1
        at = np.flatnonzero(last < len(text))
        last = last[at]
        span = self.stretch[item[at]] - Q
        dense = (group[last] == group[at]) & (place[last] - place[at] <= span)
        at, last, span = at[dense], last[dense], span[dense]
        low = np.maximum(place[last] - span, 0)
        high = np.minimum(place[at], np.diff(self.start)[item[at]] - self.stretch[item[at]])
        # Both ends grow inside a group, so what the one before covers is left out.
        same = np.concatenate([[False], group[at][1:] == group[at][:-1]])[: len(at)]
        before = np.concatenate([[-1], high[:-1]])[: len(at)]
        low = np.where(same, np.maximum(low, before + 1), low)
        counts = np.maximum(high - low + 1, 0)
        return *(np.repeat(x[at], counts) for x in (text, item, band)), _ranges(low, counts)

    def align(self, codes, offsets, text, item, band, offset) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and edits of the best place of each stretch in its text, on the band's diagonals
        and ``step`` more on either side; edits -1 without a place.

        A state is the edits in its high bits and the begin of the place in its low ones, so that the
        least state has the fewest edits and then the earliest begin.
        """
        width = 4 * self.step
        n = self.stretch[item]
        # Row i, column j: i letters of the stretch are used up to the place base + i + j of the texts.
        base = band * self.step + offset - self.step
        columns = np.arange(width + 1)
        begin, end = offsets[text][:, None], offsets[text + 1][:, None]
        cost = np.int64(1) << np.int64(40)
        away = np.int64(1) << np.int64(60)
        place = base[:, None] + columns
        state = np.where((place >= begin) & (place <= end), place, away)
        best = np.full_like(state, away)
        first = self.start[item] + offset
        for i in range(int(n.max(initial=0))):
            place = base[:, None] + i + columns
            inside = (place >= begin) & (place < end)
            letters = codes[np.clip(place, 0, len(codes) - 1)]
            pattern = self.flat[np.minimum(first + i, len(self.flat) - 1)][:, None]
            match = state + np.where(letters == pattern, 0, cost)
            match = np.where(inside, match, away)
            skip = np.full_like(state, away)
            skip[:, :-1] = state[:, 1:] + cost
            here = np.minimum(match, skip)
            here = np.minimum.accumulate(here - columns * cost, axis=1) + columns * cost
            valid = (place + 1 >= begin) & (place + 1 <= end)
            state = np.where(valid, np.minimum(here, away), away)
            best = np.where((n == i + 1)[:, None], state, best)
        at = best.argmin(axis=1)
        value = best[np.arange(len(at)), at]
        edits = np.where(value >= away >> 1, -1, value >> np.int64(40))
        return value & (cost - 1), base + n + at, edits

    def whole_words(self, codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """``text, item, begin, end`` of the short items that stand between word borders."""
        for text in range(len(offsets) - 1 if self.words else 0):
            letters = _as_text(codes[offsets[text] : offsets[text + 1]])
            for last, (length, owners) in self.words.iter(letters):
                begin, end = last + 1 - length, last + 1
                if not _inside_word(letters, begin) and not _inside_word(letters, end):
                    for item in owners:
                        yield text, item, begin, end

    def search(self, codes: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """``(text, item): [begin, end, edits]`` of the items found, by their number in ``ids``: first to
        last place with the fewest edits."""
        found: dict[tuple[int, int], list[int]] = {}

        def add(text: int, item: int, begin: int, end: int, edits: int) -> None:
            old = found.get((text, item))
            if old is None or edits < old[2]:
                found[text, item] = [begin, end, edits]
            elif edits == old[2]:
                old[:2] = min(old[0], begin), max(old[1], end)

        for text, item, begin, end in self.whole_words(codes, offsets):
            add(text, item, begin, end, 0)
        if not len(self.stretch) or len(codes) < Q:
            return found
        item, place, spot = self.hits(codes, offsets)
        text = np.searchsorted(offsets, spot, "right") - 1
        pair = text * len(self.stretch) + item
        plain = set()
        for i, begin, end in self.verbatim(codes, item, place, spot):
            t = int(np.searchsorted(offsets, begin, "right")) - 1
            plain.add(t * len(self.stretch) + i)
            add(t, i, begin - int(offsets[t]), end - int(offsets[t]), 0)
        rest = ~np.isin(pair, np.fromiter(plain, np.int64, len(plain)))
        stretches = self.regions(text[rest], item[rest], place[rest], spot[rest])
        for at in range(0, len(stretches[0]), ALIGNED):
            text, item, band, offset = (x[at : at + ALIGNED] for x in stretches)
            begin, end, edits = self.align(codes, offsets, text, item, band, offset)
            for i in np.flatnonzero((edits >= 0) & (edits <= self.budget[item])):
                home = int(offsets[text[i]])
                add(int(text[i]), int(item[i]), int(begin[i]) - home, int(end[i]) - home, int(edits[i]))
        return found


def _ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts`` numbers in a row from every first one on."""
    return np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def _as_text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "replace")


def _inside_word(text: str, at: int) -> bool:
    """Whether the place lies between two letters or digits of a script that puts blanks between words."""
    return 0 < at < len(text) and all(c.isalnum() and c < "\u2e80" for c in text[at - 1 : at + 1])


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[Items]:
    """The items in blocks of about ``block_chars`` characters; only one block is held at a time."""
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    parts = -(-total // block_chars)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(parts, 1)))
    for i in range(parts):
        yield Items([tuple(row) for row in items.filter(part == i).collect()])


def _found(batch: pa.RecordBatch, items: Items, column: str) -> Iterator[tuple[int, int, list[int]]]:
    for first, _, buffer, offsets in pieces(batch, column):
        starts = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])[offsets]
        codes = code_points(buffer.tobytes())
        if len(codes) != starts[-1]:  # bytes that are not UTF-8
            parts = [code_points(buffer[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            codes = np.concatenate(parts)
        for (text, item), place in items.search(codes, starts).items():
            yield first + text, items.ids[item], place


def passages(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, begin, end, edits``: an item that stands in a document, with its fewest edits.

    ``begin`` and ``end`` are the first and last place of the stretches with so few edits, in code points
    of the text; of a verbatim passage all of it counts.  Null, empty and blank texts and items hold and
    are nothing; texts of any length are searched whole.  Repeated documents
    give repeated rows, repeated items (same id and text) count once.  Further columns are not read.
    """
    spark = documents.sparkSession
    kind = f"{documents.schema['doc_id'].dataType.simpleString()}"
    item_kind = benchmark.schema["item_id"].dataType
    schema = f"doc_id {kind}, item_id {item_kind.simpleString()}, begin long, end long, edits long"
    texts = documents.select("doc_id", "text")
    result = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = list(_found(batch, shared.value, "text"))
                ids = batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64()))
                places = [pa.array([h[2][i] for h in hits], pa.int64()) for i in range(3)]
                items = pa.array([h[1] for h in hits], to_arrow_type(item_kind))
                yield pa.RecordBatch.from_arrays([ids, items, *places], ["doc_id", "item_id", "begin", "end", "edits"])

        result = result.unionByName(texts.mapInArrow(run, schema))
    return result


def clean_documents(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents, with all their columns, in which no item is found; null, empty and blank texts stay."""
    spark, names = documents.sparkSession, documents.columns
    # Tasks know the columns by place, since names may hold dots.
    text = f"c{names.index('text')}"
    documents = documents.toDF(*(f"c{i}" for i in range(len(names))))
    for block in _blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[row for row, _, _ in _found(batch, shared.value, text)]] = False
                yield batch.filter(pa.array(clean))

        documents = documents.mapInArrow(run, documents.schema)
    return documents.toDF(*names)

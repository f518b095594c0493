"""Periodic runs in texts: stretches of words that repeat with one period.

A run is a stretch of consecutive words whose smallest period ``q`` (words ``q`` apart are equal) fits it at least
``least_periods`` times, that has at least ``least_words`` words, and that no neighbouring word extends with period
``q``.

*Splitting.* Each word of a run stands in it at least ``least_periods`` times.  A word that is rarer than that within
its segment therefore lies in no run of the segment and splits it.  Counts within the parts are lower, so the parts
are split again, until no segment has a rare word; parts shorter than a run are dropped.

*Lag scan.* In what is left, a run of period ``q`` shows as a row of neighbouring places each of which repeats its
next ``k >= q`` words exactly ``q`` words after they began last: a nearer repetition would, by the theorem of Fine and
Wilf, give the run a smaller period.  Lags of up to ``k`` are scanned for ``k`` doubling, so a segment of ``m`` words
takes ``log m`` scans and not one scan per lag.  Words are compared by codes of their exact bytes, not by hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nearspan.llm.bytesets import pieces, words
from nearspan.llm.common import whole

RESULT = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def word_codes(buffer: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number per word, equal for equal bytes only."""
    steps = np.zeros(len(buffer) + 1, np.int8)
    steps[begin] += 1
    steps[end] -= 1
    packed = buffer[np.cumsum(steps[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    values = pa.Array.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(packed)]
    )
    return values.dictionary_encode().indices.to_numpy().astype(np.int64)


def ranks(*keys: np.ndarray) -> np.ndarray:
    """Dense numbers from 0 of the combinations of the keys."""
    out = np.unique(keys[0], return_inverse=True)[1].astype(np.int64)
    for key in keys[1:]:
        dense = np.unique(key, return_inverse=True)[1].astype(np.int64)
        out = np.unique(out * (dense.max(initial=0) + 1) + dense, return_inverse=True)[1].astype(np.int64)
    return out


def _places(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the segments, and the segment of each."""
    size = end - begin
    segment = np.repeat(np.arange(len(begin)), size)
    return np.arange(size.sum()) - (np.cumsum(size) - size)[segment] + begin[segment], segment


def split_by_frequency(
    codes: np.ndarray, begin: np.ndarray, end: np.ndarray, least_words: int, least_periods: int
) -> tuple[np.ndarray, np.ndarray]:
    """Segments in which every word stands ``least_periods`` times at least, in order."""
    long = end - begin >= least_words
    begin, end = begin[long], end[long]
    done_begin, done_end = [], []
    while len(begin):
        at, segment = _places(begin, end)
        which = ranks(segment, codes[at])
        kept = np.bincount(which)[which] >= least_periods
        broken = np.bincount(segment, ~kept, len(begin)) > 0
        done_begin.append(begin[~broken])
        done_end.append(end[~broken])
        here = kept & broken[segment]
        at, segment = at[here], segment[here]
        # A part begins where the place before it is not kept or belongs to another segment.
        edge = np.flatnonzero((np.diff(at) != 1) | (np.diff(segment) != 0)) + 1
        first, last = np.r_[0, edge], np.r_[edge, len(at)]
        long = last - first >= least_words
        begin, end = at[first[long]], at[last[long] - 1] + 1
    begin, end = np.concatenate([*done_begin, begin]), np.concatenate([*done_end, end])
    order = np.argsort(begin, kind="stable")
    return begin[order], end[order]


def lag_scan(
    codes: np.ndarray, begin: np.ndarray, end: np.ndarray, least_words: int, least_periods: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs inside the segments: begin, length, period, by begin and then period."""
    found = []
    width, low = max(1, 2 * least_words // 3), 0
    while True:
        # Only segments that can hold a run with a period above ``low`` are scanned on.
        long = end - begin >= max(least_words, least_periods * (low + 1))
        begin, end = begin[long], end[long]
        if not len(begin):
            break
        at, segment = _places(begin, end)
        stop = (np.cumsum(end - begin))[segment]
        gram = _grams(ranks(segment, codes[at]), stop, width)
        place = np.flatnonzero(np.arange(len(at)) + width <= stop)
        order = place[np.argsort(gram[place], kind="stable")]
        again = np.flatnonzero(gram[order[1:]] == gram[order[:-1]])
        here, lag = order[again + 1], order[again + 1] - order[again]
        near = (lag > low) & (lag <= width)
        here, lag = here[near], lag[near]
        turn = np.argsort(here, kind="stable")
        here, lag = here[turn], lag[turn]
        edge = np.flatnonzero((np.diff(here) != 1) | (np.diff(lag) != 0)) + 1
        first, last = np.r_[0, edge][: len(here)], np.r_[edge, len(here)][: len(here)] - 1
        period = lag[first]
        length = here[last] - here[first] + width + period
        enough = length >= np.maximum(least_words, least_periods * period)
        found.append((at[here[first[enough]] - period[enough]], length[enough], period[enough]))
        low, width = width, 2 * width
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(part) for part in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _grams(code: np.ndarray, stop: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the ``width`` codes from each place on; those that pass the end of their segment are not used."""
    size = 1
    while 2 * size <= width:
        code, size = _joined(code, stop, size, 2 * size), 2 * size
    return code if size == width else _joined(code, stop, width - size, width)


def _joined(code: np.ndarray, stop: np.ndarray, shift: int, width: int) -> np.ndarray:
    inside = np.flatnonzero(np.arange(len(code)) + width <= stop)
    out = np.zeros(len(code), np.int64)
    out[inside] = ranks(code[inside], code[inside + shift])
    return out


def _collapsed(
    buffer: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, kept: np.ndarray
) -> pa.Array:
    """The kept words of each row joined by one space."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[kept]
    begin, end = begin[kept], end[kept]
    followed = np.flatnonzero(row[1:] == row[:-1])
    steps = np.zeros(len(buffer) + 1, np.int8)
    steps[begin] += 1
    steps[end] -= 1
    taken = np.cumsum(steps[:-1], dtype=np.int8).astype(bool)
    # A word that another one follows in its text ends before a blank.
    taken[end[followed]] = True
    text = buffer.copy()
    text[end[followed]] = 32
    size = np.bincount(row, end - begin, len(first) - 1) + np.bincount(row[:-1][followed], minlength=len(first) - 1)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.string(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text[taken])]
    )


def periodic_runs(docs: DataFrame, least_words: int = 24, least_periods: int = 3, key: str = "doc_id") -> DataFrame:
    """Runs of every text and the text without their repetitions: ``(key, n_words, runs, collapsed)``.

    ``runs`` holds ``(start, length, period)`` in words, by start and then period; ``collapsed`` is the words, joined
    by one space, without those that a run contains after its first ``period`` words.

    A null text counts as empty: no words, no runs, an empty collapsed text.  A text with fewer than ``least_words``
    words has no runs.  Long texts are taken whole, each by itself, in memory in proportion to their length.
    Repeated rows, and rows with equal or null keys, are each answered by a row of their own.  Runs may overlap;
    those with the same words but another period cannot occur.  Only ``key`` and ``text`` are read, so other columns
    may have any name.  An empty table gives an empty result.
    """
    if least_periods < 3 or least_words < 2:
        raise ValueError("runs have at least 3 periods and 2 words")
    rows = docs.select(F.col(key).alias("key"), whole("text").alias("text"))
    schema = T.StructType([rows.schema["key"], *T.StructType.fromDDL(RESULT)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n, buffer, offsets in pieces(batch):
                begin, end, first = words(buffer, offsets)
                codes = word_codes(buffer, begin, end)
                left, right = split_by_frequency(codes, first[:-1], first[1:], least_words, least_periods)
                start, length, period = lag_scan(codes, left, right, least_words, least_periods)
                covered = np.zeros(len(begin) + 1, np.int64)
                np.add.at(covered, start + period, 1)
                np.add.at(covered, start + length, -1)
                kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
                row = np.searchsorted(first, start, side="right") - 1
                runs = pa.ListArray.from_arrays(
                    np.searchsorted(row, np.arange(n + 1)).astype(np.int32),
                    pa.StructArray.from_arrays([start - first[row], length, period], ["start", "length", "period"]),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").slice(at, n),
                        pa.array(np.diff(first)),
                        runs,
                        _collapsed(buffer, begin, end, first, kept),
                    ],
                    names=["key", "n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(scan, schema).withColumnRenamed("key", key)

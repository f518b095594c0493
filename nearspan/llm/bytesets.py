"""Array helpers that run inside tasks: texts as one byte buffer, rolling hashes, words.

Hashes are polynomials modulo 2**64 over a random table of byte values, followed by a mixer.  Prefix
sums give the hash of any stretch in constant time.  Equal stretches have equal hashes; where a
result must not rest on 64 bits, the caller compares the bytes or a second hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LETTERS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_OTHER_LETTERS = np.random.default_rng(20000229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i up to n; grown on demand."""
    global _powers, _inverses
    if len(_powers) <= n:
        size = 1 << int(n).bit_length()
        _powers = np.full(size, _BASE)
        _inverses = np.full(size, _INVERSE)
        _powers[0] = _inverses[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
        np.multiply.accumulate(_inverses, out=_inverses)
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def prefix_hashes(buffer: np.ndarray, other: bool = False) -> np.ndarray:
    """``S`` with ``(S[e] - S[s]) * base**-s`` the hash of ``buffer[s:e]``; ``other`` gives a second, independent hash."""
    up, _ = powers(len(buffer))
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum((_OTHER_LETTERS if other else _LETTERS)[buffer] * up[: len(buffer)], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the stretches; the length takes part."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[begin]) * down[begin] ^ (end - begin).astype(np.uint64) * _BASE)


def pieces(batch: pa.RecordBatch, column: str = "text", piece_bytes: int = PIECE_BYTES) -> Iterator[tuple]:
    """Cuts a batch between rows: ``(first row, rows, byte buffer, offsets)``, about ``piece_bytes`` each.

    A row is never cut, so a longer text makes a piece of its own.  Null is taken as empty.
    """
    values = batch.column(column)
    values = values.cast(pa.large_binary() if pa.types.is_binary(values.type) else pa.large_string())
    if values.null_count:
        values = values.fill_null(b"" if pa.types.is_large_binary(values.type) else "")
    if not len(values):
        return
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    buffer = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(values):
        to = int(np.searchsorted(offsets, offsets[at] + piece_bytes, side="right")) - 1
        to = min(max(to, at + 1), len(values))
        yield at, to - at, buffer[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def lower(buffer: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes stay."""
    return np.where((buffer >= 65) & (buffer <= 90), buffer + np.uint8(32), buffer)


def words(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between space and ASCII control blanks: begins, ends, and per row the index of its first word."""
    n = len(buffer)
    inside = np.ones(n + 1, bool)
    inside[:n] = ~((buffer == 32) | ((buffer >= 9) & (buffer <= 13)))
    inside[n] = False
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:-1]
    begin = np.flatnonzero(inside & (~before | edge))
    end = np.flatnonzero(before & (~inside | edge))
    return begin, end, np.searchsorted(begin, offsets)


def word_hashes(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, lower-cased, and per row the index of its first word."""
    begin, end, first = words(buffer, offsets)
    return stretch_hashes(prefix_hashes(lower(buffer)), begin, end), first


def run_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` items of a row, and per row the index of its first run.

    A row with fewer items, but at least one, gives its whole sequence as one run.
    """
    counts = np.diff(first)
    runs = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    where = np.concatenate([[0], np.cumsum(runs)])
    row = np.repeat(np.arange(len(counts)), runs)
    at = first[row] + np.arange(where[-1]) - where[row]
    length = np.minimum(counts, width)[row]
    out = np.zeros(len(at), np.uint64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for i in range(width):
        out = np.where(i < length, mix(out * _BASE + padded[at + i]), out)
    return out, where

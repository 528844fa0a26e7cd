"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

A word is a longest run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return. These six are single bytes in UTF-8, so cutting at bytes cuts as cutting at characters would.
Hashes are Rabin-Karp polynomials modulo 2**64: with prefix sums of byte * base**position, the hash of
any range is a difference, moved to position 0 by a power of the inverse base.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes handled together; bounds the memory of the arrays below (about 60 bytes for each).
SLICE_BYTES = 1 << 20

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below count; base is odd, so the inverse exists."""
    known = _powers.get(base)
    if known is None or len(known[0]) < count:
        size = 1 << max(12, count - 1).bit_length() if count > 1 else 4096
        tables = []
        for value in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, value, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        known = _powers[base] = (tables[0], tables[1])
    return known[0][:count], known[1][:count]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    """Running sums of values[i] * base**i, one longer than the values."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values))[0], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = powers(base, len(sums))[1]
    return (sums[ends] - sums[starts]) * inverse[starts]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow text or binary column and the offsets of its rows; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most `limit` bytes together, or single longer rows."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


@dataclass
class Words:
    """Words of some rows: byte ranges, hashes, and where each row's words begin (one entry more than rows)."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def _word_ranges(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = ~_IS_SPACE[data]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = breaks[(breaks > 0) & (breaks < len(data))]
    begins[cuts] |= inside[cuts]
    stops[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def _segments(data: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut at spaces, into pieces of about `limit` bytes; a longer word stays whole."""
    low = 0
    while low < len(data):
        high = min(low + limit, len(data))
        while high < len(data):
            ahead = np.flatnonzero(_IS_SPACE[data[high : high + limit]])
            if len(ahead):
                high += int(ahead[0])
                break
            high = min(high + limit, len(data))
        yield low, high
        low = high


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the rows whose bytes lie between consecutive offsets of `data`."""
    offsets = np.asarray(offsets, dtype=np.int64)
    parts = []
    # Many small rows fit one segment; a very long single row is cut at spaces.
    whole = len(offsets) > 2 or len(data) <= 2 * SLICE_BYTES
    for low, high in [(0, len(data))] if whole else _segments(data, SLICE_BYTES):
        piece = data[low:high]
        starts, ends = _word_ranges(piece, offsets - low)
        sums = prefix_sums(piece.astype(np.uint64) + np.uint64(1), _BYTE_BASE)
        hashes = mixed(range_hashes(sums, _BYTE_BASE, starts, ends) + (ends - starts).astype(np.uint64))
        parts.append((starts + low, ends + low, hashes))
    starts, ends, hashes = (np.concatenate(column) for column in zip(*parts, strict=True)) if parts else (
        np.zeros(0, np.int64),
        np.zeros(0, np.int64),
        np.zeros(0, np.uint64),
    )
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position in the row and hash of every window of `size` words that lies in one row."""
    count = len(words.starts) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lengths = np.diff(words.first)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.flatnonzero(row[:count] == row[size - 1 :])
    sums = prefix_sums(words.hashes, _WORD_BASE)
    return row[at], at - words.first[row[at]], mixed(range_hashes(sums, _WORD_BASE, at, at + size))


def covered(positions: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of `total` places lie in one of the windows that begin at `positions`."""
    steps = np.zeros(total + 1, dtype=np.int32)
    np.add.at(steps, positions, 1)
    np.add.at(steps, np.minimum(positions + size, total), -1)
    return np.cumsum(steps[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the longest runs of True."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

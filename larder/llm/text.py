"""Vectorised work on the UTF-8 bytes of Arrow string columns.

Words are maximal runs of bytes other than space and tab to carriage return.
Everything is taken from the bytes themselves, so no Python string is made for a
word, and a batch of short texts costs as much as one long text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Python works on slices of a batch, so its memory follows this and the longest text.
SLICE_BYTES = 2 << 20
WORD_POSITIONS = 1 << 12


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection, so it adds no collisions."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def inside(starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions of spans, one span after the other."""
    return np.arange(int(length.sum())) + np.repeat(starts - (np.cumsum(length) - length), length)


def odd_numbers(count: int, seed: int) -> np.ndarray:
    return mixed(np.arange(seed, seed + count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text, one row at least."""
    _, at = string_parts(batch.column(column))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(at, at[row] + limit, "right")) - 1
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[raw]


def word_bounds(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of words before it."""
    gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
    opens = np.empty(len(raw), bool)
    if len(raw):
        opens[0] = True
        opens[1:] = gap[:-1]
        opens[at[:-1][at[:-1] < len(raw)]] = True
        opens &= ~gap
    starts = np.flatnonzero(opens)
    closes = np.empty(len(raw), bool)
    if len(raw):
        closes[-1] = True
        closes[:-1] = gap[1:]
        inner = at[1:-1]
        closes[inner[inner > 0] - 1] = True
        closes &= ~gap
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the given disjoint, ordered spans."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    byte_value = odd_numbers(256, 1_000)
    place_value = odd_numbers(WORD_POSITIONS, 10_000)
    length = ends - starts
    total = int(length.sum())
    place = np.arange(total) - np.repeat(np.cumsum(length) - length, length)
    source = place + np.repeat(starts, length)
    terms = mixed(byte_value[raw[source]] + place_value[place % WORD_POSITIONS])
    # Places beyond the table are told apart by how often it was passed.
    far = np.flatnonzero(place >= WORD_POSITIONS)
    terms[far] = mixed(terms[far] + (place[far] // WORD_POSITIONS).astype(np.uint64))
    sums = np.add.reduceat(terms, np.cumsum(length) - length)
    return mixed(sums + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of ``size`` consecutive words, sorted; fewer words form one."""
    if not len(words):
        return words
    width = min(size, len(words))
    factor = odd_numbers(size, 50_000)
    count = len(words) - width + 1
    sums = np.full(count, width, np.uint64)
    for k in range(width):
        sums += words[k : k + count] * factor[k]
    return np.unique(mixed(sums))

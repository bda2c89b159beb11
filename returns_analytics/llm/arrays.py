"""Vectorised text helpers for Arrow batches: slices, words, hashes and sliding windows.

Texts are handled as UTF-8 bytes of many rows at once, so that the cost per row is small and the
memory is bounded by a slice (one row at least, whatever its length).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer row is a slice of its own.
SLICE_BYTES = 1 << 20

_ALL = (1 << 64) - 1
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, base, np.uint64))), dtype=np.uint64)


_POWERS = {_MULTIPLIER: _powers(_MULTIPLIER, SLICE_BYTES), _INVERSE: _powers(_INVERSE, SLICE_BYTES)}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n modulo 2 ** 64."""
    if len(_POWERS[base]) <= n:
        return _powers(base, n)
    return _POWERS[base]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.null_count == 0 else column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row (exclusive), bytes and row offsets (from 0) of consecutive slices."""
    data, offsets = column_bytes(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def table_of(characters: bytes) -> np.ndarray:
    """Truth table over bytes."""
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


#: Bytes that separate words: space, and tab to carriage return.
SPACES = table_of(b" \t\n\x0b\x0c\r")
#: Every ASCII byte that is neither letter nor digit; bytes of other characters belong to words.
PUNCTUATION = table_of(bytes(b for b in range(128) if not chr(b).isalnum()))
#: Lower case of A-Z, every other byte as it is.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; words never cross rows."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, the same for equal bytes anywhere."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * powers(_MULTIPLIER, n)[:n], out=sums[1:])
    spans = (sums[ends] - sums[starts]) * powers(_INVERSE, n)[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``size`` words; of a row with fewer words, of its whole sequence."""
    counts = np.bincount(rows, minlength=n_rows)
    begin = np.concatenate(([0], np.cumsum(counts)))
    short = np.flatnonzero((counts > 0) & (counts < size))
    at = np.arange(len(words))
    full = at + size <= begin[rows + 1] if len(words) else np.zeros(0, bool)
    at = at[full]
    values = np.zeros(len(at), np.uint64)
    for k in range(size):
        values = mix(values + words[at + k] + np.uint64(k + 1))
    less = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        more = counts[short] > k
        less[more] = mix(less[more] + words[begin[short[more]] + k] + np.uint64(k + 1))
    less = mix(less + np.uint64(size * 0x632BE59BD9B4E019 & _ALL))
    return np.concatenate((values, less)), np.concatenate((rows[at], short))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start .. start + length - 1 of each pair, one after another."""
    total = int(lengths.sum())
    out = np.ones(total, np.int64)
    full = lengths > 0
    starts, lengths = starts[full], lengths[full]
    if not total:
        return out
    begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    out[begin] = starts
    out[begin[1:]] -= starts[:-1] + lengths[:-1] - 1
    return np.cumsum(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, by block prefixes and suffixes."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % width
    blocks = np.concatenate((values, np.full(pad, np.iinfo(values.dtype).max, values.dtype))).reshape(-1, width)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[width - 1 : width - 1 + n])


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """Lists of the given lengths over consecutive values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), values)

"""Words and shingles of many texts at once, as 64-bit numbers.

The operators here look at the UTF-8 bytes of an Arrow column directly, some
megabytes at a time, so that no Python object is made for a word. Two different
words or shingles get the same number with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes that are looked at together
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
    if fold:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[list(SPACES)] = 0
    return values


_VALUES = {fold: _byte_values(fold) for fold in (True, False)}
_IN_WORD = _VALUES[True] != 0


_POWERS = [np.ones(1, np.uint64)]


def powers(n: int) -> np.ndarray:
    """At least ``n`` powers of the multiplier, from 1; up to PIECE of them are remembered."""
    if n <= len(_POWERS[0]):
        return _POWERS[0]
    steps = np.full(max(n, 256), _MULTIPLIER, dtype=np.uint64)
    steps[0] = 1
    found = np.multiply.accumulate(steps)
    if n <= PIECE:
        _POWERS[0] = found
    return found


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row begins; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def _hash_piece(
    data: np.ndarray, begins: np.ndarray, byte_values: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data``, where no word goes over a position in ``begins``."""
    inside = _IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = begins[begins < len(data)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    spans = np.diff(starts, append=len(data))
    within = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    values = byte_values[data[starts[0] :]] * powers(int(spans.max()))[within]
    return mix(np.add.reduceat(values, starts - starts[0])), starts


def _hash_word(data: np.ndarray, byte_values: np.ndarray) -> np.ndarray:
    """The hash of one word, as ``_hash_piece`` gives it, from PIECE of its bytes at a time."""
    total, factor, whole = 0, 1, 1 << 64
    for at in range(0, len(data), PIECE):
        values = byte_values[data[at : at + PIECE]]
        total += factor * int((values * powers(len(values))[: len(values)]).sum(dtype=np.uint64))
        factor = factor * pow(int(_MULTIPLIER), PIECE, whole) % whole
    return mix(np.array([total % whole], np.uint64))


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts the rows' bytes into pieces of about PIECE bytes, inside a row only at a space."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(at + PIECE, end)
        if stop < end:
            row_end = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            if row_end > at:
                stop = row_end
            else:  # one long row: go on to its next space or its end
                limit = int(offsets[np.searchsorted(offsets, at, "right")])
                while stop < limit and _IN_WORD[data[stop]]:
                    stop += 1
        yield at, stop
        at = stop


def word_hashes(column: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every row's words, and where each row's begin among them.

    Words are what stands between the bytes in SPACES; A-Z count as a-z if ``fold``.
    """
    data, offsets = string_bytes(column)
    hashes, places = [], []
    for at, stop in _pieces(data, offsets):
        long = stop
        if stop - at > 2 * PIECE:  # all of it in one row, and its last word is a long one
            spaces = np.flatnonzero(~_IN_WORD[data[at : at + PIECE]])
            long = at + int(spaces[-1]) + 1 if len(spaces) else at
        rows = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, long)]
        found, starts = _hash_piece(data[at:long], rows - at, _VALUES[fold])
        hashes.append(found)
        places.append(starts + at)
        if long < stop:
            hashes.append(_hash_word(data[long:stop], _VALUES[fold]))
            places.append(np.array([long]))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


def shingle_hashes(
    words: np.ndarray, bounds: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words; a shorter row's whole sequence is one shingle."""
    factors = mix(np.arange(11, 11 + size, dtype=np.uint64) * _MULTIPLIER) | np.uint64(1)
    counts = np.diff(bounds)
    many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(many)])
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    # Where a shingle begins: row by row, the first word on.
    starts = np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1] - bounds[:-1], many)
    total = np.zeros(len(starts), np.uint64)
    for i in range(size):
        total += padded[starts + i] * factors[i]
    lengths = np.arange(size, dtype=np.uint64) * _MULTIPLIER
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        n = int(counts[row])
        own = words[bounds[row] : bounds[row] + n] * factors[:n]
        total[out_bounds[row]] = own.sum(dtype=np.uint64) ^ lengths[n]
    return mix(total), out_bounds


def row_groups(batch: pa.RecordBatch, column: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes in ``column``; a longer row stands alone."""
    _, offsets = string_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        stop = min(max(stop, at + 1), batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop

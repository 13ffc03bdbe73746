"""Words of Arrow text columns as 64-bit hashes, in numpy, a bounded slice at a time.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased. Two different words share a hash
with a chance of about 2**-64, so sets, counts and joins on hashes stand for those on words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; longer texts are cut at white space.
SLICE = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240101))
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ODD = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _P_INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def _hashed(raw: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, starts and ends of a slice; ``firsts``: where its rows begin."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~_SPACE[raw]
    cut = np.ones(n + 1, bool)
    np.logical_not(solid, out=cut[1:])
    cut[firsts] = True
    starts = np.flatnonzero(solid & cut[:n])
    cut = np.ones(n + 1, bool)
    np.logical_not(solid, out=cut[:n])
    cut[firsts] = True
    ends = np.flatnonzero(solid & cut[1:]) + 1
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def word_slices(column) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Yield (first row, word offsets of its rows, word hashes, last three bytes of each word) by slices of rows."""
    data, offsets = text_buffer(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[stop])
        if stop == row + 1 and hi - lo > SLICE:
            hashes, tails = [], []
            while lo < hi:
                end = min(hi, lo + SLICE)
                while end < hi and not _SPACE[data[end]]:
                    end += 1
                h, starts, ends = _hashed(data[lo:end], np.zeros(1, np.int64))
                hashes.append(h)
                tails.append(_tail(data[lo:end], starts, ends))
                lo = end
            h, tail = np.concatenate(hashes), np.concatenate(tails)
            yield row, np.array([0, len(h)]), h, tail
        else:
            begins = offsets[row : stop + 1] - lo
            raw = data[lo:hi]
            h, starts, ends = _hashed(raw, begins)
            yield row, np.searchsorted(starts, begins, "left"), h, _tail(raw, starts, ends)
        row = stop


def _tail(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The last three bytes of each word as one number."""
    out = np.zeros(len(starts), np.uint32)
    for k in (1, 2, 3):
        at = ends - k
        out = out * np.uint32(256) + np.where(at >= starts, _LOWER[raw[np.maximum(at, 0)]], 0).astype(np.uint32)
    return out


def word_hash(text: str) -> list[int]:
    """The word hashes of one text, signed."""
    return [int(x) for _, _, h, _ in word_slices(pa.array([text], pa.string())) for x in h.view(np.int64)]


def shingle_sets(column, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Yield (row, sorted distinct hashes of runs of ``width`` words).

    A row of fewer words has its whole sequence as one shingle, a row without words has none.
    """
    for first, bounds, h, _ in word_slices(column):
        n = len(h)
        rolled = np.zeros(max(0, n - width + 1), np.uint64)
        for k in range(width):
            rolled += h[k : n - width + 1 + k] * _ODD[k] if n >= width else 0
        rolled = mix(rolled)
        for k in range(len(bounds) - 1):
            a, b = int(bounds[k]), int(bounds[k + 1])
            if b - a >= width:
                yield first + k, np.unique(rolled[a : b - width + 1])
            elif b > a:
                part = np.zeros(1, np.uint64)
                for j in range(a, b):
                    part += h[j : j + 1] * _ODD[j - a]
                yield first + k, mix(part + np.uint64(b - a))
            else:
                yield first + k, np.zeros(0, np.uint64)

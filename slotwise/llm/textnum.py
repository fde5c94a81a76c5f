"""Words of Arrow text columns as numpy arrays, a slice of rows at a time.

A slice holds about a megabyte of text (or one longer document), so memory stays bounded however
many rows an Arrow batch has.  Hashes depend only on bytes: every worker and attempt agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_RNG = np.random.default_rng(20260101)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = int(0x9E3779B97F4A7C15)
_P_INV = pow(_P, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _to_length(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, SLICE_BYTES * 2)
        for k, base in enumerate((_P, _P_INV)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over a text column; nulls are empty texts."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32, n + 1, column.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(ends, ends[row] + max_bytes, "right")) - 1
        stop = min(n, max(row + 1, stop))
        yield row, stop, data[ends[row]:ends[stop]], ends[row:stop + 1] - ends[row]
        row = stop


def word_hashes(buf: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and where each document's words begin (one more for the end)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if lower:
        buf = _LOWER[buf]
    gap = np.ones(n + 1, bool)
    gap[:n] = _SPACE[buf]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.ones(n, bool)
    before[1:] = gap[:n - 1]
    starts = np.flatnonzero(~gap[:n] & (before | cut[:n]))
    ends = np.flatnonzero(~gap[:n] & (gap[1:] | cut[1:])) + 1
    power, inverse = _to_length(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[buf] * power[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


def runs(buf: np.ndarray, offsets: np.ndarray, kept: np.ndarray, lower: bool = False) -> tuple[pa.StringArray, np.ndarray]:
    """The runs of bytes that ``kept`` (256 flags) allows as strings, and where each document's begin
    (one more for the end).  ``kept`` must hold all bytes above 127 or none of them."""
    starts = run_starts(buf, offsets, kept)
    inside = kept[buf]
    data = (_LOWER[buf] if lower else buf)[inside]
    places = np.zeros(len(starts) + 1, np.int32)
    places[:-1] = np.cumsum(inside)[starts] - 1
    places[-1] = len(data)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data))
    return words, np.searchsorted(starts, offsets)


def run_starts(buf: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Where runs of ``kept`` bytes begin; a run ends with its document."""
    inside = kept[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:len(buf)]
    return np.flatnonzero(first)


def combine(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``n`` consecutive hashes (order matters)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(hashes) - n + 1, seed + 0x51ED27, np.uint64)
    for i in range(n):
        out = (out + hashes[i:len(hashes) - n + 1 + i]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out

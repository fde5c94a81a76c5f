"""An FM-index over word sequences: Burrows-Wheeler transform in a wavelet matrix, backward search.

Suffixes are sorted by their first 16 symbols, which is all that patterns of up to 16 words need.
Bits are packed, with a running count every 64 of them, so the index takes about 1.5 bits per symbol
and level.  Searches run for many patterns at once.
"""

from __future__ import annotations

import numpy as np

DEPTH = 16


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.top = max(1, int(n_symbols - 1).bit_length())
        for level in range(self.top - 1, -1, -1):
            bit = (symbols >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.levels.append((packed, ones, int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` arrives on the lowest level, following each symbol's bits."""
        for depth, (packed, ones, zeros) in enumerate(self.levels):
            word = at >> 6
            below = packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            rank = ones[word] + np.bitwise_count(below)
            at = np.where((symbol >> (self.top - 1 - depth)) & 1, zeros + rank, at - rank)
        return at


class FMIndex:
    """text: symbols from 1, 0 ends each sequence."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        n = len(text)
        rank = text.astype(np.int64)
        ranks = [rank]
        for step in (1, 2, 4, 8):                       # ranks by the first 2, 4, 8, 16 symbols
            after = np.zeros(n, np.int64)
            after[:n - step] = rank[step:] + 1
            _, rank = np.unique(rank * (int(after.max()) + 1) + after, return_inverse=True)
            ranks.append(rank)
        self._eight = np.concatenate([ranks[3], np.full(DEPTH, -1)])
        self.suffixes = np.argsort(ranks[4], kind="stable")
        last = text[self.suffixes - 1]                  # before the first symbol stands the last
        self.bwt = WaveletMatrix(last.astype(np.int64), n_symbols)
        counts = np.bincount(text, minlength=n_symbols)
        smaller = np.concatenate([[0], np.cumsum(counts)[:-1]])
        symbols = np.arange(n_symbols)
        self.base = smaller - self.bwt.place(symbols, np.zeros(n_symbols, np.int64))
        self.size = n

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: from the rows of patterns P to those of symbol + P."""
        base = self.base[symbol]
        return base + self.bwt.place(symbol, low), base + self.bwt.place(symbol, high)

    def groups(self, length: int) -> np.ndarray:
        """First row of each row's group of suffixes with equal first ``length`` (8 to 16) symbols."""
        head, tail = self._eight[self.suffixes], self._eight[self.suffixes + length - 8]
        new = np.ones(self.size, bool)
        new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        return np.maximum.accumulate(np.where(new, np.arange(self.size), 0))

    def count(self, pattern: np.ndarray) -> int:
        low, high = np.zeros(1, np.int64), np.full(1, self.size)
        for symbol in pattern[::-1]:
            low, high = self.extend(np.array([symbol]), low, high)
        return int(high[0] - low[0])


def first_owners(sequences: list[np.ndarray], owner: np.ndarray, window: int) -> list[np.ndarray]:
    """For every sequence and every window of it, the smallest owner of a sequence that has the window.

    The sequences are indexed, then streamed through the index from their last word to their first.
    Matching statistics are cut off at the window's length: after a window's rows are known, the
    match is shortened to its first ``window`` - 1 words, whose rows are a group of neighbours.
    """
    lengths = np.array([len(s) for s in sequences])
    begins = np.cumsum(lengths + 1) - lengths - 1
    flat = np.concatenate(sequences)
    values, ids = np.unique(flat, return_inverse=True)
    text = np.zeros(len(flat) + len(sequences), np.int64)
    inside = np.ones(len(text), bool)
    inside[begins + lengths] = False
    text[inside] = ids + 1
    index = FMIndex(text, len(values) + 1)

    owners = np.repeat(owner, lengths + 1)[index.suffixes]
    whole = index.groups(window)
    starts = np.flatnonzero(whole == np.arange(index.size))
    least = np.zeros(index.size, np.int64)
    least[starts] = np.minimum.reduceat(owners, starts)
    short = index.groups(window - 1)
    short_starts = np.flatnonzero(short == np.arange(index.size))
    short_end = np.append(short_starts, index.size)[np.searchsorted(short_starts, np.arange(index.size), "right")]

    out = [np.zeros(max(0, n - window + 1), np.int64) for n in lengths]
    flat_out = np.zeros(int(np.maximum(lengths - window + 1, 0).sum()), np.int64)
    out_end = np.cumsum(np.maximum(lengths - window + 1, 0))
    low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), index.size)
    for step in range(int(lengths.max(initial=0))):
        lane = np.flatnonzero(lengths > step)
        low[lane], high[lane] = index.extend(text[begins[lane] + lengths[lane] - 1 - step], low[lane], high[lane])
        if step + 1 >= window:
            flat_out[out_end[lane] - 1 - (step + 1 - window)] = least[low[lane]]
            low[lane], high[lane] = short[low[lane]], short_end[low[lane]]
    return np.split(flat_out, out_end[:-1]) if len(out) else []

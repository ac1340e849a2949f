"""A compressed FM-index over integer symbols, with vectorised backward search.

The Burrows-Wheeler transform is held in a wavelet tree of bit-packed levels
(each level's zeros go left, its ones right). Many patterns are extended at
once: a step is one rank query per level for all interval ends together.

Suffixes are sorted by their first ``depth`` symbols, which is all that
patterns of up to ``depth`` symbols can tell apart.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


class WaveletTree:
    """Rank queries over a sequence of symbols 0 .. sigma - 1."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = list(range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1))
        self.bits, self.before, self.zeros = [], [], []
        for level in self.levels:
            bit = (symbols >> level & 1).astype(np.uint8)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, dtype=np.uint8)]).view(U)
            self.bits.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]]))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.first = self._descend(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, before, zeros in zip(self.levels, self.bits, self.before, self.zeros):
            word = at >> 6
            ones = before[word] + np.bitwise_count(bits[word] & ((U(1) << (at & 63).astype(U)) - U(1)))
            at = np.where(symbol >> level & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``at``, elementwise."""
        return self._descend(symbol, at) - self.first[symbol]


class FmIndex:
    """Index of a text of symbols 1 .. sigma - 1 with 0 as separator."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        self.size, self.sigma, self.depth = len(text), sigma, depth
        rank, self._by_length = text.astype(np.int64), {}
        length = 1
        self._by_length[1] = rank
        while length < depth:
            key = rank * (self.size + 1) + self._shifted(rank, length)
            order = np.argsort(key, kind="stable")
            rank = np.empty(self.size, dtype=np.int64)
            rank[order] = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
            length *= 2
            self._by_length[length] = rank
        self.suffixes = np.argsort(rank, kind="stable") if length == 1 else order
        self.tree = WaveletTree(text[self.suffixes - 1], sigma)  # the text is read as a circle
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])

    def _shifted(self, rank: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(self.size, dtype=np.int64)
        if by < self.size:
            out[:-by] = rank[by:] + 1
        return out

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of ``symbol + pattern`` from the intervals of the patterns."""
        at = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.starts[symbol]
        return base + at[: len(lo)], base + at[len(lo) :]

    def blocks(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place in the suffix order, the interval of suffixes that agree on ``length`` symbols.

        This is what a pattern's interval widens to when its end is cut to ``length``.
        """
        if length < 1:
            return np.zeros(self.size, dtype=np.int64), np.full(self.size, self.size)
        half = 1 << (length.bit_length() - 1)
        a = self._by_length[half]
        b = self._shifted(a, length - half) if length > half else a
        a, b = a[self.suffixes], b[self.suffixes]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        ends = np.concatenate([starts[1:], [self.size]])
        return starts[group], ends[group]


def window_owners(texts: list[list[int]], owners: np.ndarray, sigma: int, window: int) -> list[np.ndarray]:
    """For every window of every text, the smallest owner of a text that holds it.

    The texts (symbols from 1) are indexed with a separator after each and
    streamed from their ends, all in step: the match grows by a backward step and
    is cut to ``window - 1`` symbols once it is ``window`` long, so matching
    statistics above the threshold cost one step per symbol. Every text is part
    of the index, so no extension fails.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.zeros(int(sizes.sum()) + len(texts), dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    holder = np.repeat(np.arange(len(texts)), sizes + 1)
    flat[np.arange(len(flat)) - first[holder] < sizes[holder]] = np.concatenate([np.asarray(t, dtype=np.int64) for t in texts])
    index = FmIndex(flat, sigma, window)
    owner_of_place = owners[holder[index.suffixes]]
    cut_lo, cut_hi = index.blocks(window - 1)
    lo, hi = np.zeros(len(texts), dtype=np.int64), np.full(len(texts), index.size)
    ends: list[tuple] = []
    for step in range(int(sizes.max(initial=0))):
        live = np.flatnonzero(sizes > step)
        at = sizes[live] - 1 - step
        a, b = index.extend(flat[first[live] + at], lo[live], hi[live])
        if step + 1 >= window:
            ends.append((live, at, a, b))
            a, b = cut_lo[a], cut_hi[a]
        lo[live], hi[live] = a, b
    out = [np.zeros(max(0, n - window + 1), dtype=np.int64) for n in sizes]
    if not ends:
        return out
    text, at, a, b = (np.concatenate(x) for x in zip(*ends))
    interval, back = np.unique(a * (index.size + 1) + b, return_inverse=True)
    a, b = interval // (index.size + 1), interval % (index.size + 1)
    padded = np.concatenate([owner_of_place, owner_of_place[:1]])
    least = np.minimum.reduceat(padded, np.column_stack([a, b]).reshape(-1))[::2][back]
    offsets = np.concatenate([[0], np.cumsum(np.maximum(sizes - window + 1, 0))])
    whole = np.empty(offsets[-1], dtype=np.int64)
    whole[offsets[text] + at] = least
    return [whole[i:j] for i, j in zip(offsets[:-1], offsets[1:])]

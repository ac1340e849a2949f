"""Words of many texts at once, as numpy arrays over the UTF-8 bytes.

The blanks that part words are single bytes, so words are byte spans; spans,
hashes and windows of a whole batch come from a few vector operations. The
polynomial hashes only route and choose: some long strings share one, so what is
taken for equal is compared by 128-bit digests of its bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
_RADIX = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the radix and of its inverse modulo 2**64, n of each."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _RADIX), ("down", _INVERSE)):
            p = np.full(size, base, dtype=U)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=U)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(33))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Polynomial sums of all prefixes, modulo 2**64."""
    up, _ = _power(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=U)
    np.cumsum((values.astype(U) + U(1)) * up[:-1], out=total[1:], dtype=U)
    return total


def span_hash(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span ``values[start:end]`` given ``prefix_sums(values)``; equal spans have equal hashes."""
    _, down = _power(len(total))
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U))


@dataclass
class Words:
    """Words of a batch of texts: byte spans, and where each text's words begin."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    first: np.ndarray  # of each text its first word; one more entry ends the last

    def hashes(self) -> np.ndarray:
        return span_hash(prefix_sums(self.data), self.starts, self.ends)


def joined(w: Words) -> tuple[memoryview, np.ndarray]:
    """All words with one space behind each, and where each word begins (one more entry ends the last).

    The bytes of words ``i`` to ``j - 1`` joined by one space are ``data[at[i] : at[j] - 1]``.
    """
    sizes = w.ends - w.starts
    at = np.concatenate(([0], np.cumsum(sizes + 1)))
    data = np.full(int(at[-1]), 32, dtype=np.uint8)
    into = np.arange(int(sizes.sum()))
    own = np.cumsum(sizes) - sizes
    data[np.repeat(at[:-1] - own, sizes) + into] = w.data[np.repeat(w.starts - own, sizes) + into]
    return memoryview(data), at


def digests(w: Words, first: np.ndarray, last: np.ndarray) -> list[bytes]:
    """128-bit digests of the words ``first[k]`` to ``last[k] - 1`` joined by one space."""
    data, at = joined(w)
    return [xxhash.xxh3_128_digest(data[a : b - 1]) for a, b in zip(at[first].tolist(), at[last].tolist())]


#: Letter runs, for bags of words: ASCII letters and every byte of other characters.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(col: pa.Array, within: np.ndarray = ~_BLANK, lower: bool = False) -> Words:
    """Runs of the bytes marked in ``within`` of every text (null: none).

    By default words between blanks; ``lower`` lower-cases A-Z.
    """
    texts = pc.fill_null(col, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    inside = within[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]  # texts with bytes: words don't cross from one to the next
    begins[offsets[:-1][full]] = inside[offsets[:-1][full]]
    stops[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))

"""Runs of words that repeat with a period, by the dictionary of basic factors.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) that holds its period at least ``min_exponent`` times and at least
``min_length`` words.

For each power-of-two length L every factor of L words gets a name: equal names
are equal factors. The name of a factor of 2L words is the pair of names of its
halves, so factors that occur once in their text need no name and drop out. Of
the occurrences of one name, successors at most 2L apart that form an arithmetic
progression (i, i + q, i + 2q) propose the period q. That finds every run: with
L / 2 < q <= L and four periods, its first factor of L words recurs after q and 2q
words, and nowhere between (two periods of a stretch of their summed length have
their common divisor as a period, and q is the smallest). The names, longest
first, extend a proposal to both sides; equal (start, period) are one run.

All texts of a batch are handled together: names carry the text they are in, so a
factor over two texts is unique. Words are compared as whole strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.llm.common import chunks, compact

MIN_LENGTH, MIN_EXPONENT = 6, 4
CHUNK = 4 << 20  # bytes of texts handled together (one text at least)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "runs array<struct<start:long,length:long,period:long>>, collapsed string, n_words long"


def _rank(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the keys that occur more than once (others -1), and the positions of those, grouped by key and ascending."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.concatenate(([True], k[1:] != k[:-1])) if len(k) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    again = np.bincount(group)[group] > 1 if len(k) else new
    rank = np.full(len(keys), -1, dtype=np.int64)
    rank[order[again]] = group[again]
    return rank, order[again]


def basic_factors(word: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per power of two ``(length, names, occurrences)`` while a factor of the length recurs in a text.

    ``names`` has -1 - position for factors that occur once; ``occurrences`` are the
    others' positions, grouped by name and ascending.
    """
    n = len(word)
    at = np.arange(n)
    keys = text.astype(np.int64) << 32 | word
    length = 1
    while len(at):
        rank, again = _rank(keys)
        names = -1 - np.arange(n)
        names[at] = np.where(rank >= 0, rank, names[at])
        again = at[again]
        if not len(again):
            return
        yield length, names, again
        # both halves must recur for the whole to recur
        at = np.sort(again)
        at = at[at + length < n]
        at = at[names[at + length] >= 0]
        keys = names[at] << 32 | names[at + length]
        length *= 2


def _proposals(names: np.ndarray, again: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``(position, period)`` of successors in arithmetic progression, the first of neighbouring positions."""
    gap = np.where(names[again[1:]] == names[again[:-1]], again[1:] - again[:-1], 0)
    hit = np.flatnonzero((gap[1:] == gap[:-1]) & (gap[1:] > 0) & (gap[1:] <= 2 * length)) if len(gap) > 1 else np.zeros(0, np.int64)
    at, period = again[hit], gap[hit]
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    first = np.concatenate(([True], (period[1:] != period[:-1]) | (at[1:] != at[:-1] + 1)))[: len(at)]
    return at[first], period[first]


def _extent(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from a and b rightwards (``step`` 1) or before a and b leftwards (-1)."""
    total = np.zeros(len(a), dtype=np.int64)
    for length, names in reversed(levels):
        i, j = (a + total, b + total) if step > 0 else (a - total - length, b - total - length)
        inside = (i >= 0) & (j >= 0) & (i < len(names)) & (j < len(names))
        total[inside] += length * (names[i[inside]] == names[j[inside]])
    return total


def find_runs(word: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT):
    """``(start, length, period)`` of all runs, sorted by start, then period.

    ``word`` are the word numbers of several texts one after the other, ``text`` the
    number of each word's text. ``min_exponent`` is 4 or more.
    """
    if min_exponent < 4:
        raise ValueError("the proposals need runs of four periods")
    levels, at, period = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for length, names, again in basic_factors(word, text):
        levels.append((length, names))
        i, q = _proposals(names, again, length)
        at.append(i)
        period.append(q)
    at, period = np.concatenate(at), np.concatenate(period)
    if not len(at):
        return at, at, at
    left = _extent(levels, at, at + period, -1)
    right = _extent(levels, at, at + period, 1)
    start, size = at - left, left + right + period
    long = size >= np.maximum(min_length, min_exponent * period)
    runs = np.unique(np.stack([start[long], period[long], size[long]], axis=1), axis=0)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def collapse_batch(texts: pa.Array, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[pa.Array]:
    """Of every text its runs, its kept words joined by one space, and its number of words."""
    lists = pc.ascii_split_whitespace(compact(texts))
    words = lists.flatten()
    owner = pc.list_parent_indices(lists)
    real = pc.not_equal(pc.binary_length(words), 0)  # blanks at the ends leave empty strings
    words, owner = words.filter(real), owner.filter(real).to_numpy().astype(np.int64)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    coded = words.dictionary_encode()
    start, size, period = find_runs(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), owner, min_length, min_exponent)
    # words covered after a run's first period: counts of runs that begin and end
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + size, -1)
    kept = np.cumsum(edge[:-1]) == 0
    starts = np.concatenate(([0], np.cumsum(kept)))[first]
    rest = pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), words.filter(pa.array(kept)))
    of_text = np.searchsorted(start, first)
    own = first[np.searchsorted(first, start, side="right") - 1] if len(start) else start
    rows = pa.StructArray.from_arrays([pa.array(start - own, pa.int64()), pa.array(size, pa.int64()), pa.array(period, pa.int64())], fields=list(_RUN))
    return [
        pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), rows),
        pc.binary_join(rest, pa.scalar(" ", pa.large_string())).cast(pa.string()),
        pa.array(np.diff(first), pa.int64()),
    ]


def collapse_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period in words), ``collapsed`` and ``n_words`` of each whole text.

    A word is dropped from ``collapsed`` if a run holds it after the run's first
    period; the others are joined by one space. Words are the stretches between
    space, tab, line feed, vertical tab, form feed and carriage return, unchanged.

    * null, empty or blank texts have no run, an empty ``collapsed`` and 0 words;
    * texts may have any length (one text is handled by one task, in memory that
      grows with its words times the levels at which one of its factors recurs);
    * repeated rows stay rows of their own; other columns are passed on, but columns
      of the three new names are replaced; an empty table gives an empty table.
    """
    docs = docs.drop("runs", "collapsed", "n_words")
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(FOUND).fields])

    def task(batches):
        for b in batches:
            texts = b.column(text_col)
            for lo, hi in chunks(texts, CHUNK):
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, *collapse_batch(part.column(text_col), min_length, min_exponent)], names=schema.names)

    return docs.mapInArrow(task, schema)


def longest(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then period); null without runs."""
    order = F.transform(runs, lambda r: F.struct((-r["length"]).alias("k"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(order)

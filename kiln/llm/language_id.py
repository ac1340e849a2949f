"""Language identification with segmentation-marginalised unigram models.

Each language has a probability for every piece of a fixed public vocabulary and
for every byte. The probability of a word is the sum over all ways to cut it into
pieces, computed by a forward algorithm over its positions; a letter that is no
piece is the product of its UTF-8 bytes. A text is scored by the sum of its words'
logarithms. Words of any length are summed whole: short ones of equal length
together, long ones one by one with rescaled sums over a window as wide as the
longest piece.

Training counts (language, word) over all learning texts -- the only thing that
shuffles, combined per task -- and runs expectation maximisation on the distinct
words: a forward-backward pass gives expected piece counts, whose sums per
(language, piece) are the next probabilities. Only those sums, bounded by the
vocabulary times the languages, reach the driver. Scoring is one pass over the
texts without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import chunks, keep

LETTERS = re.compile(r"[^\W\d_]+")
TOGETHER = 24  # words of more letters are summed one by one
ROUNDS = 2
BYTES = 256
SMOOTHING = 0.1
CACHE = 300_000
UNKNOWN = "und"


def words(text: str | None) -> list[str]:
    """Letter runs of the lower-cased text."""
    return LETTERS.findall((text or "").lower())


def marked(word: str) -> str:
    """The word with the mark of its begin."""
    return "▁" + word


class Pieces:
    """The vocabulary: piece texts to numbers; the bytes follow from number ``size`` on.

    A batch of words numbers its letters that are no pieces behind the bytes.

    The pieces form a trie whose edges are one sorted array of (node, letter)
    keys, so the spans of many words are looked up with one search a length.
    """

    def __init__(self, pieces: list[str]):
        self.index = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        self.size = len(self.index)
        self.longest = max(map(len, self.index), default=1)
        edges, ends = {}, [-1]
        for name, number in self.index.items():
            node = 0
            for letter in map(ord, name):
                node = edges.setdefault(node << 21 | letter, len(ends))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = number
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.to = np.append(np.fromiter(edges.values(), np.int64, len(edges))[order], 0)
        self.ends = np.array(ends, dtype=np.int64)

    def spans(self, n: int) -> list[tuple[int, int]]:
        return [(i, j) for j in range(1, n + 1) for i in range(max(0, j - self.longest), j)]

    def foreign(self, batch: list[str]) -> list[str]:
        """Letters of the batch that are no pieces, in code-point order."""
        return sorted(c for c in set().union(*batch) if c not in self.index)

    def bytes_of(self, letter: str) -> list[int]:
        """Numbers of a letter's bytes."""
        return [self.size + x for x in letter.encode("utf-8", "surrogatepass")]

    def extended(self, table: np.ndarray, foreign: list[str]) -> np.ndarray:
        """``table`` (its last row is of zeros) with rows for the foreign letters before the last."""
        rows = [table[self.bytes_of(c)].prod(axis=0) for c in foreign]
        return np.concatenate([table[:-1], np.array(rows).reshape(len(rows), *table.shape[1:]), table[-1:]])

    def _numbers(self, letters: np.ndarray, foreign: list[str]) -> np.ndarray:
        """Numbers of letters as foreign ones (any number for the others: a piece takes their place)."""
        points = np.array([ord(c) for c in foreign], dtype=np.int64)
        return self.size + BYTES + np.searchsorted(points, letters)

    def band(self, word: str, foreign: list[str]) -> np.ndarray:
        """Piece number of the span of ``k + 1`` letters from each position (letters, longest piece); -1 if it is none."""
        letters = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        out = np.full((len(letters), self.longest), -1, dtype=np.int64)
        out[:, 0] = self._numbers(letters, foreign)
        start, node = np.arange(len(letters)), np.zeros(len(letters), dtype=np.int64)
        for size in range(1, self.longest + 1):
            inside = start + size <= len(letters)
            start, node = start[inside], node[inside]
            key = node << 21 | letters[start + size - 1]
            at = np.searchsorted(self.keys, key)
            found = self.keys[at] == key
            start, node = start[found], self.to[at[found]]
            piece = self.ends[node]
            out[start[piece >= 0], size - 1] = piece[piece >= 0]
        return out

    def lattice(self, batch: list[str], foreign: list[str]) -> np.ndarray:
        """Piece number of every span of words of one length; -1 if the span is no piece."""
        n, spans = len(batch[0]), self.spans(len(batch[0]))
        column = np.zeros((n, n + 1), dtype=np.int64)
        first, last = np.array(spans).T
        column[first, last] = np.arange(len(spans))
        letters = np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        out = np.full((len(batch), len(spans)), -1, dtype=np.int64)
        out[:, column[np.arange(n), np.arange(1, n + 1)]] = self._numbers(letters, foreign).reshape(len(batch), n)
        start = np.arange(len(letters))
        begin, word = start % n, start // n
        node = np.zeros(len(start), dtype=np.int64)
        for size in range(1, min(n, self.longest) + 1):
            inside = begin + size <= n
            start, begin, word, node = start[inside], begin[inside], word[inside], node[inside]
            key = node << 21 | letters[start + size - 1]
            at = np.searchsorted(self.keys, key)
            found = self.keys[at] == key
            start, begin, word, node = start[found], begin[found], word[found], self.to[at[found]]
            piece = self.ends[node]
            whole = piece >= 0
            out[word[whole], column[begin[whole], begin[whole] + size]] = piece[whole]
        return out

    def forward(self, n: int, p: np.ndarray) -> np.ndarray:
        """Forward sums (words, n + 1, ...) from span probabilities (words, spans, ...)."""
        a = np.zeros((p.shape[0], n + 1, *p.shape[2:]))
        a[:, 0] = 1
        for k, (i, j) in enumerate(self.spans(n)):
            a[:, j] += a[:, i] * p[:, k]
        return a

    def backward(self, n: int, p: np.ndarray) -> np.ndarray:
        b = np.zeros((p.shape[0], n + 1, *p.shape[2:]))
        b[:, n] = 1
        for k, (i, j) in reversed(list(enumerate(self.spans(n)))):
            b[:, i] += b[:, j] * p[:, k]
        return b


def by_length(batch: list[str]) -> dict[int, list[int]]:
    out = defaultdict(list)
    for i, w in enumerate(batch):
        out[len(w)].append(i)
    return out


def scaled_sums(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward sums of one long word, each as a value and the logarithm of its scale.

    ``p`` (letters, longest piece, ...) has the probability of the span of k + 1
    letters from each position. Sum j is ``value[j] * exp(scale[j])``.
    """
    n, width = p.shape[:2]
    value, scale = np.zeros((n + 1, *p.shape[2:])), np.zeros((n + 1, *p.shape[2:]))
    value[0] = 1
    for j in range(1, n + 1):
        lo = max(0, j - width)
        top = scale[lo:j].max(axis=0)
        total = (value[lo:j] * np.exp(scale[lo:j] - top) * p[np.arange(lo, j), j - 1 - np.arange(lo, j)]).sum(axis=0)
        good = total > 0
        value[j] = np.where(good, 1.0, 0.0)
        scale[j] = np.where(good, top + np.log(np.where(good, total, 1.0)), top)
    return value, scale


def log_likelihoods(pieces: Pieces, table: np.ndarray, batch: list[str]) -> np.ndarray:
    """Logarithm of each marked word's probability under each language (words, languages).

    ``table``: probabilities (pieces, bytes and a row of zeros for spans that are no piece; languages).
    """
    out = np.zeros((len(batch), table.shape[1]))
    foreign = pieces.foreign(batch)
    table = pieces.extended(table, foreign)
    for n, at in by_length(batch).items():
        if n > TOGETHER:
            for i in at:
                out[i] = scaled_sums(table[pieces.band(batch[i], foreign)])[1][-1]
            continue
        for lo in range(0, len(at), 2048):
            part = at[lo : lo + 2048]
            p = table[pieces.lattice([batch[i] for i in part], foreign)]
            out[part] = np.log(np.maximum(pieces.forward(n, p)[:, n], 1e-300))
    return out


def expected_counts(pieces: Pieces, p: np.ndarray, batch: list[str], weight: np.ndarray) -> np.ndarray:
    """Expected number of each piece and byte over all segmentations; ``p`` has a zero for -1 at its end."""
    foreign = pieces.foreign(batch)
    wide = pieces.extended(p, foreign)
    out = np.zeros(len(wide))
    for n, at in by_length(batch).items():
        if n > TOGETHER:
            for i in at:
                band = pieces.band(batch[i], foreign)
                out += np.bincount((band % len(wide)).reshape(-1), weights=(_span_shares(wide[band]) * weight[i]).reshape(-1), minlength=len(wide))
            continue
        for lo in range(0, len(at), 4096):
            part = np.array(at[lo : lo + 4096])
            ids = pieces.lattice([batch[i] for i in part], foreign)
            q = wide[ids]
            a, b = pieces.forward(n, q), pieces.backward(n, q)
            whole = np.maximum(a[:, n], 1e-300)
            first, last = np.array(pieces.spans(n)).T
            share = a[:, first] * q * b[:, last] / whole[:, None] * weight[part][:, None]
            out += np.bincount(ids.reshape(-1) % len(wide), weights=share.reshape(-1), minlength=len(wide))
    counts = np.append(out[: len(p) - 1], 0.0)
    for k, c in enumerate(foreign):
        np.add.at(counts, pieces.bytes_of(c), out[len(p) - 1 + k])
    return counts


def _span_shares(p: np.ndarray) -> np.ndarray:
    """Share of the segmentations of one long word that use each span of its band ``p``."""
    n, width = p.shape
    a, a_scale = scaled_sums(p)
    # backward sums are the forward sums of the word read from its end
    at = np.arange(n)[:, None] - np.arange(width)
    back = np.where(at >= 0, p[np.maximum(at, 0), np.arange(width)], 0.0)[::-1]
    b, b_scale = (x[::-1] for x in scaled_sums(back))
    end = np.arange(n)[:, None] + 1 + np.arange(width)
    inside = (end <= n) & (p > 0)
    end = np.minimum(end, n)
    scale = a_scale[:n, None] + b_scale[end] - a_scale[n]
    return np.where(inside, a[:n, None] * p * b[end] * np.exp(np.minimum(scale, 700)), 0.0)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # (pieces, bytes and a row of zeros; languages)
    pieces: list[str]


def _count_task(batches):
    """Texts to (lang, word, n), combined within the task up to a bounded number of words."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def rows():
        found = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], ["lang", "word", "n"]) if found else None

    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            counts[lang].update(words(text))
            if sum(map(len, counts.values())) > CACHE:
                yield rows()
                counts.clear()
    if (last := rows()) is not None:
        yield last


def fit(docs: DataFrame, pieces: list[str], text_col: str = "text", lang_col: str = "lang", rounds: int = ROUNDS) -> LanguageModel:
    """Learn from all rows with a non-null language and text.

    ``pieces``: the vocabulary's piece texts, word begins marked with U+2581.
    """
    counted = (
        docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .mapInArrow(_count_task, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )
    counted = keep(counted, "word-counts")
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    size = Pieces(pieces).size
    known = size + BYTES
    table = np.full((known + 1, len(languages)), 1 / known)
    table[known] = 0
    at = {lang: i for i, lang in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        shared = docs.sparkSession.sparkContext.broadcast((pieces, table, at))

        def expect(batches, shared=shared):
            names, p, at = shared.value
            vocabulary, total = Pieces(names), np.zeros((p.shape[1], p.shape[0]))
            for b in batches:
                lang = np.array([at[x] for x in b.column("lang").to_pylist()], dtype=np.int64)
                word, n = b.column("word").to_pylist(), b.column("n").to_numpy().astype(float)
                for k in np.unique(lang).tolist():
                    mine = np.flatnonzero(lang == k)
                    total[k] += expected_counts(vocabulary, p[:, k], [marked(word[i]) for i in mine], n[mine])
            k, piece = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(piece), pa.array(total[k, piece])], ["lang", "piece", "n"])

        sums = counted.mapInArrow(expect, "lang long, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        count = np.zeros_like(table)
        rows = sums.toPandas()
        count[rows["piece"], rows["lang"]] = rows["n"].round(6)
        count = count[:known] + SMOOTHING
        table = np.vstack([count / count.sum(axis=0), np.zeros((1, len(languages)))])
    return LanguageModel(languages, table, pieces)


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the likeliest language and its posterior probability (equal priors).

    ``und`` with score 0 for a null text, one without a letter, or an empty
    model. Ties go to the first language in code-point order. Other columns are
    passed on; columns of the new names are replaced.
    """
    from pyspark.sql.types import StructType

    docs = docs.drop(lang_out, score_out)
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"`{lang_out}` string, `{score_out}` double").fields])
    at, shared = docs.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def task(batches):
        m = shared.value
        pieces, row, logs = Pieces(m.pieces), {}, np.zeros((0, len(m.languages)))
        for b in batches:
            texts, lang, score = b.column(at), [], []
            for lo, hi in chunks(texts):
                found = [words(t) for t in texts.slice(lo, hi - lo).to_pylist()]
                if len(row) > CACHE:
                    row, logs = {}, logs[:0]
                new = [w for w in set(chain.from_iterable(found)) if w not in row]
                row.update(zip(new, range(len(row), len(row) + len(new))))
                logs = np.concatenate([logs, log_likelihoods(pieces, m.table, [marked(w) for w in new])])
                for ps in found:
                    if not ps or not m.languages:
                        lang.append(UNKNOWN)
                        score.append(0.0)
                        continue
                    total = logs[list(map(row.__getitem__, ps))].sum(axis=0)
                    best = int(total.argmax())
                    lang.append(m.languages[best])
                    score.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return docs.mapInArrow(task, schema)

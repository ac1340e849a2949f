"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models over
the words of a text and their beginnings; each model also sees the log-odds of all categories before
it. For training, those come from out-of-fold predictions: a row's own label
never reaches the features its later models are fitted on.

The chain is fitted on a bounded, hash-drawn sample of the labelled rows
(``sample`` rows, the documented bound). Candidate words are counted over the
sample first, so its rows become short lists of word numbers; the fold models of
a category, each choosing its words from its own rows, and the final model are
fitted in parallel tasks. Scoring is one pass over all whole
texts with word hashing by vector operations and no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kiln.llm.common import chunks, keep
from kiln.llm.words import LETTERS, prefix_sums, span_hash, words_of

SAMPLE = 20_000
FEATURES = 512
CANDIDATES = 4096
MIN_DOCS = 5
PREFIXES = (4, 5, 6, 7, 8)
L2 = 0.1
FOLDS = 5
CLIP = 6.0


def features(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Lower-cased words and their beginnings of the texts, about 1 MB of texts at a time.

    Yields ``(first row, row after the last, row, feature)``; rows count from the
    first, pairs may repeat. A feature is the hash of a word, or of its first
    ``PREFIXES`` bytes, so a stem counts in all its forms.
    """
    for lo, hi in chunks(col, 1 << 20):
        w = words_of(col.slice(lo, hi - lo), LETTERS, lower=True)
        row = np.repeat(np.arange(hi - lo), np.diff(w.first))
        size, total = w.ends - w.starts, prefix_sums(w.data)
        rows, ids = [row], [w.hashes().view(np.int64)]
        for n in PREFIXES:
            longer = size > n
            starts = w.starts[longer]
            rows.append(row[longer])
            ids.append(span_hash(total, starts, starts + n).view(np.int64))
        yield lo, hi, np.concatenate(rows), np.concatenate(ids)


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return row[new], value[new]


def _in_vocabulary(vocabulary: np.ndarray, row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(vocabulary):
        return row[:0], h[:0]
    at = np.searchsorted(vocabulary, h)
    at[at == len(vocabulary)] = 0
    hit = vocabulary[at] == h
    return distinct(row[hit], at[hit])


def tells(df: np.ndarray, pos: np.ndarray, n: int, p: float) -> np.ndarray:
    """How much each word's presence tells about a label: log-likelihood ratio from
    the texts that hold it (``df``), the positive among them (``pos``), and of all."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    g = part(pos, df * p / n) + part(df - pos, df * (n - p) / n)
    return g + part(p - pos, (n - df) * p / n) + part(n - p - df + pos, (n - df) * (n - p) / n)


def choose_words(row: np.ndarray, word: np.ndarray, y: np.ndarray, most: int = FEATURES) -> np.ndarray:
    """The words that tell most about ``y``, sorted."""
    words, at, df = np.unique(word, return_inverse=True, return_counts=True)
    g = tells(df, np.bincount(at, weights=y[row], minlength=len(words)), len(y), y.sum())
    ok = np.flatnonzero(df >= MIN_DOCS)
    return np.sort(words[ok[np.lexsort((words[ok], -g[ok]))][:most]])


def candidate_words(texts: DataFrame, categories: int) -> np.ndarray:
    """Hashes of the ``CANDIDATES`` features that tell most about any category, sorted.

    ``texts``: the bounded sample ``(text, y)``. A task leaves out features it
    saw in one text only; counts are summed per feature.
    """

    def count(batches):
        held = np.zeros((0, 2 + categories), dtype=np.int64)
        for b in batches:
            labels = np.array(b.column("y").to_pylist(), dtype=np.int64).reshape(-1, categories)
            for lo, hi, row, h in features(b.column("text")):
                row, h = distinct(row, h)
                rows = np.concatenate([held, np.column_stack([h, np.ones(len(h), np.int64), labels[lo:hi][row]])])
                words, at = np.unique(rows[:, 0], return_inverse=True)
                held = np.column_stack([words, *[np.bincount(at, weights=rows[:, k], minlength=len(words)).astype(np.int64) for k in range(1, 2 + categories)]])
        held = held[held[:, 1] > 1]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.T], ["word", "df", *[f"pos{i}" for i in range(categories)]])

    columns = ["df", *[f"pos{i}" for i in range(categories)]]
    counts = texts.mapInArrow(count, "word long, " + ", ".join(f"{c} long" for c in columns))
    found = counts.groupBy("word").agg(*[F.sum(c).alias(c) for c in columns]).where(F.col("df") >= MIN_DOCS).toPandas()
    total = texts.agg(F.count("*"), *[F.sum(F.element_at("y", i + 1)) for i in range(categories)]).collect()[0]
    g = [tells(found["df"].to_numpy(), found[c].to_numpy(), total[0], p or 0.0) for c, p in zip(columns[1:], total[1:])]
    word = found["word"].to_numpy(dtype=np.int64)
    return np.sort(word[np.lexsort((word, -np.max(g, axis=0)))][:CANDIDATES])


def fit_logistic(row, col, dense, y, n_words: int, l2: float = L2, rounds: int = 60) -> np.ndarray:
    """Weights (words, dense columns, bias) of an L2-penalised logistic model, by L-BFGS."""
    n, k = dense.shape
    size = n_words + k + 1

    def score(w):
        return np.bincount(row, weights=w[col], minlength=n) + dense @ w[n_words:-1] + w[-1]

    def loss(w):
        z = score(w)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        value = np.logaddexp(0, z).sum() - (y * z).sum() + l2 / 2 * (w[:-1] @ w[:-1])
        d = p - y
        g = np.concatenate([np.bincount(col, weights=d[row], minlength=n_words), dense.T @ d, [d.sum()]])
        g[:-1] += l2 * w[:-1]
        return value, g

    w = np.zeros(size)
    value, g = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, alphas = g.copy(), []
        for s, t in reversed(past):
            a = (s @ q) / (s @ t)
            alphas.append(a)
            q -= a * t
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(g).max())
        for (s, t), a in zip(past, reversed(alphas)):
            q += s * (a - (t @ q) / (s @ t))
        step = 1.0
        while True:
            new = w - step * q
            new_value, new_g = loss(new)
            if new_value <= value - 1e-4 * step * (g @ q) or step < 1e-6:
                break
            step /= 2
        s, t = new - w, new_g - g
        if s @ t > 1e-12:
            past = [*past[-9:], (s, t)]
        done = abs(value - new_value) < 1e-6 * max(1.0, abs(value))
        w, value, g = new, new_value, new_g
        if done:
            break
    return w


@dataclass
class Link:
    """One category's model: vocabulary, word weights, weights of earlier log-odds, bias."""

    name: str
    vocabulary: np.ndarray
    weights: np.ndarray


@dataclass
class Chain:
    links: list[Link] = field(default_factory=list)

    def log_odds(self, n: int, row: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Clipped log-odds, a column per category."""
        out = np.zeros((n, 0))
        for link in self.links:
            r, c = _in_vocabulary(link.vocabulary, row, h)
            k = len(link.vocabulary)
            z = np.bincount(r, weights=link.weights[c], minlength=n) + out @ link.weights[k:-1] + link.weights[-1]
            out = np.column_stack([out, np.clip(z, -CLIP, CLIP)])
        return out


def _train(pdf: pd.DataFrame, category: int, model: int) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """Fit on the rows outside fold ``model`` (all rows if there is no such fold)."""
    y = np.array([v[category] for v in pdf["y"]], dtype=float)
    earlier = np.array(pdf["earlier"].tolist(), dtype=float).reshape(len(pdf), category)
    row = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["words"]])
    word = np.concatenate([np.zeros(0, np.int64), *pdf["words"]]).astype(np.int64)
    inside = (pdf["fold"] != model).to_numpy()
    at = np.cumsum(inside) - 1
    mine = inside[row]
    vocabulary = choose_words(at[row[mine]], word[mine], y[inside])
    r, c = _in_vocabulary(vocabulary, at[row[mine]], word[mine])
    w = fit_logistic(r, c, earlier[inside], y[inside], len(vocabulary))
    r, c = _in_vocabulary(vocabulary, row, word)
    z = np.bincount(r, weights=w[c], minlength=len(pdf)) + earlier @ w[len(vocabulary) : -1] + w[-1]
    held = pd.DataFrame({"key": pdf["key"], "z": np.clip(z, -CLIP, CLIP)})[~inside]
    return vocabulary, w, held


def _trainer(category: int):
    """Of a group's model: the predictions for its held-out fold, or the final weights."""

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        model = int(pdf["model"].iloc[0])
        vocabulary, w, held = _train(pdf.sort_values("key", ignore_index=True), category, model)
        if model < FOLDS:
            return held.assign(vocabulary=None, weights=None)
        return pd.DataFrame({"key": [None], "z": [None], "vocabulary": [vocabulary.tolist()], "weights": [w.tolist()]})

    return train


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: Sequence[tuple[str, Column]],
    id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
) -> Chain:
    """Fit the chain on about ``sample`` labelled rows.

    ``categories``: (name, 0/1 column of ``labels``) in chain order. Label rows
    with a null id or a null category are left out; of repeated label rows the
    larger value counts. Without usable rows the chain is empty.
    """
    names = [f"y{i}" for i in range(len(categories))]
    y = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("key"))
        .agg(*[F.max(c.cast("double")).alias(n) for n, (_, c) in zip(names, categories)])
        .dropna()
    )
    total = y.count()
    if not total:
        return Chain()
    drawn = F.pmod(F.xxhash64(F.lit("draw"), "key"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, sample / total) + 1)
    chosen = y.where(drawn).select("key", F.array(*names).alias("y"))  # about ``sample`` rows: fit to broadcast

    joined = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "key")
    joined = keep(joined.select("key", "y", "text"), "sample")
    candidates = candidate_words(joined.select("text", "y"), len(categories))
    shared = docs.sparkSession.sparkContext.broadcast(candidates)

    def featurise(batches):
        for b in batches:
            for lo, hi, row, h in features(b.column("text")):
                row, word = _in_vocabulary(shared.value, row, h)
                offsets = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(word, pa.int16()))
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("y"), words], ["key", "y", "words"])

    rows = joined.mapInArrow(
        featurise, StructType([joined.schema["key"], joined.schema["y"], *StructType.fromDDL("words array<short>").fields])
    )
    rows = keep(rows.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "key"), F.lit(FOLDS)).cast("int")), "labelled")
    rows = rows.withColumn("earlier", F.array().cast("array<double>"))
    chain = Chain()
    key_type = rows.schema["key"]
    out_type = StructType([key_type, *StructType.fromDDL("z double, vocabulary array<long>, weights array<double>").fields])
    for i, (name, _) in enumerate(categories):

        models = rows.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))))
        fitted = keep(models.groupBy("model").applyInPandas(_trainer(i), out_type), "fitted")
        final = fitted.where("weights IS NOT NULL").collect()
        if not final:
            return Chain()
        chain.links.append(Link(name, candidates[np.array(final[0]["vocabulary"], dtype=np.int64)], np.array(final[0]["weights"])))
        if i + 1 < len(categories):
            held = fitted.where("weights IS NULL").groupBy("key").agg(F.max("z").alias("z"))
            rows = keep(
                rows.join(held, "key").withColumn("earlier", F.array_append("earlier", F.col("z"))).drop("z"), "labelled"
            )
    return chain


def score(docs: DataFrame, chain: Chain, text_col: str = "text", prefix: str = "p_") -> DataFrame:
    """``docs`` with one probability per category (columns ``p_<name>``).

    A null or empty text has the probabilities of a text without words. All
    other columns are passed on; columns of the new names are replaced.
    """
    names = [prefix + link.name for link in chain.links]
    docs = docs.drop(*names)
    schema = StructType([*docs.schema.fields, *[StructField(n, DoubleType()) for n in names]])
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index(text_col)

    def task(batches):
        for b in batches:
            z = [shared.value.log_odds(hi - lo, row, h) for lo, hi, row, h in features(b.column(at))]
            p = 1 / (1 + np.exp(-np.concatenate(z))) if z else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x) for x in p.T]], names=schema.names)

    return docs.mapInArrow(task, schema)


#: Categories of the ``labels`` table in chain order: junk, toxic, both.
CATEGORIES = (
    ("junk", "1 - quality"),
    ("toxic", "toxic"),
    ("toxic_junk", "toxic * (1 - quality)"),
)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``p_junk, p_toxic, p_toxic_junk`` and ``toxic`` (``p_toxic`` >= threshold).

    Without usable labels nothing is known: every probability is 0.
    """
    chain = fit_chain(docs, labels, [(n, F.expr(e)) for n, e in CATEGORIES], id_col, text_col)
    if not chain.links:
        return docs.withColumns({f"p_{n}": F.lit(0.0) for n, _ in CATEGORIES}).withColumn("toxic", F.lit(False))
    return score(docs, chain, text_col).withColumn("toxic", F.col("p_toxic") >= threshold)

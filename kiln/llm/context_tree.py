"""Scores of texts under a context-tree weighting model of their bytes.

A text is coded as its words, each followed by a space, the last by a line feed
(which no word holds); a text without words is one line feed. Every byte is eight
binary decisions. A decision (the bits of the byte seen so far) has a context
tree of its own: at depth d it is counted apart for each d bytes before. A node
mixes its Krichevsky-Trofimov estimate, with weight 1/2, with the product of its
children, down to ``DEPTH`` bytes; texts are scored with the tree of the training
texts. Nothing is pruned or capped: the tree has a node for every context that
occurs, and what is counted grows with the corpus.

The statistics are counts of grams (``DEPTH`` bytes of context and the byte), and
of words for the base score.

1. Texts are stored in blocks of bounded size, lower-cased and compressed (a row
   a block); long texts go on in further pieces, cut between words. Each block
   asks for its distinct grams and words, with their training counts: a key is
   asked for once a block, so no key is hot, however often it occurs. Keys
   travel packed by hash bucket.
2. Buckets sum the counts. Subtrees below the last two context bytes are
   weighted in tasks, children before parents; sums per last byte (256 * 255 rows
   at most) give the two upper depths.
3. Log probabilities and word counts go back to the blocks that asked, which look
   up every byte and word of their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import chunks, compact, keep
from kiln.llm.words import mix, prefix_sums, span_hash

DEPTH = 5  # bytes of context; a gram has 48 bits
UPPER = 2  # depths weighted from sums
BLOCK = 12 << 20  # bytes of a block's texts
PIECE = 4 << 20  # bytes after which a text is cut at the next word
SLICE = 1 << 20  # bytes whose grams are sorted at once
TOGETHER = 1 << 18  # grams weighted at once
SPACE, END = 32, 10
_HALF = math.log(0.5)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0, by Stirling's series at x + 8."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) + 1 / (1188 * z**9)
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log probability that the Krichevsky-Trofimov estimator gives to so many zeros and ones."""
    found = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)
    return np.where(zeros + ones > 0, found, 0.0)


def mixed(estimate: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log of the weighted probability of nodes, and the share of their own estimate in it."""
    weighted = np.logaddexp(estimate + _HALF, children + _HALF)
    return weighted, np.exp(estimate + _HALF - weighted)


def _packed(x: np.ndarray | bytes) -> bytes:
    raw = bytes(x) if isinstance(x, (bytes, pa.Buffer)) else x.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(stored: bytes, kind=np.uint8) -> np.ndarray:
    raw = pa.decompress(stored[8:], int.from_bytes(stored[:8], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(raw, dtype=kind)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


# -- blocks of texts ---------------------------------------------------------


def normalised(texts: pa.Array) -> list[bytes]:
    """Words of each text (null: none), A-Z lower-cased, joined by one space, and a line feed."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(compact(texts)))
    flat, parents = words.flatten(), pc.list_parent_indices(words)
    real = pc.not_equal(pc.binary_length(flat), 0)
    first = np.searchsorted(parents.filter(real).to_numpy(), np.arange(len(texts) + 1))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), flat.filter(real)), pa.scalar(" ", pa.large_string()))
    return [b + b"\n" for b in joined.cast(pa.large_binary()).to_pylist()]


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Parts of a normalised text, each after the ``DEPTH`` bytes before it, cut after a space."""
    at = 0
    while at < len(text):
        to = len(text)
        if to - at > size:
            to = text.rfind(b" ", at, at + size) + 1 or text.find(b" ", at + size) + 1 or len(text)
        before = text[max(0, at - DEPTH) : at]
        yield b"\n" * (DEPTH - len(before)) + before + text[at:to]
        at = to


def _blocks_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(id, training, text)`` to one row a block; blocks and texts are numbered within the partition."""
    base = TaskContext.get().partitionId() << 33
    block, row, held, size = base, base, [], 0

    def row_of(held):
        ids = pa.concat_arrays([i for _, i, _, _ in held])
        whole = pa.array([0, len(held)], pa.int32())
        columns = [
            pa.array([block], pa.int64()),
            pa.ListArray.from_arrays(whole, pa.array([n for n, _, _, _ in held], pa.int64())),
            pa.ListArray.from_arrays(whole, ids),
            pa.ListArray.from_arrays(whole, pa.array([t for _, _, t, _ in held], pa.bool_())),
            pa.ListArray.from_arrays(whole, pa.array([len(p) for _, _, _, p in held], pa.int64())),
            pa.array([size], pa.int64()),
            pa.array([_packed(b"".join(p for _, _, _, p in held))], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "rows", "ids", "training", "lengths", "size", "bytes"])

    for b in batches:
        ids, training, texts = b.column("id"), b.column("training").to_pylist(), b.column("text")
        for lo, hi in chunks(texts, PIECE):
            for k, text in zip(range(lo, hi), normalised(texts.slice(lo, hi - lo))):
                for piece in pieces(text):
                    if held and size + len(piece) > BLOCK:
                        yield row_of(held)
                        block, held, size = block + 1, [], 0
                    held.append((row, ids.slice(k, 1), bool(training[k]), piece))
                    size += len(piece)
                row += 1
    if held:
        yield row_of(held)


class Block:
    """The bytes of a block, with its pieces."""

    def __init__(self, row: dict):
        self.data = _unpacked(row["bytes"])
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        self.training = np.array(row["training"], dtype=bool)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths

    def slices(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(grams, piece of each)`` of neighbouring bytes, about ``SLICE`` at a time."""
        n = len(self.data)
        for lo in range(0, n, SLICE):
            hi = min(n, lo + SLICE)
            at = max(lo, DEPTH)
            if at >= hi:
                continue
            gram = np.zeros(hi - at, dtype=np.int64)
            for k in range(DEPTH + 1):
                gram = gram << 8 | self.data[at - DEPTH + k : hi - DEPTH + k]
            first = int(np.searchsorted(self.ends, at, side="right"))
            last = int(np.searchsorted(self.ends, hi - 1, side="right"))
            own = np.arange(first, last + 1)
            piece = np.repeat(own, np.minimum(self.ends[own], hi) - np.maximum(self.starts[own], at))
            real = np.arange(at, hi) - self.starts[piece] >= DEPTH
            yield gram[real], piece[real]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct grams, ascending, and how often each occurs in training texts."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for gram, piece in self.slices():
            k, c = np.unique(gram << 1 | self.training[piece], return_counts=True)
            keys.append(k)
            counts.append(np.where(k & 1, c, 0))
        return summed(np.concatenate(keys) >> 1, np.concatenate(counts))

    def words(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct words (each with a space behind) in order of appearance, the number of each word, and its piece."""
        inside = np.ones(len(self.data), dtype=bool)
        for k in range(DEPTH):
            inside[self.starts + k] = False
        data = self.data[inside]
        stops = np.flatnonzero((data == SPACE) | (data == END))
        data[stops] = SPACE
        piece = np.searchsorted(np.cumsum(self.lengths - DEPTH), stops, side="right")
        offsets = np.concatenate(([0], stops + 1))
        real = np.diff(offsets) > 1  # a text without words has its end only
        words = spaced(data, offsets).filter(pa.array(real)).dictionary_encode()
        return words.dictionary, words.indices.to_numpy(zero_copy_only=False), piece[real]

    def last(self) -> np.ndarray:
        """Whether each piece ends its text."""
        return self.data[self.ends - 1] == END


def spaced(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())])


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _word_order(words: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words by bucket, and where each bucket begins."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[: int(offsets[-1])] if len(words) else np.zeros(0, np.uint8)
    bucket = _bucket(span_hash(prefix_sums(data), offsets[:-1], offsets[1:]), buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _gram_order(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    bucket = _bucket(grams, buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


GRAMS, WORDS = 0, 1


def _asked_task(buckets: int):
    """Blocks to the keys they ask for: ``(kind, bucket, block, keys, counts)``, packed."""

    def task(batches):
        for b in batches:
            for lo in range(b.num_rows):
                row = b.slice(lo, 1).to_pylist()[0]
                block, out = Block(row), []
                grams, counts = block.grams()
                order, first = _gram_order(grams, buckets)
                grams, counts = grams[order], counts[order]
                for k in np.flatnonzero(np.diff(first)).tolist():
                    at = slice(first[k], first[k + 1])
                    out.append((GRAMS, k, row["block"], _packed(np.diff(grams[at], prepend=0)), _packed(counts[at])))
                words, number, piece = block.words()
                counts = np.bincount(number, weights=block.training[piece], minlength=len(words)).astype(np.int64)
                order, first = _word_order(words, buckets)
                for k in np.flatnonzero(np.diff(first)).tolist():
                    at = order[first[k] : first[k + 1]]
                    out.append((WORDS, k, row["block"], _packed(b"".join(words.take(pa.array(at)).to_pylist())), _packed(counts[at])))
                types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                names = ["kind", "bucket", "block", "keys", "counts"]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return task


# -- sums and weights --------------------------------------------------------


def _gram_sums(table: pa.Table) -> pa.Table:
    """Distinct grams of a bucket with their training counts and their last two context bytes."""
    keys = [np.cumsum(_unpacked(k, np.int64)) for k in table["keys"].to_pylist()]
    counts = [_unpacked(c, np.int64) for c in table["counts"].to_pylist()]
    gram, n = summed(np.concatenate(keys), np.concatenate(counts))
    return pa.table({"pair": pa.array((gram >> 8 & 0xFFFF).astype(np.int32)), "gram": gram, "n": n})


def _split_words(payload: np.ndarray) -> pa.Array:
    return spaced(payload, np.concatenate(([0], np.flatnonzero(payload == SPACE) + 1)))


def _word_sums(table: pa.Table) -> pa.Table:
    """Training counts of a bucket's words, returned to every block that asked; block -1: the number of known words, and their sum."""
    lists = [_split_words(_unpacked(k)) for k in table["keys"].to_pylist()]
    counts = np.concatenate([_unpacked(c, np.int64) for c in table["counts"].to_pylist()])
    number = pa.concat_arrays(lists).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    total = np.zeros(int(number.max()) + 1, dtype=np.int64)
    np.add.at(total, number, counts)
    ends = np.cumsum([len(w) for w in lists])
    answers = [_packed(total[number[e - len(w) : e]]) for w, e in zip(lists, ends.tolist())]
    bucket = table["bucket"][0].as_py()
    return pa.table({
        "kind": pa.array([WORDS] * (len(lists) + 1), pa.int32()),
        "bucket": pa.array([bucket] * (len(lists) + 1), pa.int32()),
        "block": pa.array([*table["block"].to_pylist(), -1], pa.int64()),
        "answers": pa.array([*answers, None], pa.binary()),
        "known": pa.array([0] * len(lists) + [int((total > 0).sum())], pa.int64()),
        "total": pa.array([0] * len(lists) + [int(total.sum())], pa.int64()),
    })


def weigh_subtrees(gram: np.ndarray, n: np.ndarray):
    """Weight the subtrees below the last two context bytes.

    The grams of a pair of bytes must all be there. Returns each gram's
    probabilities of its eight decisions, mixed down to depth ``UPPER``, and the
    nodes of that depth: ``(pair, node, zeros, ones, log weighted probability)``.
    """
    y = gram & 0xFF
    mixed_down = np.empty((len(gram), 8))
    nodes = []
    for bit in range(8):
        node = 1 << bit | y >> (8 - bit)
        one = (y >> (7 - bit) & 1).astype(bool)
        probability = child = None
        for depth in range(DEPTH, UPPER - 1, -1):
            keys, first, at = np.unique((gram >> 8 & (1 << 8 * depth) - 1) << 8 | node, return_index=True, return_inverse=True)
            zeros = np.bincount(at, weights=np.where(one, 0, n), minlength=len(keys))
            ones = np.bincount(at, weights=np.where(one, n, 0), minlength=len(keys))
            estimate = log_kt(zeros, ones)
            here = ((np.where(one, ones[at], zeros[at]) + 0.5) / (zeros + ones + 1)[at])
            if child is None:
                weighted, probability = estimate, here
            else:
                below = np.bincount(at[child[0]], weights=child[1], minlength=len(keys))
                weighted, share = mixed(estimate, below)
                probability = share[at] * here + (1 - share[at]) * probability
            child = (first, weighted)
        mixed_down[:, bit] = probability
        nodes.append((keys >> 8, keys & 0xFF, zeros, ones, weighted))
    return mixed_down, [np.concatenate(c) for c in zip(*nodes)]


def _subtree_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(pair, gram, n)`` sorted by pair to rows of grams and rows of nodes."""

    def done(gram, n):
        mixed_down, (pair, node, zeros, ones, weighted) = weigh_subtrees(gram, n)
        k, m = len(gram), len(pair)
        fill = lambda a, t, before, after: pa.concat_arrays([pa.nulls(before, t), pa.array(a, t), pa.nulls(after, t)])
        offsets = np.concatenate([np.arange(k + 1) * 8, np.full(m, 8 * k)])
        return pa.RecordBatch.from_arrays(
            [
                fill(gram, pa.int64(), 0, m),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(mixed_down.reshape(-1))),
                fill(pair & 0xFF, pa.int32(), k, 0),
                fill(node, pa.int32(), k, 0),
                fill(zeros, pa.float64(), k, 0),
                fill(ones, pa.float64(), k, 0),
                fill(weighted, pa.float64(), k, 0),
            ],
            ["gram", "mixed", "last", "node", "zeros", "ones", "weighted"],
        )

    grams, counts, pairs, size = [], [], [], 0

    def gathered(upto):
        """What is complete (pairs before ``upto``; all if None) leaves, the rest stays."""
        nonlocal grams, counts, pairs, size
        g, c, p = np.concatenate(grams), np.concatenate(counts), np.concatenate(pairs)
        cut = len(p) if upto is None else int(np.searchsorted(p, upto))
        grams, counts, pairs, size = [g[cut:]], [c[cut:]], [p[cut:]], len(g) - cut
        return (g[:cut], c[:cut]) if cut else None

    for b in batches:
        if not b.num_rows:
            continue
        pairs.append(b.column("pair").to_numpy())
        grams.append(b.column("gram").to_numpy())
        counts.append(b.column("n").to_numpy())
        size += b.num_rows
        if size >= TOGETHER and (whole := gathered(pairs[-1][-1])) is not None:
            yield done(*whole)
    if size and (whole := gathered(None)) is not None:
        yield done(*whole)


class Upper:
    """The two upper depths: estimates and shares by (last byte, node), and by node."""

    def __init__(self, rows):
        zeros, ones, below = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
        for r in rows:
            zeros[r.last, r.node], ones[r.last, r.node], below[r.last, r.node] = r.zeros, r.ones, r.weighted
        weighted, self.share1 = mixed(log_kt(zeros, ones), below)
        self.kt1 = np.stack([zeros + 0.5, ones + 0.5]) / (zeros + ones + 1)
        zeros, ones = zeros.sum(axis=0), ones.sum(axis=0)
        _, self.share0 = mixed(log_kt(zeros, ones), weighted.sum(axis=0))
        self.kt0 = np.stack([zeros + 0.5, ones + 0.5]) / (zeros + ones + 1)

    def log10(self, gram: np.ndarray, mixed_down: np.ndarray) -> np.ndarray:
        """log10 of the probability of each gram's byte in its context."""
        y, last = gram & 0xFF, gram >> 8 & 0xFF
        total = np.zeros(len(gram))
        for bit in range(8):
            node, one = 1 << bit | y >> (8 - bit), y >> (7 - bit) & 1
            s1, s0 = self.share1[last, node], self.share0[node]
            p = s1 * self.kt1[one, last, node] + (1 - s1) * mixed_down[:, bit]
            total += np.log10(s0 * self.kt0[one, node] + (1 - s0) * p)
        return total


def _probability_task(upper, buckets: int):
    def task(batches):
        for b in batches:
            gram = b.column("gram").to_numpy()
            mixed_down = b.column("mixed").flatten().to_numpy().reshape(-1, 8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_bucket(gram, buckets), pa.int32()), pa.array(gram), pa.array(upper.value.log10(gram, mixed_down))], ["bucket", "gram", "logp"]
            )

    return task


def _gram_answers(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Log probabilities of a bucket's grams to every block that asked, in its order."""
    gram, logp = known["gram"].to_numpy(), known["logp"].to_numpy()
    order = np.argsort(gram)
    gram, logp = gram[order], logp[order]
    answers = [_packed(logp[np.searchsorted(gram, np.cumsum(_unpacked(k, np.int64)))]) for k in asked["keys"].to_pylist()]
    return pa.table({
        "kind": pa.array([GRAMS] * len(answers), pa.int32()),
        "bucket": asked["bucket"].cast(pa.int32()),
        "block": asked["block"],
        "answers": pa.array(answers, pa.binary()),
    })


# -- scores ------------------------------------------------------------------


def _score_block(total: int, distinct: int, ends: int, buckets: int):
    """Cogrouped block and answers to ``(row, id, training, n_tokens, n_known, base_score, score)`` of each piece."""
    floor = total + 0.5 * (distinct + 1)

    def scores(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        row = blocks.slice(0, 1).to_pylist()[0]
        block, k = Block(row), len(row["rows"])
        found = {kind: [] for kind in (GRAMS, WORDS)}
        for kind, bucket, values in sorted(zip(*[answers[c].to_pylist() for c in ("kind", "bucket", "answers")]), key=lambda x: x[:2]):
            found[kind].append(_unpacked(values, np.float64 if kind == GRAMS else np.int64))
        grams, _ = block.grams()
        logp = np.empty(len(grams))
        if len(grams):
            logp[_gram_order(grams, buckets)[0]] = np.concatenate(found[GRAMS])
        score = np.zeros(k)
        for gram, piece in block.slices():
            own, at = np.unique(gram, return_inverse=True)
            score += np.bincount(piece, weights=logp[np.searchsorted(grams, own)][at], minlength=k)
        words, number, piece = block.words()
        counts = np.zeros(len(words), dtype=np.int64)
        if len(words):
            counts[_word_order(words, buckets)[0]] = np.concatenate(found[WORDS])
        last = block.last().astype(np.int64)
        base = np.bincount(piece, weights=np.log10((counts + 0.5) / floor)[number], minlength=k) if len(words) else np.zeros(k)
        known = np.bincount(piece, weights=(counts > 0)[number], minlength=k) if len(words) else np.zeros(k)
        return pa.table({
            "row": pa.array(row["rows"], pa.int64()),
            "id": blocks["ids"].combine_chunks().flatten(),
            "training": pa.array(row["training"], pa.bool_()),
            "n_tokens": pa.array(np.bincount(piece, minlength=k) + last, pa.int64()),
            "n_known": pa.array(known.astype(np.int64) + last * (ends > 0), pa.int64()),
            "base_score": pa.array(base + last * math.log10((ends + 0.5) / floor)),
            "score": pa.array(score),
        })

    return scores


def score_texts(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: its id, ``training`` and the scores of its whole text.

    ``training`` marks the rows to learn from. Columns: id, training, n_tokens
    (words and one end), n_known (tokens that training texts hold), train_tokens,
    base_score (unigrams of tokens), score (log10 probability of the coded text).

    * null, empty and blank texts have the end as their only token;
    * a null ``training`` counts as true; rows with null or repeated ids stay rows of
      their own; texts may have any length; other columns are ignored;
    * no training text: every decision has probability 1/2, base_score is 0;
    * an empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(training, F.lit(True)).alias("training"), F.col(text_col).alias("text"))
    blocks = keep(
        texts.mapInArrow(
            _blocks_task,
            f"block long, rows array<long>, ids array<{kind}>, training array<boolean>, lengths array<long>, size long, bytes binary",
        ),
        "blocks",
    )
    buckets = buckets or max(64, -(-(blocks.agg(F.sum("size")).first()[0] or 0) // (BLOCK // 2)))
    asked = keep(blocks.mapInArrow(_asked_task(buckets), "kind int, bucket int, block long, keys binary, counts binary"), "asked")
    answer = "kind int, bucket int, block long, answers binary"

    word_answers = keep(asked.where(F.col("kind") == WORDS).groupBy("bucket").applyInArrow(_word_sums, f"{answer}, known long, total long"), "word-answers")
    totals = word_answers.agg(F.coalesce(F.sum("known"), F.lit(0)).alias("known"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
    # every training text has one end; its first piece stands after line feeds only
    ends = texts.where("training").count()

    asked_grams = asked.where(F.col("kind") == GRAMS)
    sums = asked_grams.groupBy("bucket").applyInArrow(_gram_sums, "pair int, gram long, n long")
    subtrees = keep(
        sums.repartition("pair").sortWithinPartitions("pair").mapInArrow(
            _subtree_task, "gram long, mixed array<double>, last int, node int, zeros double, ones double, weighted double"
        ),
        "subtrees",
    )
    tops = subtrees.where("last IS NOT NULL").groupBy("last", "node").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted"))
    upper = docs.sparkSession.sparkContext.broadcast(Upper(tops.collect()))
    known = subtrees.where("gram IS NOT NULL").select("gram", "mixed").mapInArrow(_probability_task(upper, buckets), "bucket int, gram long, logp double")
    gram_answers = asked_grams.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(_gram_answers, answer)

    answers = gram_answers.unionByName(word_answers.where("block >= 0").select("kind", "bucket", "block", "answers"))
    distinct, total = totals.known + (ends > 0), totals.total + ends
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score_block(total, distinct, ends, buckets),
        f"row long, id {kind}, training boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.groupBy("row").agg(
        F.first("id").alias(id_col),
        F.first("training").alias("training"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        F.sum("base_score").alias("base_score"),
        F.sum("score").alias("score"),
    ).drop("row")

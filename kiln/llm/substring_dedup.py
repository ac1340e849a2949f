"""Substring deduplication with a compressed FM-index per shard.

A window is ``window`` consecutive words. Each word covered by a window whose
word sequence also starts in a document of a smaller id is removed.

1. Segments. Every window has an anchor, the smallest hash of its ``GRAM``-word
   grams; consecutive windows with one anchor form a segment. Equal windows have
   equal anchors wherever they stand, so an anchor's windows can be judged apart
   from all others. Segments of equal words are pooled: (smallest id, largest
   id, place of the first) -- all copies of a passage are one row. Equality is that
   of 128-bit digests of the words' bytes.
2. Shards. Only segments whose anchor occurs in two documents go on (an exact
   test: no other can share a window). The words of the pooled segments are read
   from their first documents and sent to shards of bounded size by anchor. A
   shard's FM-index streams its segments through backward search and reports the
   smallest owner of every window.
3. Hot anchors. An anchor with more pooled words than a shard is to hold (the
   edges of a passage shared by very many documents) is split: its windows are pooled by
   their own digest, those in two documents are indexed as texts of their own in
   shards by window, so one anchor spreads over all shards. There the pooling has
   decided already and the index confirms it.
4. The owners join back to the segments (AQE splits hot ones), and each document
   loses the words of windows that a smaller id owns.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import chunks, keep
from kiln.llm.fm_index import window_owners
from kiln.llm.words import digests, prefix_sums, span_hash, words_of

GRAM = 8
SHARD = 200_000
LONGEST = 64  # windows in a segment


def _least_over(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive values (shorter by n - 1), by doubling."""
    span, least = 1, x
    while span * 2 <= n:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    rest = n - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def segments(hashes: np.ndarray, first: np.ndarray, window: int):
    """Segments of a batch of texts: ``(text, first word of the batch, start word in the text, windows, anchor)``.

    ``hashes`` are the word hashes of all texts, ``first`` where each text's begin.
    """
    gram = min(GRAM, window)
    n = len(hashes)
    if n < window:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    total = prefix_sums(hashes)
    at = np.arange(n - gram + 1)
    anchors = _least_over(span_hash(total, at, at + gram), window - gram + 1)
    text = np.searchsorted(first, np.arange(len(anchors)), side="right") - 1
    valid = np.arange(len(anchors)) + window <= first[text + 1]
    at = np.flatnonzero(valid)
    if not len(at):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    anchor, text = anchors[at], text[at]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1] + 1)))
    run = np.flatnonzero(new)
    into = np.arange(len(at)) - run[np.cumsum(new) - 1]
    begin = np.flatnonzero(into % LONGEST == 0)
    size = np.diff(np.concatenate([begin, [len(at)]]))
    start = at[begin]
    return text[begin], start, start - first[text[begin]], size, anchor[begin].view(np.int64)


def _segment_task(window: int):
    """Texts to segment rows."""

    def task(batches):
        for b in batches:
            ids, keys, texts = b.column("id"), b.column("row"), b.column("text")
            for lo, hi in chunks(texts):
                w = words_of(texts.slice(lo, hi - lo))
                text, word, start, size, anchor = segments(w.hashes(), w.first, window)
                if len(text):
                    at = pa.array(text + lo)
                    body = pa.array(digests(w, word, word + size + window - 1), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), keys.take(at), pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(anchor), body],
                        ["id", "row", "start", "size", "anchor", "body"],
                    )

    return task


def _words_task(window: int):
    """Documents with the places of pooled segments to the segments' words; of hot ones the window hashes too."""

    def task(batches):
        for b in batches:
            out = []
            for text, places in zip(b.column("text"), b.column("places").to_pylist()):
                words = text.as_buffer().to_pybytes().split()
                for p in places:
                    at, n = p["start"], p["size"]
                    out.append((p["anchor"], p["body"], n, p["least"], p["most"], p["hot"], b" ".join(words[at : at + n + window - 1]).decode()))
            if not out:
                continue
            cols = [pa.array(x) for x in zip(*out)]
            w = words_of(cols[6])
            sizes, hot = cols[2].to_numpy().astype(np.int64), [r[5] for r in out]
            at = np.concatenate([w.first[i] + np.arange(n) for i, n in enumerate(sizes) if hot[i]] or [np.zeros(0, np.int64)])
            keys = iter(digests(w, at, at + window))
            hashes = [list(islice(keys, int(n))) if h else None for n, h in zip(sizes, hot)]
            names = ["anchor", "body", "size", "least", "most", "hot", "words"]
            types = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([*[c.cast(t) for c, t in zip(cols, types)], pa.array(hashes, pa.list_(pa.binary()))], [*names, "windows"])

    return task


def _index_shard(window: int):
    """One shard's segments to runs of windows with one owner, where another document has a smaller id."""

    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        words = [w.split(" ") for w in pdf["words"]]
        sizes = [len(w) for w in words]
        codes, names = pd.factorize(np.array([x for w in words for x in w], dtype=object))
        texts = np.split(codes + 1, np.cumsum(sizes)[:-1])
        owners = window_owners(texts, pdf["least"].to_numpy(dtype=np.int64), len(names) + 1, window)
        row, lo, hi, owner = [], [], [], []
        for i, (found, most) in enumerate(zip(owners, pdf["most"].tolist())):
            cut = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(found)]):
                if found[a] < most:
                    row.append(i)
                    lo.append(a)
                    hi.append(b)
                    owner.append(int(found[a]))
        return pd.DataFrame({"anchor": pdf["anchor"].to_numpy()[row], "body": pdf["body"].to_numpy()[row], "size": pdf["size"].to_numpy()[row], "lo": lo, "hi": hi, "owner": owner})

    return task


RUNS = "anchor long, body binary, size int, lo int, hi int, owner long"


def _by_shard(pieces: DataFrame, key: str, words: int, window: int) -> DataFrame:
    """Runs of the pieces, indexed in shards of about ``SHARD`` words."""
    shards = max(1, -(-words // SHARD))
    routed = pieces.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)))
    return routed.groupBy("shard").applyInPandas(_index_shard(window), RUNS)


def repeated_spans(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of words to remove: ``(id, row, lo, hi)``, may overlap.

    ``row`` is xxhash64 of the text: with the id it tells rows apart.
    """
    d = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    d = d.withColumn("row", F.xxhash64("text"))
    seg = keep(d.mapInArrow(_segment_task(window), "id long, row long, start int, size int, anchor long, body binary"), "segments")
    pooled = seg.groupBy("anchor", "body", "size").agg(
        F.min(F.struct("id", "row", "start")).alias("at"), F.max("id").alias("most")
    )
    shared = (
        pooled.groupBy("anchor")
        .agg(F.min("at.id").alias("lo"), F.max("most").alias("hi"), F.sum(F.col("size") + window - 1).alias("total"))
        .where("lo < hi")
    )
    chosen = keep(
        pooled.join(shared.select("anchor", (F.col("total") > SHARD).alias("hot")), "anchor").select(
            "anchor", "body", "size", F.col("at.id").alias("least"), "most", "hot", F.col("at.row").alias("row"), F.col("at.start").alias("start")
        ),
        "chosen",
    )
    places = chosen.groupBy(F.col("least").alias("id"), "row").agg(
        F.collect_list(F.struct("anchor", "body", "size", "least", "most", "hot", "start")).alias("places")
    )
    # repeated rows (one id, one text) count once
    texts = d.join(places, ["id", "row"]).dropDuplicates(["id", "row"])
    pieces = keep(
        texts.select("text", "places").mapInArrow(
            _words_task(window),
            "anchor long, body binary, size int, least long, most long, hot boolean, words string, windows array<binary>",
        ),
        "pieces",
    )
    total = {r["hot"]: r["n"] for r in pieces.groupBy("hot").agg(F.sum(F.col("size") + window - 1).alias("n")).collect()}
    cold = _by_shard(pieces.where("NOT hot").drop("windows", "hot"), "anchor", total.get(False, 0), window)
    runs = cold.select("anchor", "body", "size", "lo", "hi", "owner")
    if total.get(True):
        runs = runs.union(_hot_runs(pieces.where("hot"), window))
    found = seg.join(runs, ["anchor", "body", "size"]).where("owner < id")
    return found.select("id", "row", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + window - 1).alias("hi"))


def _hot_runs(pieces: DataFrame, window: int) -> DataFrame:
    """Runs of segments under hot anchors, window by window."""
    each = pieces.select("anchor", "body", "size", "least", "most", F.posexplode("windows").alias("lo", "key"))
    pooled = (
        each.groupBy("anchor", "key")
        .agg(F.min(F.struct("least", "body", "size", "lo")).alias("at"), F.min("least").alias("least"), F.max("most").alias("most"))
        .where("least < most")
    )
    at = pooled.select("anchor", "key", "least", "most", F.col("at.body").alias("body"), F.col("at.size").alias("size"), F.col("at.lo").alias("lo"))
    words = F.array_join(F.slice(F.split("words", " ", -1), F.col("lo") + 1, window), " ")
    texts = at.join(pieces.select("anchor", "body", "size", "words"), ["anchor", "body", "size"]).select(
        "anchor", F.col("key").alias("body"), F.lit(1).alias("size"), "least", "most", words.alias("words")
    )
    texts = keep(texts, "hot-windows")
    n = texts.count() * window
    owned = _by_shard(texts, "body", n, window).select("anchor", F.col("body").alias("key"), "owner")
    return each.join(owned, ["anchor", "key"]).select("anchor", "body", "size", "lo", (F.col("lo") + 1).alias("hi"), "owner")


def _cut_task(batches):
    """``(id, n_words, n_removed, kept_text)`` of texts with their spans."""
    for b in batches:
        total, removed, kept = [], [], []
        for text, spans in zip(b.column("text"), b.column("spans").to_pylist()):
            words = text.as_buffer().to_pybytes().split()
            total.append(len(words))
            if spans:
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(gone, [s["lo"] for s in spans], 1)
                np.add.at(gone, [s["hi"] for s in spans], -1)
                stays = np.cumsum(gone)[:-1] == 0
                words = [w for w, s in zip(words, stays.tolist()) if s]
            removed.append(total[-1] - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["id", "n_words", "n_removed", "kept_text"],
        )


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_words, n_removed, kept_text``.

    ``kept_text``: the kept words joined by one space.
    * a null or empty text has no words; texts shorter than a window lose none;
    * a row with a null id neither loses words nor makes others lose any;
    * rows of one id never make each other lose words; other columns are ignored;
      an empty table gives an empty table.
    """
    spans = repeated_spans(docs, window, id_col, text_col)
    # neighbouring windows overlap: one row per document, as long as the document at most
    spans = spans.distinct().groupBy("id", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("row", F.xxhash64("text"))
    joined = d.join(spans, ["id", "row"], "left").select("id", "text", "spans")
    out = joined.mapInArrow(_cut_task, "id long, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("id", id_col)

"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprints within the radius are found without false negatives: every bit
position gets a non-zero vector of radius + 1 bits, and every non-zero vector v
of that length a mask of the positions whose vectors have an odd product with
v. The positions in which two fingerprints differ span at most ``radius``
dimensions, so some v is orthogonal to all of them: its mask hides every
difference and the pair collides in that table (2**(r+1) - 1 tables in all).

Large buckets: equal fingerprints are one row from the start; a bucket with
more than ``SMALL`` fingerprints is covered again by the same construction over
the bits its mask leaves free. What is left has at most about 14 free bits, so
a bucket never holds more than 2**14 fingerprints whatever the input. There,
links go through hubs: y links to the owner of hub z if z is within 2 bits of y
and within 1 of its owner, which yields a star per hub instead of all pairs and
connects exactly what pairs of up to 3 bits connect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import keep
from kiln.llm.components import connected_components

U = np.uint64
SMALL = 512
SHORT = 8


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over word shingles (repeats count); unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), 1 << 15):
        block = b"".join([digest(joined[s:e], 42) for s, e in zip(starts[at : at + (1 << 15)], stops[at : at + (1 << 15)])])
        bits = np.unpackbits(np.frombuffer(block, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def covering_masks(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions; any ``radius`` positions are hidden by one."""
    vectors = (1 << (radius + 1)) - 1
    given = {b: 1 + i * 7 % vectors for i, b in enumerate(bits)}  # 7 and 15 are coprime: balanced
    return [
        sum(1 << b for b, w in given.items() if (v & w).bit_count() % 2) for v in range(1, vectors + 1)
    ]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _popcount_at_most(x: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(x) <= radius


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component, by min-label rounds with pointer jumping."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def bucket_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (index, index of its component's first) of one bucket's distinct fingerprints."""
    n = len(fps)
    if n <= 2 * SMALL:
        a, b = np.nonzero(_popcount_at_most(fps[:, None] ^ fps[None, :], radius))
    else:
        a, b = _hub_links(fps, radius)
    label = _components(n, a, b)
    found = np.flatnonzero(label != np.arange(n))
    return found, label[found]


def _hub_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    free = int(np.bitwise_or.reduce(fps ^ fps[0]))
    flips = [U(0), *(U(1 << b) for b in range(64) if free >> b & 1)]
    near, far = radius // 2, radius - radius // 2
    index = np.arange(len(fps))

    def ball(r: int) -> list[np.uint64]:
        found = {0}
        for _ in range(r):
            found |= {x ^ int(f) for x in found for f in flips}
        return [U(x) for x in sorted(found)]

    hubs = np.concatenate([fps ^ z for z in ball(near)])
    owner = np.tile(index, len(hubs) // len(fps))
    order = np.argsort(hubs, kind="stable")
    hubs, first = np.unique(hubs[order], return_index=True)
    owner = owner[order][first]
    a, b = [], []
    for z in ball(far):
        at = np.searchsorted(hubs, fps ^ z)
        at[at == len(hubs)] = 0
        hit = hubs[at] == fps ^ z
        hit &= owner[at] != index
        a.append(index[hit])
        b.append(owner[at[hit]])
    return np.concatenate(a), np.concatenate(b)


def _run_links(key: np.ndarray, fps: np.ndarray, reps: np.ndarray, radius: int):
    """Links (rep, rep) of rows sorted by bucket; ``key`` numbers the buckets."""
    out = []
    bounds = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    sizes = np.diff(bounds)
    size = np.repeat(sizes, sizes)
    for lag in range(1, SHORT):
        ok = (key[lag:] == key[:-lag]) & (size[lag:] <= SHORT)
        ok &= _popcount_at_most(fps[lag:] ^ fps[:-lag], radius)
        out.append((reps[lag:][ok], reps[:-lag][ok]))
    for at in np.flatnonzero(sizes > SHORT):
        lo, hi = bounds[at], bounds[at + 1]
        a, b = bucket_links(fps[lo:hi], radius)
        out.append((reps[lo:hi][a], reps[lo:hi][b]))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _link_task(radius: int, id_type: pa.DataType):
    def task(batches) -> Iterator[pa.RecordBatch]:
        held = None

        def done(k, f, r):
            if len(k) > 1:
                a, b = _run_links(k, f, r, radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a, id_type), pa.array(b, id_type)], ["a", "b"])

        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "sub", "key", "fp", "rep")]
            cols[3] = cols[3].view(U)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            same = np.ones(len(cols[0]), dtype=bool)
            for c in cols[:3]:
                same[1:] &= c[1:] == c[:-1]
            same[0] = False
            run = np.cumsum(~same)
            last = int(np.searchsorted(run, run[-1]))  # the last bucket may go on in the next batch
            yield from done(run[:last], cols[3][:last], cols[4][:last])
            held = [c[last:] for c in cols]
        if held is not None:
            yield from done(np.zeros(len(held[0]), dtype=np.int64), held[3], held[4])

    return task


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id, fp)`` of every row with an id (a struct, or else a long)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    id_type = id_type if id_type.startswith("struct") else "long"

    def task(batches):
        for batch in batches:
            texts = batch.column("text")
            fps = [_signed(fingerprint(texts[i].as_py(), shingle)) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps, pa.int64())], ["id", "fp"])

    return (
        docs.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).cast(id_type).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(task, f"id {id_type}, fp long")
    )


def fingerprint_links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``(a, b)`` that connect what pairs within ``radius`` bits connect.

    ``distinct`` has one row ``(fp, rep)`` per fingerprint.
    """
    if not 1 <= radius <= 7:
        raise ValueError("radius: 1 to 7")
    masks = covering_masks(list(range(64)), radius)
    below = [covering_masks([b for b in range(64) if not m >> b & 1], radius) for m in masks]
    lit = lambda m: F.lit(_signed(m))
    rows = distinct.select(
        "fp",
        "rep",
        F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(lit(m)).alias("key")) for i, m in enumerate(masks)])).alias("x"),
    ).select("fp", "rep", "x.t", "x.key")
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    again = F.element_at(
        F.array(*[
            F.array(*[F.struct(F.lit(j).alias("sub"), lit(m | s).alias("mask")) for j, s in enumerate(subs)])
            for m, subs in zip(masks, below)
        ]),
        F.col("t") + 1,
    )
    whole = F.element_at(
        F.array(*[F.array(F.struct(F.lit(-1).alias("sub"), lit(m).alias("mask"))) for m in masks]), F.col("t") + 1
    )
    shared = (
        rows.join(sizes, ["t", "key"])
        .select("t", "fp", "rep", F.explode(F.when(F.col("n") > SMALL, again).otherwise(whole)).alias("x"))
        .select("t", "x.sub", F.col("fp").bitwiseAND(F.col("x.mask")).alias("key"), "fp", "rep")
    )
    return (
        shared.repartition("t", "sub", "key")
        .sortWithinPartitions("t", "sub", "key")
        .mapInArrow(_link_task(radius, pa.int64()), "a long, b long")
        .distinct()
    )


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """One row per input row with an id: ``id, fingerprint, component_id``.

    * fewer words than ``shingle``: the whole sequence is the one shingle; no word
      or null text: fingerprint zero, which links like any other.
    * rows with a null id are left out (they can't name or join a component);
      repeated rows give repeated results; an empty table gives an empty table.
    * other columns of ``docs`` are ignored.
    """
    fps = keep(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = keep(fps.groupBy("fp").agg(F.min("id").alias("rep")), "distinct")
    component = connected_components(fingerprint_links(distinct, radius))
    named = distinct.join(component, distinct["rep"] == component["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")
    )
    return fps.join(named, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )

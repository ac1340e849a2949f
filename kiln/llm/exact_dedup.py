"""Exact deduplication with Patricia-trie owners.

Texts are equal when they are the same after every run of blanks became one
space. Compressed radix tries hold the full bytes of the texts, so texts with a
common beginning share its edges; a terminal node holds the smallest identifier
and the number of rows.

1. Each task of the scan inserts its rows into a trie of bounded size, so all
   copies a task sees leave it as one row. When the trie exceeds its budget its
   largest top subtree is spilled: emitted to the shuffle and dropped.
2. The terminals are partitioned by (length, digest). Each task inserts its
   partition in the order of the bytes (Spark's external sort, which spills) into
   a trie. Whatever lies left of the path to the text just inserted is complete
   by then; once the trie exceeds its budget those subtrees are spilled to the
   output and dropped, so a task holds the budget and one text.
3. Owners join back to the rows on (length, digest); AQE splits a hot group. The
   tries compare bytes; the join relies on SHA-256 and the length to name a text.

A group of copies costs the shuffle one text for each task of the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import BLANKS

DEFAULT_BUDGET = 32 << 20


class _Node:
    __slots__ = ("children", "label", "least", "rows")

    def __init__(self, label: bytes):
        self.label, self.children, self.least, self.rows = label, {}, None, 0

    def add(self, ident, rows: int) -> None:
        if ident is not None and (self.least is None or ident < self.least):
            self.least = ident
        self.rows += rows


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class PatriciaTrie:
    """Byte strings to (smallest identifier, number of rows), one edge label per unary path.

    The root is the empty string and may be a terminal itself.
    """

    NODE_BYTES = 200

    def __init__(self) -> None:
        self.root, self.size = _Node(b""), {}

    def insert(self, key: bytes, ident, rows: int = 1) -> None:
        """Add ``rows`` rows of ``key`` whose smallest identifier is ``ident``."""
        node, at, grown = self.root, 0, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                grown += len(child.label) + self.NODE_BYTES
            elif not key.startswith(child.label, at):
                same = _common(child.label, key[at : at + len(child.label)])
                upper = node.children[key[at]] = _Node(child.label[:same])
                child.label = child.label[same:]
                upper.children[child.label[0]] = child
                child = upper
                grown += self.NODE_BYTES
            at += len(child.label)
            node = child
        node.add(ident, rows)
        if key:
            self.size[key[0]] = self.size.get(key[0], 0) + grown

    def bytes(self) -> int:
        return sum(self.size.values())

    def spill(self, first: int | None = None) -> Iterator[tuple[bytes, object, int]]:
        """Terminals of one top subtree (the largest if not named), which is dropped."""
        if first is None:
            first = max(self.size, key=self.size.get)
        self.size.pop(first)
        yield from _terminals(b"", self.root.children.pop(first))

    def spill_before(self, key: bytes) -> Iterator[tuple[bytes, object, int]]:
        """Terminals smaller than ``key``, a text of the trie with none larger; only the path to ``key`` stays."""
        node, at = self.root, 0
        while True:
            if node.rows and at < len(key):
                yield key[:at], node.least, node.rows
                node.least, node.rows = None, 0
            if at == len(key):
                break
            for first in sorted(c for c in node.children if c != key[at]):
                yield from _terminals(key[:at], node.children.pop(first))
            node = node.children[key[at]]
            at += len(node.label)
        # one path is left: one edge
        self.root.children = {key[0]: node} if key else {}
        self.size = {key[0]: len(key) + self.NODE_BYTES} if key else {}
        node.label = key

    def drain(self) -> Iterator[tuple[bytes, object, int]]:
        if self.root.rows:
            yield b"", self.root.least, self.root.rows
            self.root.least, self.root.rows = None, 0
        for first in sorted(self.size):
            yield from self.spill(first)


def _terminals(above: bytes, node: _Node) -> Iterator[tuple[bytes, object, int]]:
    """Terminals of the subtree ``node`` below the bytes ``above``."""
    stack = [(above, node)]
    while stack:
        above, node = stack.pop()
        key = above + node.label
        if node.rows:
            yield key, node.least, node.rows
        stack += [(key, c) for c in node.children.values()]


def normalised(text: Column) -> Column:
    """Every run of blanks as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _rows(terminals, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of at most about 8 MB."""
    out, size = [], 0
    for key, ident, rows in terminals:
        digest = hashlib.sha256(key).digest()
        out.append({"bytes": len(key), "digest": digest, "content": key, "least": ident, "n": rows})
        size += len(key) + 64
        if size > 8 << 20:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = DEFAULT_BUDGET
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    * null text equals the empty text; a text of blanks only equals one space.
    * ``keep_id`` is the smallest non-null id of the group (null if none has one);
      ``kept`` marks the rows that carry it. Rows that repeat an id and its text
      each count in ``group_size`` and are all marked.
    * other columns of ``docs`` are ignored; an empty table gives an empty table.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    id_type = docs.schema[id_col].dataType
    clean = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("content"))
    rows = clean.select("id", F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha"))
    out_type = StructType(
        [StructField("bytes", LongType()), StructField("digest", BinaryType()), StructField("content", BinaryType()),
         StructField("least", id_type), StructField("n", LongType())]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out_type])
    owner_type = StructType([f for f in out_type if f.name != "content"])

    def collect_task(batches):
        trie = PatriciaTrie()

        def terminals():
            for batch in batches:
                ids, texts = batch.column("id").to_pylist(), batch.column("content")
                for i, ident in enumerate(ids):
                    trie.insert(texts[i].as_buffer().to_pybytes(), ident)
                    if trie.bytes() > budget:
                        while trie.bytes() > budget // 2:
                            yield from trie.spill()
            yield from trie.drain()

        yield from _rows(terminals(), arrow)

    def merge_task(batches):
        trie = PatriciaTrie()

        def terminals():
            for batch in batches:
                texts, ids, counts = batch.column("content"), batch.column("least").to_pylist(), batch.column("n").to_pylist()
                for i, ident in enumerate(ids):
                    key = texts[i].as_buffer().to_pybytes()
                    trie.insert(key, ident, counts[i])
                    if trie.bytes() > budget:
                        yield from trie.spill_before(key)
            yield from trie.drain()

        for batch in _rows(terminals(), arrow):
            yield batch.drop_columns(["content"])

    terminals = clean.mapInArrow(collect_task, out_type)
    owners = (
        terminals.repartition("bytes", "digest").sortWithinPartitions("content").mapInArrow(merge_task, owner_type)
        .select("bytes", F.lower(F.hex("digest")).alias("sha"), F.col("least").alias("keep_id"), F.col("n").alias("group_size"))
    )
    return rows.join(owners, ["bytes", "sha"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )

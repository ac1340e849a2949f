"""Helpers shared by the pipeline operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.session import scratch_path

#: Word characters are everything but these six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor; only the columns
    a later step reads are scanned again.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chunks(col: pa.Array, max_bytes: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column holding at most ``max_bytes`` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > max_bytes:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def compact(col: pa.Array) -> pa.Array:
    """A text column (null: empty) as large strings of their own; kernels that change case misread casts of slices."""
    return pc.fill_null(col.take(pa.array(range(len(col)), pa.int64())), "").cast(pa.large_string())

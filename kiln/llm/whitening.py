"""Whitening of embeddings by the exact spectrum of their integer scatter.

Entries become integers, so the scatter ``n * sum(x x') - S S'`` (``n**2`` times
the covariance) is an integer matrix, known exactly.

1. Sums. Tasks sum ``y`` and ``y y'`` of their rows without rounding (``y`` is
   ``x`` without its offset; products of 18-bit limbs stay below 2**53 in matrix
   products of doubles); Spark adds the partial sums by (row, column).
   What reaches the driver has ``dim**2`` numbers, whatever the number of rows.
2. Spectrum. The characteristic polynomial modulo many primes (a Spark task per
   share of the primes), Chinese remaindering, isolation of the largest roots,
   null vectors by inverse iteration: ``charpoly``.
3. Rows are projected on the components, written, and their covariance measured
   in two more passes (means, then centred products).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import charpoly
from kiln.llm.common import keep

SCALE, OFFSET = 1024, 100_000
LIMB = 18
ROWS = 1 << 14  # of a matrix product: 2 * LIMB + 14 bits and a sign


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` vectors: per-dimension sums, and the leading components.

    ``eigenvalues`` are those of the covariance (divisor n), ``explained`` their
    shares of its trace (None without variance).
    """

    n: int
    sums: list[int]
    eigenvalues: list[float]
    explained: list[float | None]
    components: list[list[float]]


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, x)``: ``floor(1024 * entry) + 100000`` of vectors without null or non-finite entries."""
    e = F.col("v").cast("array<double>")
    bad = F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
        .where(F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)))
        .select("id", F.transform(e, lambda c: F.floor(c * SCALE).cast("long") + OFFSET).alias("x"))
    )


def _matrix(col: pa.ListArray) -> np.ndarray:
    """Rows of equally long lists as a matrix of longs."""
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(col), -1)


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y' y`` of a matrix of longs as Python integers."""
    limbs, rest = [], y
    while True:
        low = rest & ((1 << LIMB) - 1)
        rest = rest >> LIMB
        if not (rest + (low >> (LIMB - 1))).any():  # what is left is a sign
            limbs.append((low - ((low >> (LIMB - 1)) << LIMB)).astype(np.float64))
            break
        limbs.append(low.astype(np.float64))
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for lo in range(0, len(y), ROWS):
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                part = (a[lo : lo + ROWS].T @ b[lo : lo + ROWS]).astype(np.int64).astype(object)
                total = total + part * (1 << LIMB * (i + j))
    return total


def _sums_task(dim: int):
    """Exact sums of a task's rows: ``(i, j, value)`` with ``i <= j``; ``i = -1`` for the sums of a dimension."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((dim, dim), dtype=object), np.zeros(dim, dtype=object)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                y = _matrix(b.column(0).slice(lo, ROWS)) - OFFSET
                products = products + exact_products(y)
                # halves of 32 bits: their sums over a block stay exact
                sums = sums + (y >> 32).sum(axis=0).astype(object) * (1 << 32) + (y & 0xFFFFFFFF).sum(axis=0).astype(object)
        i, j = np.triu_indices(dim)
        values = [Decimal(int(v)) for v in [*products[i, j], *sums]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([i, np.full(dim, -1)]), pa.int32()),
                pa.array(np.concatenate([j, np.arange(dim)]), pa.int32()),
                pa.array(values, pa.decimal128(38, 0)),
            ],
            ["i", "j", "value"],
        )

    return task


def exact_scatter(x: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """``n``, the sums of x per dimension, and ``n * sum(x x') - S S'`` of the rows ``(id, x)``."""
    parts = x.select("x").mapInArrow(_sums_task(dim), "i int, j int, value decimal(38,0)")
    rows = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    n = x.count()
    sums, m = [0] * dim, [[0] * dim for _ in range(dim)]
    for r in rows:
        if r.i < 0:
            sums[r.j] = int(r.value)
    for r in rows:
        if r.i >= 0:
            m[r.i][r.j] = m[r.j][r.i] = n * int(r.value) - sums[r.i] * sums[r.j]
    return n, [s + n * OFFSET for s in sums], m


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Exact coefficients of ``det(x - m)``, lowest first; the primes are shared out over the cluster."""
    need, product, chosen = 2 * charpoly.coefficient_bound(m), 1, []
    for p in charpoly.primes():
        chosen.append(p)
        product *= p
        if product > need:
            break

    def task(batches):
        for b in batches:
            ps = b.column(0).to_pylist()
            found = [charpoly.char_poly_mod(charpoly.remainders(m, p), p) for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["p", "residues"])

    jobs = max(1, min(len(chosen), 2 * spark.sparkContext.defaultParallelism))
    shared = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(jobs)
    rows = shared.mapInArrow(task, "p long, residues array<long>").collect()
    return charpoly.from_residues({r.p: r.residues for r in rows})


def fit(x: DataFrame, dim: int, components: int = 8) -> Whitening:
    """Whitening of the rows ``(id, x)`` of ``dim`` dimensions each, with up to ``components`` components."""
    n, sums, m = exact_scatter(x, dim)
    poly = characteristic_polynomial(x.sparkSession, m)
    roots = [charpoly.kth_root(poly, k) for k in range(1, min(components, dim) + 1)]
    values = [Fraction(2 * at + 1, 2 << s) if at else Fraction(0) for at, s in roots]
    trace = sum(m[i][i] for i in range(dim))
    return Whitening(
        n, sums, [float(v / n**2) for v in values], [float(v / trace) if trace else None for v in values], charpoly.null_vectors(m, roots)
    )


def _project_task(model: Whitening):
    """Rows to their deviation and whitened components."""
    mean_of_y = np.array([float(Fraction(s, model.n) - OFFSET) for s in model.sums])
    scaled = np.array([[c / e**0.5 for c in v] if e > 0 else [np.nan] * len(v) for v, e in zip(model.components, model.eigenvalues)])
    sums = np.array(model.sums, dtype=object)

    def deviations(x: np.ndarray) -> list[int]:
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * model.n + max(map(abs, model.sums))
        if most < 1 << 62:
            z = x * model.n - np.array(model.sums, dtype=np.int64)
            if int(np.abs(z).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
                return (z * z).sum(axis=1).tolist()
        return [sum(int(v) ** 2 for v in row) for row in x.astype(object) * model.n - sums]

    def task(batches):
        for b in batches:
            x = _matrix(b.column("x"))
            w = np.einsum("ij,kj->ik", (x - OFFSET).astype(np.float64) - mean_of_y, scaled)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(scaled), pa.int32()), pa.array(w.reshape(-1), from_pandas=True))
            exact = [Decimal(v) if v < 10**38 else None for v in deviations(x)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(exact, pa.decimal128(38, 0)), lists], ["id", "deviation", "whitened"])

    return task


def identity_error(whitened: DataFrame, eigenvalues: list[float]) -> float | None:
    """Largest absolute entry of the covariance of the ``whitened`` lists minus the identity (None: no component varies)."""
    live = [k for k, e in enumerate(eigenvalues) if e > 0]
    if not live:
        return None
    w = [F.col("whitened")[k] for k in live]
    means = whitened.agg(*[F.avg(c) for c in w]).first()
    centred = [c - F.lit(float(mean)) for c, mean in zip(w, means)]
    pairs = [(i, j) for i in range(len(w)) for j in range(i, len(w))]
    found = whitened.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, found))


def whiten(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8
) -> tuple[DataFrame, Whitening | None]:
    """One row per vector and component, and the fitted model.

    Columns: id, component (from 1, by falling eigenvalue), n, deviation
    (``sum((n x - S)**2)``, decimal), whitened, explained, identity_error.

    * Vectors that are null or hold null or non-finite entries are left out.
      If lengths differ, the commonest length (of equal ones the largest) is
      whitened and the others are left out; vectors without entries count as null.
    * Rows with a null or repeated id stay rows of their own; other columns are
      ignored; an id column may have any type.
    * Eigenvalue 0 (constant or fewer rows than components): whitened is null,
      explained 0, or null if no dimension varies; such components are left out of
      identity_error, which is null without any other.
    * No vector left: an empty table, and no model.
    """
    x = keep(integer_vectors(df, id_col, vector_col), "integer-vectors")
    lengths = x.where(F.size("x") > 0).groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("dim")).head(1)
    kind = x.schema["id"].dataType.simpleString()
    if not top:
        return df.sparkSession.createDataFrame(
            [], f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        ), None
    dim = top[0].dim
    x = x.where(F.size("x") == dim)
    model = fit(x, dim, components)
    rows = keep(x.mapInArrow(_project_task(model), f"id {kind}, deviation decimal(38,0), whitened array<double>"), "whitened")
    error = identity_error(rows, model.eigenvalues)
    shares = F.array(*[F.lit(e).cast("double") for e in model.explained])
    out = rows.select("id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        F.col("id").alias(id_col),
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("k")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
    return out, model

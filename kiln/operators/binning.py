"""Binning with fit / transform semantics (F11, F12) and histograms.

Edges are fitted by one global aggregate (min / max, or exact quantiles);
``transform`` is a projection that counts how many interior edges a value
exceeds -- right-closed intervals, as ``cut`` uses, with the lowest edge
included. Edges are built with the same arithmetic as ``numpy.linspace``
(``i * step + start``, last edge = stop).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import exact_quantiles, fit_row

# Labels of the equal-width age bins and of the quartiles.
AGE_LABELS = ["Very Young", "Young", "Middle", "Mature", "Senior"]
QUARTILE_LABELS = ["Q1", "Q2", "Q3", "Q4"]


def linspace(start: float, stop: float, num: int) -> list[float]:
    step = (stop - start) / (num - 1)
    edges = [i * step + start for i in range(num)]
    edges[-1] = stop
    return edges


def _bin_index(x: Column, interior: list[float]) -> Column:
    idx = F.lit(0)
    for e in interior:
        idx = idx + (x > F.lit(e)).cast("int")
    return F.when(x.isNull(), F.lit(None)).otherwise(idx).cast("bigint")


@dataclass
class BinModel:
    input_col: str
    output_col: str
    edges: list[float] | None
    labels: list[str] | None

    def transform(self, df: DataFrame) -> DataFrame:
        if self.edges is None:
            return df.withColumn(self.output_col, F.lit(None).cast("string" if self.labels else "bigint"))
        x = F.col(self.input_col).cast("double")
        lo, hi = self.edges[0], self.edges[-1]
        idx = _bin_index(x, self.edges[1:-1])
        idx = F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), idx)
        if self.labels:
            # A CASE chain: element_at with a NULL index does not give NULL.
            lab = None
            for i, v in enumerate(self.labels):
                lab = F.when(idx == i, F.lit(v)) if lab is None else lab.when(idx == i, F.lit(v))
            idx = lab
        return df.withColumn(self.output_col, idx)


@dataclass
class EqualWidthBinner:
    """``n`` equal-width right-closed bins over [min, max]; the lowest edge
    is moved down by 0.1 % of the range so the minimum falls in bin 0 (F11).
    ``labels`` gives names instead of ordinals 0..n-1."""

    input_col: str
    output_col: str
    n_bins: int = 5
    labels: list[str] | None = None

    def fit(self, df: DataFrame) -> BinModel:
        mn, mx = fit_row(df, [F.min(F.col(self.input_col).cast("double")), F.max(F.col(self.input_col).cast("double"))])
        if mn is None:
            return BinModel(self.input_col, self.output_col, None, self.labels)
        if mn == mx:
            mn = mn - (0.001 * abs(mn) if mn != 0 else 0.001)
            mx = mx + (0.001 * abs(mx) if mx != 0 else 0.001)
            edges = linspace(mn, mx, self.n_bins + 1)
        else:
            edges = linspace(mn, mx, self.n_bins + 1)
            edges[0] -= (mx - mn) * 0.001
        return BinModel(self.input_col, self.output_col, edges, self.labels)


@dataclass
class QuantileBinner:
    """``q`` bins cut at the interpolated quantiles; equal values share a bin
    (F12). With labels, repeated edges are an error; without, they are
    dropped (``duplicates='drop'``)."""

    input_col: str
    output_col: str
    q: int = 4
    labels: list[str] | None = None

    def fit(self, df: DataFrame) -> BinModel:
        probs = [i / self.q for i in range(self.q + 1)]
        edges = exact_quantiles(df, [self.input_col], probs)[self.input_col]
        if edges[0] is None:
            return BinModel(self.input_col, self.output_col, None, self.labels)
        uniq = sorted(set(edges))
        if len(uniq) != len(edges):
            if self.labels:
                raise ValueError(f"bin edges of {self.input_col} are not unique: {edges}")
            edges = uniq
        return BinModel(self.input_col, self.output_col, edges, self.labels)


def fit_quantile_bins(df: DataFrame, cols: list[str], q: int = 4, suffix: str = "_bin") -> list[BinModel]:
    """Quantile bins of several columns from ONE set of quantile passes
    (ordinal labels, repeated edges dropped)."""
    probs = [i / q for i in range(q + 1)]
    edges = exact_quantiles(df, cols, probs)
    models = []
    for c in cols:
        e = edges[c]
        models.append(BinModel(c, f"{c}{suffix}", None if e[0] is None else sorted(set(e)), None))
    return models


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram over [min, max] (A22): ``bin, lower, upper,
    count`` for every non-empty bin; bins are half-open except the last."""
    mn, mx = fit_row(df, [F.min(F.col(col).cast("double")), F.max(F.col(col).cast("double"))])
    if mn is None:
        return df.sparkSession.createDataFrame([], "bin bigint, lower double, upper double, count bigint")
    if mn == mx:
        mn, mx = mn - 0.5, mx + 0.5
    edges = linspace(mn, mx, bins + 1)
    x = F.col(col).cast("double")
    idx = F.lit(0)
    for e in edges[1:-1]:
        idx = idx + (x >= F.lit(e)).cast("int")
    pos = (F.col("bin") + 1).cast("int")
    return (
        df.where(x.isNotNull())
        .groupBy(idx.cast("bigint").alias("bin"))
        .agg(F.count("*").alias("count"))
        .select(
            "bin",
            F.element_at(F.array(*[F.lit(e) for e in edges[:-1]]), pos).alias("lower"),
            F.element_at(F.array(*[F.lit(e) for e in edges[1:]]), pos).alias("upper"),
            "count",
        )
    )

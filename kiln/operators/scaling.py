"""Scalers and capping with fit / transform semantics.

``fit`` is one aggregate over all columns (quantiles through the exact
distributed selection in ``kiln.functions.stats``); the model keeps the
statistics as Python floats and ``transform`` is a projection with literal
constants -- fit on the training part, transform any part (no leakage).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.numeric import nan_to_null
from kiln.functions.stats import exact_quantiles, fit_row
from kiln.session import staged


@dataclass
class ScalerModel:
    cols: list[str]
    center: dict[str, float | None]
    scale: dict[str, float | None]
    suffix: str = ""

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c in self.cols:
            ctr, sc = self.center[c], self.scale[c]
            if ctr is None:
                out[f"{c}{self.suffix}"] = F.lit(None).cast("double")
                continue
            out[f"{c}{self.suffix}"] = (nan_to_null(F.col(c).cast("double")) - F.lit(ctr)) / F.lit(sc)
        return df.withColumns(out)


@dataclass
class StandardScaler:
    """``(x - mean) / population std``; zero std -> scale 1 (F1). NaN is missing, as NULL."""

    cols: list[str]
    suffix: str = ""

    def fit(self, df: DataFrame) -> ScalerModel:
        x = [nan_to_null(F.col(c).cast("double")) for c in self.cols]
        row = fit_row(df, [F.avg(c) for c in x] + [F.stddev_pop(c) for c in x])
        k = len(self.cols)
        center = {c: row[i] for i, c in enumerate(self.cols)}
        scale = {c: (row[k + i] if row[k + i] else 1.0) for i, c in enumerate(self.cols)}
        return ScalerModel(self.cols, center, scale, self.suffix)


@dataclass
class MinMaxScaler:
    """``(x - min) / (max - min)``; zero range -> scale 1 (F2)."""

    cols: list[str]
    suffix: str = ""

    def fit(self, df: DataFrame) -> ScalerModel:
        x = [nan_to_null(F.col(c).cast("double")) for c in self.cols]
        row = fit_row(df, [F.min(c) for c in x] + [F.max(c) for c in x])
        k = len(self.cols)
        center = {c: (float(row[i]) if row[i] is not None else None) for i, c in enumerate(self.cols)}
        scale = {}
        for i, c in enumerate(self.cols):
            lo, hi = row[i], row[k + i]
            scale[c] = float(hi - lo) if lo is not None and hi != lo else 1.0
        return ScalerModel(self.cols, center, scale, self.suffix)


@dataclass
class RobustScaler:
    """``(x - median) / (Q3 - Q1)`` with interpolated quartiles; zero IQR ->
    scale 1 (F3). Spark ML's RobustScaler does not interpolate."""

    cols: list[str]
    suffix: str = ""

    def fit(self, df: DataFrame) -> ScalerModel:
        q = exact_quantiles(df, self.cols, [0.25, 0.5, 0.75])
        center, scale = {}, {}
        for c in self.cols:
            q1, med, q3 = q[c]
            center[c] = med
            scale[c] = (q3 - q1) if med is not None and q3 != q1 else 1.0
        return ScalerModel(self.cols, center, scale, self.suffix)


def apply_scalers(df: DataFrame, cols: list[str]) -> dict[str, DataFrame]:
    """Standard, MinMax and Robust scaling side by side (F4), fitted on one written table."""
    df = staged(df, "scaler-rows")
    return {
        "Standard": StandardScaler(cols).fit(df).transform(df),
        "MinMax": MinMaxScaler(cols).fit(df).transform(df),
        "Robust": RobustScaler(cols).fit(df).transform(df),
    }


@dataclass
class CapperModel:
    cols: list[str]
    lower: dict[str, float | None]
    upper: dict[str, float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        # least / greatest skip NULLs, so a missing value is kept explicitly.
        return df.withColumns(
            {
                c: F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(
                    F.least(F.greatest(F.col(c).cast("double"), F.lit(self.lower[c])), F.lit(self.upper[c]))
                )
                for c in self.cols
            }
        )


@dataclass
class OutlierCapper:
    """Clip each column to its [lower, upper] percentiles."""

    cols: list[str]
    lower_percentile: float = 5.0
    upper_percentile: float = 95.0

    def fit(self, df: DataFrame) -> CapperModel:
        q = exact_quantiles(df, self.cols, [self.lower_percentile / 100.0, self.upper_percentile / 100.0])
        return CapperModel(self.cols, {c: q[c][0] for c in self.cols}, {c: q[c][1] for c in self.cols})

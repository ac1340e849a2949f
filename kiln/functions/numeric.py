"""Numeric column expressions."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(c: Column) -> Column:
    """One notion of missing: NaN becomes NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def without_nan(df: DataFrame) -> DataFrame:
    """``df`` with NULL for NaN in its float and double columns (other columns untouched)."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.nanvl(F.col(f"`{c}`"), F.lit(None).cast(df.schema[c].dataType)) for c in floats}) if floats else df


def log1p(c: Column) -> Column:
    """ln(1 + x)."""
    return F.log1p(c)


def safe_ratio(num: Column, den: Column, eps: float = 1e-9) -> Column:
    """``num / (den + eps)`` (P14); NULL instead of an error on a zero divisor."""
    return F.try_divide(num, den + F.lit(eps))


def price_band(price: Column) -> Column:
    """Right-closed bands (0,25] low, (25,100] medium, (100,500] high,
    (500, inf) premium; 0, negatives and NULL give NULL (P13)."""
    return (
        F.when((price > 0) & (price <= 25), "low")
        .when((price > 25) & (price <= 100), "medium")
        .when((price > 100) & (price <= 500), "high")
        .when(price > 500, "premium")
    )


def polynomial_terms(
    cols: list[str], degree: int = 2, interaction_only: bool = True
) -> list[tuple[str, Column]]:
    """Polynomial feature expressions without bias, named ``<terms>_poly``.

    Names follow the usual feature-name convention: ``a``, ``a b`` for
    products, ``a^2`` for powers, in degree order.
    """
    out: list[tuple[str, Column]] = []
    pick = combinations if interaction_only else combinations_with_replacement
    for d in range(1, degree + 1):
        for combo in pick(cols, d):
            counts: dict[str, int] = {}
            for c in combo:
                counts[c] = counts.get(c, 0) + 1
            name = " ".join(c if n == 1 else f"{c}^{n}" for c, n in counts.items())
            expr = None
            for c in combo:
                expr = F.col(c) if expr is None else expr * F.col(c)
            out.append((f"{name}_poly", expr.cast("double")))
    return out


def interaction(a: str, b: str) -> tuple[str, Column]:
    """``a_b_interaction = a * b``."""
    return f"{a}_{b}_interaction", (F.col(a) * F.col(b)).cast("double")


def unit_norm(cols: list[str]) -> list[Column]:
    """Row-wise L2 normalisation of the listed columns."""
    norm = F.sqrt(sum((F.col(c) * F.col(c) for c in cols), F.lit(0.0)))
    return [F.try_divide(F.col(c), norm).alias(f"{c}_unit") for c in cols]


def box_cox(c: Column, power: float) -> Column:
    """Box-Cox transform with a given power (F5); NULL for values that are not positive."""
    x = F.when(c > 0, c.cast("double"))
    return F.ln(x) if power == 0 else (F.pow(x, F.lit(float(power))) - 1) / F.lit(float(power))


def yeo_johnson(c: Column, power: float) -> Column:
    """Yeo-Johnson transform with a given power (F5), defined for every value."""
    x, rest = c.cast("double"), 2 - power
    up = F.log1p(x) if power == 0 else (F.pow(x + 1, F.lit(float(power))) - 1) / F.lit(float(power))
    down = -F.log1p(-x) if rest == 0 else (F.lit(1.0) - F.pow(F.lit(1.0) - x, F.lit(float(rest)))) / F.lit(float(rest))
    return F.when(x >= 0, up).when(x < 0, down)

"""Composite feature runs (F17, F18, F19) and polynomial / ratio features
(P14-P17, F5).

The input is written once; each fit is an aggregate over the written columns
and each transform a projection. F18 and F19 are pipelines of estimators
(``stages``), which can be fitted on some rows and applied to others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions import numeric
from kiln.operators import stages
from kiln.operators.binning import AGE_LABELS, QUARTILE_LABELS, EqualWidthBinner, QuantileBinner
from kiln.session import staged


def polynomial_features(
    df: DataFrame, cols: Sequence[str], degree: int = 2, interaction_only: bool = True
) -> DataFrame:
    """Append ``<terms>_poly`` columns."""
    return df.withColumns(dict(numeric.polynomial_terms(list(cols), degree, interaction_only)))


def feature_interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Append ``a_b_interaction = a * b`` for each listed pair."""
    return df.withColumns(dict(numeric.interaction(a, b) for a, b in pairs))


def ratio_features(df: DataFrame, eps: float = 1e-9) -> DataFrame:
    """``age_income_ratio = age / (income / 1000 + eps)`` and
    ``credit_age_interaction = credit_score * age`` (P14, P15)."""
    return df.withColumns(
        {
            "age_income_ratio": numeric.safe_ratio(F.col("age"), F.col("income") / 1000.0, eps),
            "credit_age_interaction": (F.col("credit_score") * F.col("age")).cast("double"),
        }
    )


def advanced_features(df: DataFrame) -> DataFrame:
    """polynomial terms of (age, credit_score), labelled equal-width age
    bins, labelled income quartiles, ``income_log`` and the ratio features."""
    df = staged(df, "profile")
    out = polynomial_features(df, ["age", "credit_score"])
    out = EqualWidthBinner("age", "age_bins", 5, AGE_LABELS).fit(df).transform(out)
    out = QuantileBinner("income", "income_quartiles", 4, QUARTILE_LABELS).fit(df).transform(out)
    out = out.withColumn("income_log", numeric.log1p(F.col("income")))
    return ratio_features(out)


def binned_ratio_features(df: DataFrame, cols: Sequence[str] = ("age", "income", "credit_score"), key: str = "customer_id") -> DataFrame:
    """F19 fitted on and applied to all rows of ``df``."""
    x = staged(df.select(key, *cols), "profile")
    pipeline, feats = stages.binned_ratio_pipeline(cols)
    return pipeline.fit(x).transform(x).select(key, *feats)


def mixed_columns(
    df: DataFrame,
    numeric_cols: Sequence[str] = ("age", "income", "credit_score"),
    categorical_col: str = "category",
    key: str = "customer_id",
) -> DataFrame:
    """F18 fitted on and applied to all rows of ``df``."""
    x = staged(df.select(key, *numeric_cols, categorical_col), "profile")
    return stages.mixed_column_pipeline(numeric_cols, categorical_col).fit(x).transform(x).drop(categorical_col)

"""Feature operators as stages of Spark ML pipelines.

``Fitting`` makes an estimator of any operator whose ``fit`` returns a model with
``transform``; ``Columns`` is a transformer of column expressions. The stages
compose with ``pyspark.ml.Pipeline``: ``fit`` learns from the rows given to it
alone, the model transforms any rows, and a cross-validation that fits the
pipeline in each fold refits every stage.

``Prepared`` writes the fitting rows once before a chain of stages is fitted, so
the stages' aggregates scan a table instead of evaluating the input again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.numeric import nan_to_null, safe_ratio
from kiln.operators.binning import EqualWidthBinner, QuantileBinner
from kiln.operators.encoding import OneHotEncoder
from kiln.operators.scaling import OutlierCapper, StandardScaler
from kiln.session import staged


class Columns(Transformer):
    """Adds or replaces columns by expressions; ``make`` gives them (name -> column)."""

    def __init__(self, make: Callable[[], dict[str, Column]]):
        super().__init__()
        self.make = make

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.make())


class Fitted(Model):
    """The model of an operator as a pipeline stage."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


class Fitting(Estimator):
    """An operator with ``fit`` as a pipeline stage."""

    def __init__(self, operator):
        super().__init__()
        self.operator = operator

    def _fit(self, df: DataFrame) -> Fitted:
        return Fitted(self.operator.fit(df))


class Prepared(Estimator):
    """A pipeline whose fitting rows are written once, with the columns it needs."""

    def __init__(self, stages: Sequence[Estimator | Transformer], columns: Sequence[str]):
        super().__init__()
        self.stages, self.columns = list(stages), list(columns)

    def _fit(self, df: DataFrame) -> PipelineModel:
        return Pipeline(stages=self.stages).fit(staged(df.select(*self.columns), "fit-rows"))


def gaps_filled(cols: Sequence[str], value: float = 0.0) -> Columns:
    """NULL and NaN of numeric columns become ``value``; the columns become doubles."""
    return Columns(lambda: {c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(value)) for c in cols})


def ratio_and_product(ratio: tuple[str, str, str], product: tuple[str, str, str], unit: float = 1000.0, eps: float = 1.0) -> Columns:
    """``(name, a, b)``: name = a / (b / unit + eps), and name = a * b."""
    return Columns(
        lambda: {
            ratio[0]: safe_ratio(F.col(ratio[1]), F.col(ratio[2]) / unit, eps),
            product[0]: F.col(product[1]) * F.col(product[2]),
        }
    )


def binned_ratio_stages(
    cols: Sequence[str],
    ratio: tuple[str, str, str],
    product: tuple[str, str, str],
    equal_width: tuple[str, str],
    quantiles: tuple[str, str],
    n_bins: int = 5,
    q: int = 4,
) -> tuple[list[Estimator | Transformer], list[str]]:
    """F19 as stages, and the columns they scale.

    Gaps become 0, a ratio and a product are added, one column is binned by width
    and one by quantiles (``(column, new column)``, ordinals), and all are scaled to
    mean 0 and deviation 1. A value outside the fitted bins has no bin (NULL), and
    stays NULL when scaled.
    """
    feats = [*cols, ratio[0], product[0], equal_width[1], quantiles[1]]
    return [
        gaps_filled(cols),
        ratio_and_product(ratio, product),
        Fitting(EqualWidthBinner(*equal_width, n_bins)),
        Fitting(QuantileBinner(*quantiles, q)),
        Fitting(StandardScaler(feats)),
    ], feats


def binned_ratio_pipeline(cols: Sequence[str] = ("age", "income", "credit_score")) -> tuple[Prepared, list[str]]:
    """The customers' form of F19: estimator and feature columns."""
    age, income, score = cols
    stages, feats = binned_ratio_stages(
        cols, ("age_income_ratio", age, income), ("credit_age_product", score, age), (age, f"{age}_binned"), (income, f"{income}_binned")
    )
    return Prepared(stages, cols), feats


def mixed_column_pipeline(
    numeric_cols: Sequence[str] = ("age", "income", "credit_score"), categorical_col: str = "category", lower: float = 5.0, upper: float = 95.0
) -> Prepared:
    """numeric columns capped at percentiles, then scaled; the categorical column one-hot encoded.

    A category that the fitting rows don't hold becomes zeros.
    """
    num = list(numeric_cols)
    stages = [Fitting(OutlierCapper(num, lower, upper)), Fitting(StandardScaler(num)), Fitting(OneHotEncoder(categorical_col))]
    return Prepared(stages, [*num, categorical_col])


def feature_vector(cols: Sequence[str], fill: float = 0.0) -> list[Transformer]:
    """Columns to one vector column ``features``; gaps become ``fill``."""
    return [gaps_filled(cols, fill), VectorAssembler(inputCols=list(cols), outputCol="features")]

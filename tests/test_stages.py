"""Pipeline stages, inputs evaluated once, digests and NaN as missing."""

import math
import re

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from kiln.operators import models, quality, stages

NAN = float("nan")


def profile(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    rows = [
        (i, float(rng.integers(18, 80)), float(rng.gamma(2, 20_000)) if i % 9 else None, float(rng.normal(650, 80)), "ABCD"[int(rng.integers(4))])
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "customer_id long, age double, income double, credit_score double, category string")


def test_pipelines_learn_from_the_fitting_rows_only(spark):
    df = profile(spark)
    train, test = df.where("customer_id < 300"), df.where("customer_id >= 300")
    for pipeline in (stages.mixed_column_pipeline(), stages.binned_ratio_pipeline()[0]):
        model = pipeline.fit(train)
        whole = {r.customer_id: r for r in model.transform(df).collect()}
        part = model.transform(test).collect()
        # a row's result does not depend on the rows beside it
        assert all(r == whole[r.customer_id] for r in part) and len(part) == 100
    fitted = stages.binned_ratio_pipeline()[0].fit(train).transform(train).select(F.avg("age"), F.stddev_pop("age")).first()
    assert abs(fitted[0]) < 1e-12 and abs(fitted[1] - 1) < 1e-12


def test_unseen_categories_and_values_outside_the_bins(spark):
    train = spark.createDataFrame([(i, float(i), float(i), 1.0 * i, "A") for i in range(20)], "customer_id long, age double, income double, credit_score double, category string")
    test = spark.createDataFrame([(99, 500.0, None, NAN, "Z")], train.schema)
    mixed = stages.mixed_column_pipeline().fit(train).transform(test).first()
    assert mixed.category_A == 0 and mixed.income is None
    pipeline, feats = stages.binned_ratio_pipeline()
    row = pipeline.fit(train).transform(test).select(*feats).first()
    assert row.age_binned is None and row.income is not None and row.credit_score is not None


def test_stages_compose_with_spark_pipelines(spark):
    df = profile(spark)
    steps, feats = stages.binned_ratio_stages(
        ["age", "income"], ("r", "age", "income"), ("p", "age", "income"), ("age", "age_bin"), ("income", "income_bin")
    )
    out = Pipeline(stages=[*steps, *stages.feature_vector(feats)]).fit(df).transform(df)
    assert out.select("features").first()[0].size == 6


def test_cross_validation_refits_every_step(spark):
    df = profile(spark).withColumn("label_col", (F.col("age") > 45).cast("int"))
    fitted = []

    class Counting(stages.Fitting):
        def _fit(self, rows):
            fitted.append(rows.count())
            return super()._fit(rows)

    def steps():
        from kiln.operators.scaling import StandardScaler

        return [stages.gaps_filled(["age", "income"]), Counting(StandardScaler(["age", "income"]))], ["age", "income"]

    rows = models.cross_validate(df, ["age", "income"], "label_col", "customer_id", stages=steps).collect()
    assert len(fitted) == 5 and all(300 < n < 340 for n in fitted)
    scores = [r.accuracy for r in rows]
    assert min(scores) > 0.9
    assert all(math.isclose(r.mean_accuracy, np.mean(scores)) and math.isclose(r.two_std, 2 * np.std(scores), abs_tol=1e-12) for r in rows)


def counted(spark, df):
    """``df`` with a column whose evaluations are counted."""
    acc = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(x):
        acc.add(1)
        return x

    return df.withColumn("customer_id", seen.asNondeterministic()("customer_id")), acc


@pytest.mark.parametrize("report", [quality.quality_report, quality.quality_score])
def test_reports_evaluate_their_input_once(spark, report):
    df, acc = counted(spark, profile(spark, 200).repartition(3))
    assert report(df).count() > 0
    assert acc.value == 200


def test_nan_is_missing(spark):
    a = spark.createDataFrame([(1, NAN, "x"), (2, 1.0, "y"), (3, None, "y"), (3, 5.0, None)], "customer_id long, age double, g string")
    assert {r.column: r["count"] for r in quality.missing_summary(a).collect()} == {"customer_id": 0, "age": 2, "g": 1}
    assert {r.column: r.completeness for r in quality.completeness(a).collect()} == {"customer_id": 1.0, "age": 0.5, "g": 0.75}
    assert quality.customer_quality(a).first().null_rate == 0.25
    tx = spark.createDataFrame([(NAN, 1, "2024-01-01"), (-1.0, 0, None)], "transaction_amount double, quantity int, transaction_timestamp string")
    assert quality.transaction_quality(tx, "2025-01-01").first().null_rate == pytest.approx(2 / 6)
    checks = {(r.check, r.column): r.value for r in quality.consistency(a, tx).collect()}
    assert checks["transactions_nulls", "transaction_amount"] == 1 and checks["negative_amounts", "transaction_amount"] == 1
    from kiln.operators.scaling import StandardScaler

    out = StandardScaler(["age"]).fit(a).transform(a).collect()
    assert [r.age for r in out] == [None, -1.0, None, 1.0]


def test_rows_and_values_are_compared_by_digest(spark):
    rows = [(None, "a", NAN), (None, "a", None), ("a", None, 0.0), ("a", None, -0.0), ("ab", "c", 1.0), ("a", "bc", 1.0)]
    df = spark.createDataFrame(rows, "x string, y string, z double")
    assert quality.duplicate_rows(df).first()[0] == 2
    stats = {r.k: (r.unique_values, r.most_common) for r in quality.category_stats(df, ["x", "y"]).collect()}
    assert stats == {"x": (2, "a"), "y": (3, "a")}
    single = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "x string")
    assert quality.category_stats(single, ["x"]).first()[1:] == (3, "a")
    plan = quality.duplicate_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(" in plan and not re.search(r"hashpartitioning\((x|y|z)#", plan)


def test_empty_inputs(spark):
    df = profile(spark, 5).limit(0)
    assert quality.quality_score(df).first().total_rows == 0
    assert quality.duplicate_rows(df).first()[0] == 0
    assert quality.category_stats(df, ["category"]).count() == 0

"""Fitted models: scoring in a session that has observed queries."""

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kiln.operators import models, stages
from kiln.session import reloaded


def observed(spark):
    """Rows of two classes, in a session with an observation behind it."""
    df = spark.range(400).selectExpr("id", "double(id % 7) AS a", "double(id % 5) AS b", "int(id % 7 > 3) AS y")
    seen = Observation()
    df.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 400
    return df


def test_logistic_regression_scores_after_an_observation(spark):
    df = observed(spark)
    assert models.accuracy(models.fit_logistic(df, ["a", "b"], "y"), df, "y") == 1.0


def test_cross_validation_scores_after_an_observation(spark):
    df = observed(spark)

    def steps():
        return [stages.gaps_filled(["a", "b"])], ["a", "b"]

    for given in (None, steps):
        rows = models.cross_validate(df, ["a", "b"], "y", "id", stages=given).collect()
        assert len(rows) == 5 and all(r.accuracy == 1.0 for r in rows)


def test_a_reloaded_classifier_scores_as_the_fitted_one(spark):
    df = observed(spark)
    data = models.prepare_features(df, ["a", "b"]).transform(df).withColumn("label", F.col("y").cast("double"))
    for estimator in (LogisticRegression(regParam=0.1), RandomForestClassifier(numTrees=3, seed=1)):
        model = estimator.fit(data)
        again = reloaded(spark, model)
        assert again.transform(data).agg(F.avg(F.abs(F.col("prediction") - F.col("label")))).first()[0] < 0.1
        x = data.select("features").limit(5).collect()
        assert all(again.predictProbability(r.features) == model.predictProbability(r.features) for r in x)


def test_boosted_trees_read_every_row_once(spark, monkeypatch):
    """The rounds read cells of equal bins; the curve is that of all rows, and the fit that of trees over the rows."""
    import pytest
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.regression import GBTRegressor

    df = spark.range(20_000).selectExpr("double(id % 23) AS a", "double(id % 7) AS b", "double((id * id) % 101 + 3 * (id % 23) - (id % 7) * (id % 23)) AS y")
    sizes, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, data: (sizes.append(data.count()), fit(self, data))[1])
    model = models.boosted_trees(df, ["a", "b"], "y", rounds=4, depth=3)
    assert sizes == [23 * 7]
    curve = [r.rmse for r in models.loss_curve(model, df, "y").orderBy("round").collect()]
    rows = models.prepare_features(df, ["a", "b"]).transform(df.withColumn("label", F.col("y")))
    plain = fit(GBTRegressor(maxIter=4, maxDepth=3, stepSize=0.3, seed=42), rows)
    want = [x**0.5 for x in plain.evaluateEachIteration(rows, "squared")]
    assert curve == pytest.approx(want, rel=1e-9)
    scored = model.transform(df.withColumn("label", F.col("y")))
    assert RegressionEvaluator(metricName="rmse").evaluate(scored) == pytest.approx(want[-1], rel=1e-9)

"""Exact forest attribution against the definition over all subsets and background rows."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from kiln.operators import attribution
from kiln.operators.attribution import forest_attribution

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(120, 4)), 1)
    y = x[:, 0] * x[:, 1] + np.abs(x[:, 2])
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = VectorAssembler(inputCols=NAMES, outputCol="features").transform(
        spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double")
    )
    return x, df, RandomForestRegressor(labelCol="y", numTrees=6, maxDepth=4, seed=1).fit(df)


def by_definition(model, row, background):
    cache = {}

    def f(v):
        v = tuple(v)
        if v not in cache:
            cache[v] = model.predict(Vectors.dense(v))
        return cache[v]

    n, out = len(row), []
    for i in range(n):
        total = 0.0
        for size in range(n):
            for s in combinations([j for j in range(n) if j != i], size):
                weight = factorial(size) * factorial(n - size - 1) / factorial(n)
                for z in background:
                    with_i = [row[j] if j in s or j == i else z[j] for j in range(n)]
                    without = [row[j] if j in s else z[j] for j in range(n)]
                    total += weight * (f(with_i) - f(without))
        out.append(total / len(background))
    return out


def test_equals_the_definition(fitted):
    x, df, model = fitted
    train = df.where("id < 25")
    got = {(r.id, r.feature): r.shapley_value for r in forest_attribution(model, train, df.where("id IN (30, 31)"), "id", NAMES).collect()}
    for i in (30, 31):
        assert [got[i, c] for c in NAMES] == pytest.approx(by_definition(model, x[i].tolist(), x[:25].tolist()), abs=1e-12)


def test_sums_to_the_prediction_gap_for_every_row(fitted):
    _, df, model = fitted
    sums = forest_attribution(model, df, df, "id", NAMES).groupBy("id").agg(F.sum("shapley_value").alias("s"))
    mean = model.transform(df).agg(F.avg("prediction")).first()[0]
    gaps = model.transform(df).join(sums, "id").select(F.abs(F.col("s") - F.col("prediction") + mean)).collect()
    assert len(gaps) == 120 and max(g[0] for g in gaps) < 1e-9


def test_decisions_span_words_and_empty_background(fitted, monkeypatch):
    _, df, model = fitted
    monkeypatch.setattr(attribution, "BITS", 8)
    deep = RandomForestRegressor(labelCol="y", numTrees=1, maxDepth=9, minInstancesPerNode=1, seed=1, subsamplingRate=1.0, maxBins=120).fit(df)
    assert len(attribution.ForestPaths(deep).splits[0]) > 16
    sums = forest_attribution(deep, df, df.where("id < 5"), "id", NAMES).groupBy("id").agg(F.sum("shapley_value").alias("s"))
    mean = deep.transform(df).agg(F.avg("prediction")).first()[0]
    assert all(abs(r.s - r.prediction + mean) < 1e-9 for r in deep.transform(df).join(sums, "id").collect())
    none = forest_attribution(model, df.limit(0), df.where("id < 2"), "id", NAMES).collect()
    assert len(none) == 8 and all(r.shapley_value is None for r in none)

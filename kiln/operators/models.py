"""Splits, feature selection and models (M1-M13) on Spark ML.

Random draws cannot reproduce the original library's, so splits and folds
are *hash* based: repeatable for a seed whatever the partitioning, and
recomputed identically when a task is retried.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.stats import fit_row
from kiln.operators.binning import fit_quantile_bins
from kiln.operators.stages import feature_vector
from kiln.session import cut_lineage, reloaded, staged


def _hash(key: Column, seed: int) -> Column:
    """Hex MD5 of the key as text and the seed: any SQL engine can repeat it."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


# --------------------------------------------------------------------------
# M1 split, M3 stratified folds
# --------------------------------------------------------------------------

def train_test_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Hash split of the rows by ``key`` (M1)."""
    b = F.conv(F.substring(_hash(F.col(key), seed), 1, 8), 16, 10).cast("bigint") % 10_000
    cut = int(round((1.0 - test_size) * 10_000))
    return df.where(b < cut), df.where(b >= cut)


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Adds ``fold``: rows of each class, ordered by a seeded hash of ``key``,
    are dealt round-robin into ``k`` folds, so every fold holds the same
    number of rows of each class (+-1) (M3).

    A global rank per class is computed without gathering a class in one
    task: rows are cut into buckets of about ``rows_per_bucket`` rows by the
    leading digits of the hash, so (bucket, hash) order is hash order and the
    fold of a row is the same for any number of buckets. Bucket offsets come
    from a small (class, bucket) count table, and the rank inside a bucket
    from a window over that bucket only.
    """
    digits = max(0, math.ceil(math.log(max(df.count(), 1) / rows_per_bucket, 16)))
    with_b = df.withColumn("__h", _hash(F.col(key), seed)).withColumn("__b", F.substring("__h", 1, digits))
    counts = with_b.groupBy(F.col(label).alias("__y"), F.col("__b").alias("__c")).agg(F.count("*").alias("__n"))
    offs = counts.select("__y", "__c", F.coalesce(
        F.sum("__n").over(Window.partitionBy("__y").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("__off"))
    ranked = with_b.join(offs, F.col(label).eqNullSafe(F.col("__y")) & (F.col("__b") == F.col("__c"))).withColumn(
        "__r", F.row_number().over(Window.partitionBy(label, "__b").orderBy("__h", key)) - 1 + F.col("__off")
    )
    return ranked.withColumn("fold", (F.col("__r") % k).cast("int")).drop("__h", "__b", "__off", "__r", "__y", "__c")


# --------------------------------------------------------------------------
# M6 ANOVA F, W7 top-k, M9 mutual information
# --------------------------------------------------------------------------

def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One-way ANOVA F statistic of each feature against the class label
    (M6), from per-class count / sum / sum of squares (one aggregate).

    Each feature counts over its own non-NULL values; NULL for a constant
    feature, a single class or too few values."""
    per = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        *[F.count(c).alias(f"n_{c}") for c in features],
        *[F.sum(F.col(c).cast("double")).alias(f"s_{c}") for c in features],
        *[F.sum(F.col(c).cast("double") * F.col(c).cast("double")).alias(f"q_{c}") for c in features],
    )
    long = per.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"n_{c}").alias("n"), F.col(f"s_{c}").alias("s"), F.col(f"q_{c}").alias("q")) for c in features
        ])).alias("f"),
    ).select("f.*").where("n > 0")
    t = long.groupBy("feature").agg(
        F.sum("n").alias("n"), F.count("*").alias("k"), F.sum("s").alias("s"), F.sum("q").alias("q"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"),
    )
    sstot = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    ssbn = F.col("b") - F.col("s") * F.col("s") / F.col("n")
    sswn = sstot - ssbn
    f = F.try_divide(F.try_divide(ssbn, F.col("k") - 1), F.try_divide(sswn, F.col("n") - F.col("k")))
    return t.select("feature", f.alias("f_score"))


def select_k_best(scores: DataFrame, k: int = 3, score_col: str = "f_score") -> DataFrame:
    """The ``k`` best features by score (W7), ties by name; a top-k report."""
    return scores.orderBy(F.desc(score_col), F.asc("feature")).limit(k)


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each quantile-binned feature with the
    label (M9), sorted by score. Documented approximation of the
    nearest-neighbour estimator: features are cut at their deciles
    (repeated edges dropped)."""
    binned = df.where(F.col(label).isNotNull()).select(label, *features)
    for m in fit_quantile_bins(binned, list(features), bins, "__bin"):
        binned = m.transform(binned)
    pairs = binned.select(
        F.col(label).alias("y"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__bin").alias("x")) for c in features])).alias("p"),
    ).select("p.feature", "p.x", "y").where(F.col("x").isNotNull())
    joint = pairs.groupBy("feature", "x", "y").agg(F.count("*").alias("nxy"))
    wf = Window.partitionBy("feature")
    joint = joint.withColumns(
        {
            "n": F.sum("nxy").over(wf),
            "nx": F.sum("nxy").over(Window.partitionBy("feature", "x")),
            "ny": F.sum("nxy").over(Window.partitionBy("feature", "y")),
        }
    )
    term = (F.col("nxy") / F.col("n")) * F.log((F.col("nxy") * F.col("n")) / (F.col("nx") * F.col("ny")))
    return joint.groupBy("feature").agg(F.sum(term).alias("mi_score")).orderBy(F.desc("mi_score"), F.asc("feature"))


# --------------------------------------------------------------------------
# Spark ML models
# --------------------------------------------------------------------------

def _known(train: DataFrame, label: str) -> DataFrame:
    """The rows that can train: those with a label, as double ``label``."""
    return train.where(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("double"))


def prepare_features(train: DataFrame, features: Sequence[str], fill: float | str = "mean", scale: bool = False) -> PipelineModel:
    """Feature vector of every row, gaps (NULL, NaN) filled, none dropped.

    ``fill`` is a constant or ``mean`` (of the training rows; 0 for a column
    without values); ``scale`` standardises with the mean and population
    deviation of the filled training rows (a constant column is only
    centred). One aggregate over the training part.
    """
    x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in features}
    stats = [None] * len(x)
    if scale or fill == "mean":
        stats = fit_row(train, [F.struct(F.avg(v).alias("mean")) for v in x.values()])
    gaps = [float((r["mean"] if r else 0.0) or 0.0) if fill == "mean" else float(fill) for r in stats]
    shift = [(0.0, 1.0)] * len(x)
    if scale:
        filled = [F.coalesce(v, F.lit(g)) for v, g in zip(x.values(), gaps)]
        r = fit_row(train, [F.struct(F.avg(v).alias("m"), F.stddev_pop(v).alias("s")) for v in filled])
        shift = [(m or 0.0, s or 1.0) for m, s in r]

    def number(v: float) -> str:
        return f"CAST('{v!r}' AS DOUBLE)"

    cols = ", ".join(
        f"(coalesce(nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {number(g)}) - {number(m)}) / {number(s)} AS __x{i}"
        for i, (c, g, (m, s)) in enumerate(zip(features, gaps, shift))
    )
    names = [f"__x{i}" for i in range(len(x))]
    return PipelineModel([
        SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol="features"),
    ])


def logistic_regression(n_train: int, c: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """L2 logistic regression with the penalty of ``C`` (``regParam = 1/(C n)``)."""
    return LogisticRegression(regParam=1.0 / (c * max(n_train, 1)), elasticNetParam=0.0,
                              standardization=False, maxIter=max_iter, featuresCol="features", labelCol="label")


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, fill: float | str = 0.0, scale: bool = True):
    """Fill gaps (with 0 by default), scale on the training part, fit
    logistic regression (M2 + M5)."""
    known = _known(train, label)
    prep = prepare_features(known, features, fill, scale)
    model = logistic_regression(known.count()).fit(prep.transform(known))
    return PipelineModel([prep, reloaded(train.sparkSession, model)])


def accuracy(model: PipelineModel, test: DataFrame, label: str) -> float:
    pred = model.transform(test.withColumn("label", F.col(label).cast("double")))
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(pred)


def cross_validate(
    df: DataFrame, features: Sequence[str], label: str, key: str, k: int = 5, seed: int = 42,
    stages: Callable[[], tuple[list, list[str]]] | None = None,
) -> DataFrame:
    """Accuracy of logistic regression on ``k`` stratified folds (M4): ``fold, accuracy, mean_accuracy, two_std``.

    In each fold all feature steps are fitted again on the other folds: gaps and
    scaling by default, or the pipeline stages that ``stages()`` returns together
    with the columns they give. The mean and twice the population deviation of
    the accuracies stand beside every fold. The folds are written once; only rows
    with a label count.
    """
    folded = staged(stratified_folds(df.select(key, label, *features).where(F.col(label).isNotNull()), label, key, k, seed), "folds")
    rows = []
    for f in range(k):
        train, test = folded.where(F.col("fold") != f), folded.where(F.col("fold") == f)
        if stages is None:
            model = fit_logistic(train, features, label)
        else:
            steps, cols = stages()
            train = _known(train, label)
            fitted = Pipeline(stages=[*steps, *feature_vector(cols), logistic_regression(train.count())]).fit(train)
            model = PipelineModel([*fitted.stages[:-1], reloaded(df.sparkSession, fitted.stages[-1])])
        rows.append((f, float(accuracy(model, test, label))))
    scores = [a for _, a in rows]
    mean = sum(scores) / k
    spread = 2 * (sum((a - mean) ** 2 for a in scores) / k) ** 0.5
    return df.sparkSession.createDataFrame([(f, a, mean, spread) for f, a in rows], "fold int, accuracy double, mean_accuracy double, two_std double")


def recursive_elimination(df: DataFrame, features: Sequence[str], label: str, n_select: int = 3) -> list[str]:
    """Drop the feature with the smallest absolute coefficient until
    ``n_select`` remain (M7); gaps take the mean, nothing is scaled."""
    keep = list(features)
    data = cut_lineage(df.select(label, *features))
    while len(keep) > n_select:
        model = fit_logistic(data, keep, label, fill="mean", scale=False)
        coef = model.stages[-1].coefficients.toArray()
        keep.pop(int(min(range(len(keep)), key=lambda i: coef[i] ** 2)))
    return keep


def forest_importance(df: DataFrame, features: Sequence[str], label: str, trees: int = 100, seed: int = 42) -> DataFrame:
    """Random-forest importances; ``selected`` = importance >= median (M8)."""
    known = _known(df, label)
    data = prepare_features(known, features).transform(known)
    rf = RandomForestClassifier(numTrees=trees, seed=seed, featuresCol="features", labelCol="label").fit(data)
    imp = [float(x) for x in rf.featureImportances.toArray()]
    s = sorted(imp)
    m = len(s) // 2
    median = s[m] if len(s) % 2 else (s[m - 1] + s[m]) / 2
    rows = [(f, i, i >= median) for f, i in zip(features, imp)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, selected boolean")


def compare_regressors(df: DataFrame, features: Sequence[str], label: str, key: str, seed: int = 42) -> DataFrame:
    """Test MSE of linear regression and a random forest."""
    train, test = train_test_split(df, key, 0.2, seed)
    train, test = _known(train, label), _known(test, label)
    prep = prepare_features(train, features)
    data_tr, data_te = prep.transform(train), prep.transform(test)
    ev = RegressionEvaluator(metricName="mse")
    rows = []
    for name, est in [("linear_regression", LinearRegression()), ("random_forest", RandomForestRegressor(seed=seed))]:
        rows.append((name, float(ev.evaluate(est.fit(data_tr).transform(data_te)))))
    return df.sparkSession.createDataFrame(rows, "model string, mse double")


BINS = 32  # bins of a feature in boosted trees, the library's default
BIN_SAMPLE = 400_000  # rows whose quantiles bound the bins, at most about


def _bin_edges(data: DataFrame, cols: Sequence[str]) -> list[list[float]]:
    """Inner edges of at most ``BINS`` bins of each column (no gaps in it): between
    neighbouring values where a column holds no more than that, else quantiles of a sample."""
    r = fit_row(data, [F.count("*").alias("n")] + [F.approx_count_distinct(c).alias(c) for c in cols])
    drawn = min(1.0, BIN_SAMPLE / max(r["n"], 1))
    sample = data.where(F.rand(seed=42) < drawn) if drawn < 1.0 else data
    probs = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    quantiles = fit_row(sample, [F.percentile(c, probs).alias(c) for c in cols])
    few = [c for c in cols if r[c] <= 2 * BINS]  # the estimate may be off
    values = fit_row(data, [F.sort_array(F.collect_set(c)).alias(c) for c in few]).asDict() if few else {}
    edges = []
    for c in cols:
        if c in values and len(values[c]) <= BINS:
            edges.append([(a + b) / 2 for a, b in zip(values[c], values[c][1:])])
        else:
            edges.append(sorted(set(quantiles[c] or [])))
    return edges


def binned_features(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Features as vectors of bin numbers (at most ``BINS`` bins a feature), gaps filled with the training mean."""
    filled = prepare_features(train, features).stages[0]
    xs, bins = [f"__x{i}" for i in range(len(features))], [f"__bin{i}" for i in range(len(features))]
    edges = _bin_edges(filled.transform(train).select(*xs), xs)
    splits = [[-math.inf, *(e or [0.0]), math.inf] for e in edges]
    # the sum drops the mark of a category: bins are ordered, splits are thresholds
    numbers = ", ".join(f"{b} + 0D AS __number{i}" for i, b in enumerate(bins))
    return PipelineModel([
        filled,
        Bucketizer(splitsArray=splits, inputCols=xs, outputCols=bins),
        SQLTransformer(statement=f"SELECT *, {numbers} FROM __THIS__"),
        VectorAssembler(inputCols=[f"__number{i}" for i in range(len(bins))], outputCol="features"),
    ])


def _cells(prep: PipelineModel, known: DataFrame) -> DataFrame:
    """One row per vector of bins: ``features, weight`` (rows), ``label`` (their mean), ``within``
    (squares of the labels about it). One aggregate, combined map-side; at most ``BINS`` to the
    power of the features, and never more than the rows."""
    *steps, assembler = prep.stages
    bins = assembler.getInputCols()
    cells = PipelineModel(steps).transform(known).groupBy(*bins).agg(
        F.count("*").cast("double").alias("weight"), F.avg("label").alias("__mean"), (F.var_pop("label") * F.count("*")).alias("within")
    )
    return staged(assembler.transform(cells.withColumnRenamed("__mean", "label")).select("features", "weight", "label", "within"), "tree-cells")


def boosted_trees(df: DataFrame, features: Sequence[str], label: str, rounds: int = 50, depth: int = 6,
                  step: float = 0.3, seed: int = 42):
    """Squared-error boosted trees (M11): the fitted pipeline. Defaults follow
    the reference job: 50 rounds of squared error with the library's default
    depth 6 and learning rate 0.3. Gaps take the training mean.

    A split falls between bins, and under squared error all that a round needs of
    the rows in the same bins is their number and the mean of their labels. So all
    rows are aggregated once, and the rounds read weighted cells: the gains, and
    with them the trees, are those of the rows.
    """
    known = _known(df, label)
    prep = binned_features(known, features)
    # read by every round; lost blocks are recomputed from the written table
    data = _cells(prep, known).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trees = GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=step, lossType="squared", seed=seed, weightCol="weight")
        return PipelineModel([prep, trees.fit(data)])
    finally:
        data.unpersist()


def loss_curve(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    """RMSE of a boosted-trees pipeline on all rows of ``df`` after every round.

    Rows in the same bins get the same prediction: their squared error is that of
    their mean label plus the squares about it."""
    data = _cells(model.stages[0], _known(df, label)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        losses = model.stages[1].evaluateEachIteration(data, "squared")  # weighted mean squared errors
        within = fit_row(data, [F.sum("within") / F.sum("weight")])[0] or 0.0
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame([(i, math.sqrt(x + within)) for i, x in enumerate(losses)], "round int, rmse double")


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Batch scoring with a fitted pipeline (M12): every row of ``df`` gets a score."""
    return model.transform(df).select(*keep, "prediction")


def background_rows(df: DataFrame, key: str, samples: int = 64, seed: int = 42) -> DataFrame:
    """The background of M13: the ``samples`` rows with the smallest hashes of
    ``key`` (a sample on purpose, the same on any partitioning)."""
    return cut_lineage(df.orderBy(_hash(F.col(key), seed), key).limit(samples))


def shapley_values(model, background: DataFrame, explain: Sequence[dict], features: Sequence[str],
                   key: str, seed: int = 42) -> DataFrame:
    """Monte-Carlo Shapley values of ``model`` for the rows in ``explain``
    (M13), sampled permutation estimator.

    For each row z of ``background`` (see ``background_rows``; named by its
    unique ``key``) and a seeded permutation per (z, explained row), the hybrid
    rows "features before j from x, the rest from z" with and without feature j
    are built by ``explode`` (no join) and scored in one ``transform``; the
    marginal contributions are averaged per (row, feature). Per (z,
    permutation) the contributions telescope to f(x) - f(z), so the values sum
    exactly to f(x) - mean f(z).
    """
    feats = list(features)
    n_feat = len(feats)
    bg = background.select(F.col(key).alias("__z"), *feats)
    xs = F.array(*[F.struct(F.lit(i).alias("row"), *[F.lit(r[c]).cast("double").alias(c) for c in feats]) for i, r in enumerate(explain)])
    steps = F.array(*[F.lit(j) for j in range(n_feat)])
    ex = bg.select("__z", *[F.col(c).alias(f"z_{c}") for c in feats], F.explode(xs).alias("x"))
    ex = ex.select("*", F.explode(steps).alias("pos"))
    # permutation: rank of each feature by a hash of (z, row, feature)
    ranks = {c: F.xxhash64(F.col("__z"), F.col("x.row"), F.lit(c), F.lit(seed)) for c in feats}
    rank_pos = {c: sum((F.when(ranks[o] < ranks[c], 1).otherwise(0) for o in feats), F.lit(0)) for c in feats}
    on = {c: rank_pos[c] for c in feats}
    with_cols = {c: F.when(on[c] <= F.col("pos"), F.col(f"x.{c}")).otherwise(F.col(f"z_{c}")) for c in feats}
    without_cols = {c: F.when(on[c] < F.col("pos"), F.col(f"x.{c}")).otherwise(F.col(f"z_{c}")) for c in feats}
    target = F.coalesce(*[F.when(on[c] == F.col("pos"), F.lit(c)) for c in feats])
    base = ex.select(F.col("x.row").alias("row"), "__z", target.alias("feature"),
                     F.struct(*[with_cols[c].alias(c) for c in feats]).alias("w"),
                     F.struct(*[without_cols[c].alias(c) for c in feats]).alias("wo"))
    a = base.select("row", "__z", "feature", F.lit(1).alias("sign"), *[F.col(f"w.{c}").alias(c) for c in feats])
    b = base.select("row", "__z", "feature", F.lit(-1).alias("sign"), *[F.col(f"wo.{c}").alias(c) for c in feats])
    scored = model.transform(a.unionByName(b))
    return scored.groupBy("row", "feature").agg(
        (F.sum(F.col("sign") * F.col("prediction")) / F.countDistinct("__z")).alias("shapley_value")
    )

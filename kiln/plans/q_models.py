"""Queries of splits, feature selection and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import models as M
from kiln.operators.attribution import forest_attribution
from kiln.operators.stages import binned_ratio_stages
from kiln.plans.q_features import sql_quantile_bins
from kiln.plans.registry import query
from kiln.sources import tables as T
from kiln.sources.tables import read, with_ctes
from kiln.session import cut_lineage, staged

DOC_FEATURES = ["n_chars", "word_count", "digit_share", "upper_share", "line_count"]
REG_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _anova_sql() -> str:
    per = ", ".join(f"sum({c}) AS s_{c}, sum({c} * {c}) AS q_{c}" for c in DOC_FEATURES)
    rows = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, sum(n) AS n, count(*) AS k, sum(s_{c}) AS s, sum(q_{c}) AS q, "
        f"sum(s_{c} * s_{c} / n) AS b FROM per" for c in DOC_FEATURES
    )
    return with_ctes("ldoc") + f""",
per AS (SELECT quality, count(*) AS n, {per} FROM ldoc WHERE quality IS NOT NULL GROUP BY quality),
t AS ({rows})
SELECT feature, ((b - s * s / n) / (k - 1)) / (((q - s * s / n) - (b - s * s / n)) / (n - k)) AS f_score FROM t"""


@query("m6_anova_f_scores", sql=_anova_sql(), rounding={"f_score": 6})
def m6_anova_f_scores(spark, sf_dir):
    """ANOVA F of document features against the quality label."""
    return M.anova_f(T.labelled_documents(spark, sf_dir), DOC_FEATURES, "quality")


@query(
    "w7_select_k_best",
    sql=f"SELECT * FROM ({_anova_sql()}) ORDER BY f_score DESC, feature ASC LIMIT 3",
    rounding={"f_score": 6},
)
def w7_select_k_best(spark, sf_dir):
    """The three best features by ANOVA F (a top-k report)."""
    return M.select_k_best(M.anova_f(T.labelled_documents(spark, sf_dir), DOC_FEATURES, "quality"), 3)


def _mi_sql() -> str:
    ctes, exprs = [], []
    for c in DOC_FEATURES:
        cte, e = sql_quantile_bins("ldoc", c, f"mi_{c}", 10, None)
        ctes.append(cte)
        exprs.append(f"SELECT '{c}' AS feature, {e} AS x, quality AS y FROM ldoc WHERE quality IS NOT NULL")
    pairs = "\nUNION ALL\n".join(exprs)
    return with_ctes("ldoc") + ",\n" + ",\n".join(ctes) + f""",
pairs AS ({pairs}),
j AS (SELECT feature, x, y, count(*) AS nxy FROM pairs WHERE x IS NOT NULL GROUP BY feature, x, y),
m AS (SELECT *, sum(nxy) OVER (PARTITION BY feature) AS n, sum(nxy) OVER (PARTITION BY feature, x) AS nx,
             sum(nxy) OVER (PARTITION BY feature, y) AS ny FROM j)
SELECT feature, sum((CAST(nxy AS DOUBLE) / n) * ln((CAST(nxy AS DOUBLE) * n) / (CAST(nx AS DOUBLE) * ny))) AS mi_score
FROM m GROUP BY feature"""


@query("m9_mutual_information", sql=_mi_sql(), rounding={"mi_score": 6})
def m9_mutual_information(spark, sf_dir):
    """Mutual information of decile-binned document features with quality,
    sorted (W4)."""
    feats = cut_lineage(T.labelled_documents(spark, sf_dir).select("quality", *DOC_FEATURES))
    return M.mutual_information(feats, DOC_FEATURES, "quality")


# ------------------------------------------------------------------ rows-only (random draws, fitted models)
_LINE_HASH = "md5('{' || l_orderkey || ', ' || l_linenumber || '}|42')"


@query(
    "m1_train_test_split",
    sql=f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN CAST('0x' || substr({_LINE_HASH}, 1, 8) AS BIGINT) % 10000 < 8000 THEN 'train' ELSE 'test' END AS split
FROM lineitem""",
)
def m1_train_test_split(spark, sf_dir):
    """Hash split of the order lines into train / test (80 / 20)."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    key = F.struct("l_orderkey", "l_linenumber")
    tr, te = M.train_test_split(li.withColumn("k", key), "k")
    return tr.select("l_orderkey", "l_linenumber", F.lit("train").alias("split")).unionByName(
        te.select("l_orderkey", "l_linenumber", F.lit("test").alias("split"))
    )


@query(
    "m3_stratified_folds",
    sql=with_ctes("ldoc") + """
SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '|42'), doc_id) - 1) % 5 AS INTEGER) AS fold
FROM ldoc""",
)
def m3_stratified_folds(spark, sf_dir):
    """Five stratified folds of the labelled documents."""
    d = T.labelled_documents(spark, sf_dir)
    return M.stratified_folds(d, "quality", "doc_id", 5).select("doc_id", "quality", "fold")


@query("m5_logistic_regression")
def m5_logistic_regression(spark, sf_dir):
    """Scaler + logistic regression fitted on the train split, accuracy on test."""
    d = T.labelled_documents(spark, sf_dir)
    tr, te = M.train_test_split(d, "doc_id")
    model = M.fit_logistic(tr, DOC_FEATURES, "quality")
    return model.transform(te.withColumn("label", F.col("quality").cast("double"))).select(
        "doc_id", "quality", "prediction"
    )


@query("m4_cross_validation")
def m4_cross_validation(spark, sf_dir):
    """Accuracy per fold of a 5-fold stratified cross-validation."""
    return M.cross_validate(T.labelled_documents(spark, sf_dir), DOC_FEATURES, "quality", "doc_id")


@query("m4_pipeline_cross_validation")
def m4_pipeline_cross_validation(spark, sf_dir):
    """Cross-validation of the whole F19 pipeline over document features: ratio, bins and scaler are refitted in each fold."""

    def steps():
        return binned_ratio_stages(
            DOC_FEATURES, ("words_per_kchar", "word_count", "n_chars"), ("digit_words", "digit_share", "word_count"),
            ("upper_share", "upper_binned"), ("n_chars", "length_binned"),
        )

    return M.cross_validate(T.labelled_documents(spark, sf_dir), DOC_FEATURES, "quality", "doc_id", stages=steps)


@query("m7_recursive_elimination")
def m7_recursive_elimination(spark, sf_dir):
    keep = M.recursive_elimination(T.labelled_documents(spark, sf_dir), DOC_FEATURES, "quality", 3)
    return spark.createDataFrame([(f,) for f in keep], "feature string")


@query("m8_forest_importance")
def m8_forest_importance(spark, sf_dir):
    return M.forest_importance(T.labelled_documents(spark, sf_dir), DOC_FEATURES, "quality")


def _lines(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").withColumn("k", F.struct("l_orderkey", "l_linenumber"))


@query("m10_compare_regressors")
def m10_compare_regressors(spark, sf_dir):
    """Linear regression vs random forest, test MSE, price from quantity,
    discount and tax."""
    return M.compare_regressors(_lines(spark, sf_dir), REG_FEATURES, "l_extendedprice", "k")


@query("m11_boosted_trees")
def m11_boosted_trees(spark, sf_dir):
    """Training RMSE after each of 50 boosting rounds."""
    lines = _lines(spark, sf_dir)
    model = M.boosted_trees(lines, REG_FEATURES, "l_extendedprice", rounds=50)
    return M.loss_curve(model, lines, "l_extendedprice")


@query("m12_batch_scoring")
def m12_batch_scoring(spark, sf_dir):
    """A boosted-trees pipeline fitted on the train split scores every line."""
    lines = _lines(spark, sf_dir)
    tr, _ = M.train_test_split(lines, "k")
    model = M.boosted_trees(tr, REG_FEATURES, "l_extendedprice", rounds=10)
    return M.score(model, lines, ["l_orderkey", "l_linenumber"])


def _attributed(spark, sf_dir):
    """A forest's fit over the graded documents, the first ten documents, and the exact values for them."""
    from pyspark.ml.regression import RandomForestRegressor

    d = T.labelled_documents(spark, sf_dir)
    prep = M.prepare_features(d, DOC_FEATURES)
    train = staged(prep.transform(d.where("quality IS NOT NULL")).select("features", "quality"), "attribution-train")
    forest = RandomForestRegressor(labelCol="quality", numTrees=20, seed=42).fit(train)
    explain = cut_lineage(prep.transform(d.orderBy("doc_id").limit(10)).select("doc_id", "features"))
    return forest, train, explain, forest_attribution(forest, train, explain, "doc_id", DOC_FEATURES)


@query("m13_shapley_values")
def m13_shapley_values(spark, sf_dir):
    """Shapley values of a forest's predictions for ten documents, against all training rows."""
    return _attributed(spark, sf_dir)[3]


@query(
    "m13_shapley_sums",
    sql="SELECT doc_id, 5 AS n_features, true AS exact FROM documents JOIN labels USING (doc_id) ORDER BY doc_id LIMIT 10",
)
def m13_shapley_sums(spark, sf_dir):
    """The values of a document sum to its prediction minus the mean prediction of all training rows."""
    forest, train, explain, values = _attributed(spark, sf_dir)
    mean = forest.transform(train).agg(F.avg("prediction")).first()[0]
    sums = values.groupBy("doc_id").agg(F.count("*").cast("int").alias("n_features"), F.sum("shapley_value").alias("total"))
    gap = F.abs(F.col("total") - (F.col("prediction") - mean))
    return forest.transform(explain).join(sums, "doc_id").select("doc_id", "n_features", (gap <= 1e-9).alias("exact"))


@query(
    "w5_head",
    sql=with_ctes("cust") + "\nSELECT * FROM cust ORDER BY customer_id LIMIT 5",
)
def w5_head(spark, sf_dir):
    """The first rows of a table (a sampling report): a table has no file
    order once its scan is split, so "first" is by key -- a distributed
    top-k, not a full sort."""
    return T.customers(spark, sf_dir).orderBy("customer_id").limit(5)

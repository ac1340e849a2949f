"""Queries of the numeric feature operators and encoders (F2-F12, F17-F19,
P14-P17, F5, M2, A22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import features as FE
from kiln.operators import stages
from kiln.operators.binning import (
    AGE_LABELS,
    QUARTILE_LABELS,
    EqualWidthBinner,
    QuantileBinner,
    histogram,
)
from kiln.operators.encoding import BinaryEncoder, OneHotEncoder, TargetEncoder
from kiln.operators.scaling import MinMaxScaler, OutlierCapper, RobustScaler, StandardScaler
from kiln.functions.numeric import box_cox, unit_norm, yeo_johnson
from kiln.plans.registry import query
from kiln.session import staged
from kiln.sources import tables as T
from kiln.sources.tables import read, with_ctes

NUM = ["age", "income", "credit_score"]
# Registration cut-off separating the training customers from the rest (M2).
TRAIN_BEFORE = "1997-01-01 00:00:00"
# The market segments of the customer table (one-hot columns).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _r(cols, d=6):
    return {c: d for c in cols}


# ------------------------------------------------------------------ SQL helpers
def sql_equal_width(src: str, col: str, out: str, n: int, labels: list[str] | None) -> tuple[str, str]:
    """(CTE with the edges, expression of the bin) of ``cut(bins=n)``."""
    cte = (
        f"ew_{out} AS (SELECT mn, mx, (mx - mn) / {float(n)} AS st FROM "
        f"(SELECT min(CAST({col} AS DOUBLE)) AS mn, max(CAST({col} AS DOUBLE)) AS mx FROM {src}))"
    )
    e = [f"(mn - (mx - mn) * 0.001)"] + [f"({float(i)} * st + mn)" for i in range(1, n)] + ["mx"]
    idx = " + ".join(f"CAST({col} > {e[i]} AS INTEGER)" for i in range(1, n))
    expr = f"CASE WHEN {col} >= {e[0]} AND {col} <= {e[-1]} THEN ({idx}) END"
    if labels:
        arr = "[" + ", ".join(f"'{v}'" for v in labels) + "]"
        expr = f"list_extract({arr}, ({expr}) + 1)"
    else:
        expr = f"CAST({expr} AS BIGINT)"
    return cte, f"(SELECT {expr} FROM ew_{out})"


def sql_quantile_bins(src: str, col: str, out: str, q: int, labels: list[str] | None) -> tuple[str, str]:
    probs = ", ".join(str(i / q) for i in range(q + 1))
    cte = f"qb_{out} AS (SELECT quantile_cont({col}, [{probs}]) AS e FROM {src})"
    # interior edges that are distinct from their predecessor and from the max
    terms = [
        f"CAST({col} > e[{i + 1}] AND e[{i + 1}] <> e[{i}] AND e[{i + 1}] <> e[{q + 1}] AS INTEGER)"
        for i in range(1, q)
    ]
    expr = f"CASE WHEN {col} >= e[1] AND {col} <= e[{q + 1}] THEN ({' + '.join(terms)}) END"
    if labels:
        arr = "[" + ", ".join(f"'{v}'" for v in labels) + "]"
        expr = f"list_extract({arr}, ({expr}) + 1)"
    else:
        expr = f"CAST({expr} AS BIGINT)"
    return cte, f"(SELECT {expr} FROM qb_{out})"


def sql_standard(src: str, cols: list[str], suffix: str = "") -> tuple[str, list[str]]:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    cte = f"ss AS (SELECT {stats} FROM {src})"
    exprs = [
        f"(CAST({c} AS DOUBLE) - (SELECT m_{c} FROM ss)) / (SELECT CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 ELSE s_{c} END FROM ss) AS {c}{suffix}"
        for c in cols
    ]
    return cte, exprs


# ------------------------------------------------------------------ scalers
@query(
    "f2_minmax_scaler",
    sql=with_ctes("cust", "prof") + ",\nmm AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in NUM)
    + " FROM prof)\nSELECT customer_id, category, registration_date, "
    + ", ".join(f"({c} - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1.0 ELSE hi_{c} - lo_{c} END AS {c}" for c in NUM)
    + " FROM prof, mm",
    rounding=_r(NUM),
)
def f2_minmax_scaler(spark, sf_dir):
    p = T.customer_profile(spark, sf_dir)
    return MinMaxScaler(NUM).fit(p).transform(p)


@query(
    "f3_robust_scaler",
    sql=with_ctes("cust", "prof") + ",\nrq AS (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in NUM)
    + " FROM prof)\nSELECT customer_id, category, registration_date, "
    + ", ".join(f"({c} - m_{c}) / CASE WHEN b_{c} = a_{c} THEN 1.0 ELSE b_{c} - a_{c} END AS {c}" for c in NUM)
    + " FROM prof, rq",
    rounding=_r(NUM),
)
def f3_robust_scaler(spark, sf_dir):
    p = T.customer_profile(spark, sf_dir)
    return RobustScaler(NUM).fit(p).transform(p)


def _f4_sql():
    cte, exprs = sql_standard("prof", NUM)
    std = f"SELECT 'Standard' AS scaler, customer_id, {', '.join(exprs)} FROM prof"
    mm = ("SELECT 'MinMax', customer_id, " + ", ".join(
        f"({c} - (SELECT min({c}) FROM prof)) / CASE WHEN (SELECT max({c}) - min({c}) FROM prof) = 0 THEN 1.0 "
        f"ELSE (SELECT max({c}) - min({c}) FROM prof) END" for c in NUM) + " FROM prof")
    rb = ("SELECT 'Robust', customer_id, " + ", ".join(
        f"({c} - (SELECT quantile_cont({c}, 0.5) FROM prof)) / "
        f"(SELECT CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN 1.0 "
        f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END FROM prof)" for c in NUM) + " FROM prof")
    return with_ctes("cust", "prof") + ",\n" + cte + "\n" + std + "\nUNION ALL\n" + mm + "\nUNION ALL\n" + rb


@query("f4_all_scalers", sql=_f4_sql(), rounding=_r(NUM))
def f4_all_scalers(spark, sf_dir):
    from kiln.operators.scaling import apply_scalers

    p = T.customer_profile(spark, sf_dir).select("customer_id", *NUM)
    frames = apply_scalers(p, NUM)
    out = None
    for name, f in frames.items():
        f = f.select(F.lit(name).alias("scaler"), "customer_id", *NUM)
        out = f if out is None else out.unionByName(f)
    return out


@query(
    "f6_outlier_capper",
    sql=with_ctes("cust", "prof") + ",\ncq AS (SELECT "
    + ", ".join(f"quantile_cont({c}, 0.05) AS lo_{c}, quantile_cont({c}, 0.95) AS hi_{c}" for c in NUM)
    + " FROM prof)\nSELECT customer_id, category, registration_date, "
    + ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, lo_{c}), hi_{c}) END AS {c}" for c in NUM)
    + " FROM prof, cq",
    rounding=_r(NUM),
)
def f6_outlier_capper(spark, sf_dir):
    p = T.customer_profile(spark, sf_dir)
    return OutlierCapper(NUM).fit(p).transform(p)


def _m2_sql():
    train = f"(SELECT * FROM prof WHERE registration_date < TIMESTAMP '{TRAIN_BEFORE}')"
    cte, exprs = sql_standard(train, NUM, "_scaled")
    return (with_ctes("cust", "prof") + ",\n" + cte + "\nSELECT customer_id, "
            f"coalesce(registration_date < TIMESTAMP '{TRAIN_BEFORE}', false) AS is_train, "
            + ", ".join(exprs) + " FROM prof")


@query("m2_leakage_safe_scaling", sql=_m2_sql(), rounding=_r([f"{c}_scaled" for c in NUM]))
def m2_leakage_safe_scaling(spark, sf_dir):
    """Fit the scaler on customers registered before the cut-off (train),
    apply the same statistics to every customer (train and test)."""
    p = T.customer_profile(spark, sf_dir)
    is_train = F.coalesce(F.col("registration_date") < F.lit(TRAIN_BEFORE).cast("timestamp"), F.lit(False))
    p = p.withColumn("is_train", is_train)
    model = StandardScaler(NUM, suffix="_scaled").fit(p.where("is_train"))
    return model.transform(p).select("customer_id", "is_train", *[f"{c}_scaled" for c in NUM])


# ------------------------------------------------------------------ binning
def _f11_sql():
    c1, e1 = sql_equal_width("prof", "age", "age_bins", 5, AGE_LABELS)
    c2, e2 = sql_equal_width("prof", "age", "age_binned", 5, None)
    return with_ctes("cust", "prof") + f",\n{c1},\n{c2}\nSELECT customer_id, age, {e1} AS age_bins, {e2} AS age_binned FROM prof"


@query("f11_equal_width_bins", sql=_f11_sql())
def f11_equal_width_bins(spark, sf_dir):
    p = T.customer_profile(spark, sf_dir).select("customer_id", "age")
    p = EqualWidthBinner("age", "age_bins", 5, AGE_LABELS).fit(p).transform(p)
    return EqualWidthBinner("age", "age_binned", 5).fit(p).transform(p)


def _f12_sql():
    c1, e1 = sql_quantile_bins("prof", "income", "income_quartiles", 4, QUARTILE_LABELS)
    c2, e2 = sql_quantile_bins("prof", "credit_score", "credit_binned", 4, None)
    return (with_ctes("cust", "prof") + f",\n{c1},\n{c2}\n"
            f"SELECT customer_id, income, credit_score, {e1} AS income_quartiles, {e2} AS credit_binned FROM prof")


@query("f12_quantile_bins", sql=_f12_sql(), rounding={"income": 4})
def f12_quantile_bins(spark, sf_dir):
    p = T.customer_profile(spark, sf_dir).select("customer_id", "income", "credit_score")
    p = QuantileBinner("income", "income_quartiles", 4, QUARTILE_LABELS).fit(p).transform(p)
    return QuantileBinner("credit_score", "credit_binned", 4).fit(p).transform(p)


@query(
    "a22_histogram",
    sql="""
WITH b AS (SELECT min(l_extendedprice) AS mn, max(l_extendedprice) AS mx FROM lineitem),
e AS (SELECT mn, mx, (mx - mn) / 50.0 AS st FROM b),
x AS (SELECT l_extendedprice AS v FROM lineitem WHERE l_extendedprice IS NOT NULL),
i AS (SELECT (""" + " + ".join(f"CAST(v >= ({float(j)} * st + mn) AS INTEGER)" for j in range(1, 50)) + """) AS bin FROM x, e)
SELECT CAST(bin AS BIGINT) AS bin, bin * st + mn AS lower,
       CASE WHEN bin = 49 THEN mx ELSE (bin + 1) * st + mn END AS upper, count(*) AS "count"
FROM i, e GROUP BY bin, st, mn, mx""",
    rounding={"lower": 4, "upper": 4},
)
def a22_histogram(spark, sf_dir):
    return histogram(read(spark, sf_dir, "lineitem"), "l_extendedprice", 50)


# ------------------------------------------------------------------ P14-P17, F5
@query(
    "p17_polynomial_features",
    sql=with_ctes("cust", "prof") + """
SELECT customer_id, age, credit_score, age AS age_poly, credit_score AS credit_score_poly,
       age * age AS "age^2_poly", age * credit_score AS "age credit_score_poly",
       credit_score * credit_score AS "credit_score^2_poly"
FROM prof""",
)
def p17_polynomial_features(spark, sf_dir):
    p = T.customer_profile(spark, sf_dir).select("customer_id", "age", "credit_score")
    return FE.polynomial_features(p, ["age", "credit_score"], degree=2, interaction_only=False)


@query(
    "p16_feature_interactions",
    sql=with_ctes("cust", "prof") + """
SELECT customer_id, age, income, credit_score, age * income AS age_income_interaction,
       credit_score * age AS credit_score_age_interaction FROM prof""",
    rounding={"income": 4, "age_income_interaction": 4},
)
def p16_feature_interactions(spark, sf_dir):
    p = T.customer_profile(spark, sf_dir).select("customer_id", *NUM)
    return FE.feature_interactions(p, [("age", "income"), ("credit_score", "age")])


@query(
    "f5_unit_norm",
    sql=with_ctes("cust", "prof") + """
SELECT customer_id, age / sqrt(age * age + credit_score * credit_score) AS age_unit,
       credit_score / sqrt(age * age + credit_score * credit_score) AS credit_score_unit,
       sqrt(credit_score) AS credit_score_sqrt FROM prof""",
    rounding={"age_unit": 6, "credit_score_unit": 6, "credit_score_sqrt": 6},
)
def f5_unit_norm(spark, sf_dir):
    p = T.customer_profile(spark, sf_dir)
    return p.select("customer_id", *unit_norm(["age", "credit_score"]), F.sqrt("credit_score").alias("credit_score_sqrt"))


@query(
    "f5_power_transforms",
    sql="""
SELECT c_custkey AS customer_id,
       CASE WHEN c_acctbal > 0 THEN (pow(c_acctbal, 0.25) - 1) / 0.25 END AS balance_box_cox,
       CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END AS balance_box_cox_log,
       CASE WHEN c_acctbal >= 0 THEN (pow(c_acctbal + 1, 0.5) - 1) / 0.5
            WHEN c_acctbal < 0 THEN (1 - pow(1 - c_acctbal, 1.5)) / 1.5 END AS balance_yeo_johnson,
       CASE WHEN c_acctbal >= 0 THEN (pow(c_acctbal + 1, 2) - 1) / 2
            WHEN c_acctbal < 0 THEN -ln(1 - c_acctbal) END AS balance_yeo_johnson_log
FROM customer""",
    rounding={"balance_box_cox": 6, "balance_box_cox_log": 6, "balance_yeo_johnson": 4, "balance_yeo_johnson_log": 3},
)
def f5_power_transforms(spark, sf_dir):
    """Account balances, some negative, under given powers."""
    b = F.col("c_acctbal")
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        box_cox(b, 0.25).alias("balance_box_cox"),
        box_cox(b, 0).alias("balance_box_cox_log"),
        yeo_johnson(b, 0.5).alias("balance_yeo_johnson"),
        yeo_johnson(b, 2).alias("balance_yeo_johnson_log"),
    )


def _f17_sql():
    c1, e1 = sql_equal_width("prof", "age", "age_bins", 5, AGE_LABELS)
    c2, e2 = sql_quantile_bins("prof", "income", "income_quartiles", 4, QUARTILE_LABELS)
    return with_ctes("cust", "prof") + f""",
{c1},
{c2}
SELECT prof.*, age AS age_poly, credit_score AS credit_score_poly, age * credit_score AS "age credit_score_poly",
       {e1} AS age_bins, {e2} AS income_quartiles, ln(1 + income) AS income_log,
       age / (income / 1000.0 + 1e-9) AS age_income_ratio, credit_score * age AS credit_age_interaction
FROM prof"""


@query(
    "f17_advanced_features",
    sql=_f17_sql(),
    rounding={"income": 4, "income_log": 6, "age_income_ratio": 6},
)
def f17_advanced_features(spark, sf_dir):
    return FE.advanced_features(T.customer_profile(spark, sf_dir))


def _f19_sql():
    x0 = ("x0 AS (SELECT customer_id, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in NUM) + " FROM prof)")
    x1 = ("x1 AS (SELECT *, age / (income / 1000.0 + 1.0) AS age_income_ratio, "
          "credit_score * age AS credit_age_product FROM x0)")
    c1, e1 = sql_equal_width("x1", "age", "age_binned", 5, None)
    c2, e2 = sql_quantile_bins("x1", "income", "income_binned", 4, None)
    x2 = f"x2 AS (SELECT *, {e1} AS age_binned, {e2} AS income_binned FROM x1)"
    feats = NUM + ["age_income_ratio", "credit_age_product", "age_binned", "income_binned"]
    cte, exprs = sql_standard("x2", feats)
    return (with_ctes("cust", "prof") + f",\n{x0},\n{x1},\n{c1},\n{c2},\n{x2},\n{cte}\n"
            f"SELECT customer_id, {', '.join(exprs)} FROM x2")


F19_FEATS = NUM + ["age_income_ratio", "credit_age_product", "age_binned", "income_binned"]


@query("f19_binned_ratio_scaled", sql=_f19_sql(), rounding=_r(F19_FEATS))
def f19_binned_ratio_scaled(spark, sf_dir):
    return FE.binned_ratio_features(T.customer_profile(spark, sf_dir))


def _f18_sql():
    cap = ("cq AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.05) AS lo_{c}, quantile_cont({c}, 0.95) AS hi_{c}" for c in NUM)
           + " FROM prof)")
    capped = ("cp AS (SELECT customer_id, category, " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, lo_{c}), hi_{c}) END AS {c}" for c in NUM)
        + " FROM prof, cq)")
    cte, exprs = sql_standard("cp", NUM)
    onehot = ", ".join(f"CAST(coalesce(category = '{v}', false) AS BIGINT) AS category_{v}" for v in SEGMENTS)
    return (with_ctes("cust", "prof") + f",\n{cap},\n{capped},\n{cte}\n"
            f"SELECT customer_id, {', '.join(exprs)}, {onehot} FROM cp")


@query("f18_mixed_column_pipeline", sql=_f18_sql(), rounding=_r(NUM))
def f18_mixed_column_pipeline(spark, sf_dir):
    return FE.mixed_columns(T.customer_profile(spark, sf_dir))


# ---------------------------------------------------- fitted on one part, applied to the other
_EARLY = f"(registration_date < TIMESTAMP '{TRAIN_BEFORE}')"


def _split_profile(spark, sf_dir):
    """Customers registered before the cut-off, and all others (also without a date)."""
    p = staged(T.customer_profile(spark, sf_dir), "profile")
    early = F.coalesce(F.col("registration_date") < F.lit(TRAIN_BEFORE).cast("timestamp"), F.lit(False))
    return p.where(early), p.where(~early)


def _f18_heldout_sql():
    train = f"(SELECT * FROM prof WHERE {_EARLY})"
    cap = ("cq AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.05) AS lo_{c}, quantile_cont({c}, 0.95) AS hi_{c}" for c in NUM) + f" FROM {train})")
    clip = ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, lo_{c}), hi_{c}) END AS {c}" for c in NUM)
    cp = f"cp AS (SELECT customer_id, category, registration_date, {clip} FROM prof, cq)"
    cte, exprs = sql_standard(f"(SELECT * FROM cp WHERE {_EARLY})", NUM)
    onehot = ", ".join(f"CAST(coalesce(category = '{v}', false) AS BIGINT) AS category_{v}" for v in SEGMENTS)
    return (with_ctes("cust", "prof") + f",\n{cap},\n{cp},\n{cte}\n"
            f"SELECT customer_id, {', '.join(exprs)}, {onehot} FROM cp WHERE NOT coalesce({_EARLY}, false)")


@query("f18_mixed_columns_heldout", sql=_f18_heldout_sql(), rounding=_r(NUM))
def f18_mixed_columns_heldout(spark, sf_dir):
    """The F18 pipeline fitted on early customers, applied to the others."""
    train, test = _split_profile(spark, sf_dir)
    model = stages.mixed_column_pipeline().fit(train)
    return model.transform(test.select("customer_id", *NUM, "category")).drop("category")


def _f19_heldout_sql():
    x0 = ("x0 AS (SELECT customer_id, registration_date, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in NUM) + " FROM prof)")
    x1 = "x1 AS (SELECT *, age / (income / 1000.0 + 1.0) AS age_income_ratio, credit_score * age AS credit_age_product FROM x0)"
    train = f"(SELECT * FROM x1 WHERE {_EARLY})"
    c1, e1 = sql_equal_width(train, "age", "age_binned", 5, None)
    c2, e2 = sql_quantile_bins(train, "income", "income_binned", 4, None)
    x2 = f"x2 AS (SELECT *, {e1} AS age_binned, {e2} AS income_binned FROM x1)"
    cte, exprs = sql_standard(f"(SELECT * FROM x2 WHERE {_EARLY})", F19_FEATS)
    return (with_ctes("cust", "prof") + f",\n{x0},\n{x1},\n{c1},\n{c2},\n{x2},\n{cte}\n"
            f"SELECT customer_id, {', '.join(exprs)} FROM x2 WHERE NOT coalesce({_EARLY}, false)")


@query("f19_binned_ratio_heldout", sql=_f19_heldout_sql(), rounding=_r(F19_FEATS))
def f19_binned_ratio_heldout(spark, sf_dir):
    """The F19 pipeline fitted on early customers, applied to the others; values outside the fitted bins have none."""
    train, test = _split_profile(spark, sf_dir)
    pipeline, feats = stages.binned_ratio_pipeline()
    return pipeline.fit(train).transform(test).select("customer_id", *feats)


# ------------------------------------------------------------------ encoders
@query(
    "f8_onehot",
    sql=with_ctes("cust") + "\nSELECT customer_id, gender, "
    + ", ".join(f"CAST(coalesce(gender = '{v}', false) AS BIGINT) AS gender_{v}" for v in SEGMENTS) + " FROM cust",
)
def f8_onehot(spark, sf_dir):
    c = T.customers(spark, sf_dir).select("customer_id", "gender")
    return OneHotEncoder("gender").fit(c).transform(c)


@query(
    "f9_target_encoding",
    sql="""
WITH d AS (SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
pr AS (SELECT avg(quality) AS prior FROM d),
st AS (SELECT source, count(quality) AS n, avg(quality) AS mean FROM d WHERE source IS NOT NULL GROUP BY source),
enc AS (SELECT source, CASE WHEN n = 1 THEN (SELECT prior FROM pr)
           ELSE (SELECT prior FROM pr) * (1.0 - 1.0 / (1.0 + exp(-(n - 20.0) / 10.0)))
                + mean * (1.0 / (1.0 + exp(-(n - 20.0) / 10.0))) END AS e FROM st)
SELECT d.doc_id, d.source, d.quality, coalesce(enc.e, (SELECT prior FROM pr)) AS source_target
FROM d LEFT JOIN enc ON d.source = enc.source""",
    rounding={"source_target": 6},
)
def f9_target_encoding(spark, sf_dir):
    """Smoothed mean document quality per source (documents JOIN labels)."""
    d = read(spark, sf_dir, "documents").select("doc_id", "source")
    lab = read(spark, sf_dir, "labels").select("doc_id", "quality")
    df = d.join(lab, "doc_id")
    return TargetEncoder("source", "quality").fit(df).transform(df)


@query(
    "f10_binary_encoding",
    sql=with_ctes("cust") + """,
o AS (SELECT customer_id, location, dense_rank() OVER (ORDER BY location) AS ord FROM cust WHERE location IS NOT NULL),
nb AS (SELECT CAST(floor(log2(count(DISTINCT location))) + 1 AS INTEGER) AS k FROM cust)
SELECT cust.customer_id, cust.location, """ + ", ".join(
        f"CAST((coalesce(o.ord, 0) >> 4 - {i}) & 1 AS BIGINT) AS location_{i}" for i in range(5)) + """
FROM cust LEFT JOIN o ON cust.customer_id = o.customer_id""",
)
def f10_binary_encoding(spark, sf_dir):
    c = T.customers(spark, sf_dir).select("customer_id", "location")
    return BinaryEncoder("location").fit(c).transform(c)

"""Queries of the data-quality operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.operators import quality as Q
from kiln.operators.encoding import LabelEncoder, distinct_pairs, value_counts
from kiln.operators.joins import orphan_keys
from kiln.operators.validation import data_checks, validation_run
from kiln.plans.registry import query
from kiln.session import scratch_path, staged
from kiln.sources import tables as T
from kiln.sources.tables import read, with_ctes

# "now" of the rule checks: the classic TPC-H cut-off, so future dates exist.
RULES_AS_OF = "1998-08-02 00:00:00"
# Reference / current periods of the drift check (ship date).
DRIFT_SPLIT = "1998-06-01 00:00:00"

CUST_NUM = ["customer_id", "age", "income"]
CUST_OTHER = ["gender", "location", "registration_date"]
CUST_ALL = ["customer_id", "age", "gender", "income", "location", "registration_date"]
TX_ALL = ["transaction_id", "customer_id", "product_id", "transaction_amount", "quantity", "transaction_timestamp"]
LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_OTHER = ["l_returnflag", "l_linestatus", "l_shipdate"]


def _pct(cnt: str, n: str = "count(*)") -> str:
    return f"round(CAST({cnt} AS DOUBLE) * 100.0 / {n}, 2)"


def sql_missing(t: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS \"count\", "
        f"{_pct(f'count(*) FILTER (WHERE {c} IS NULL)')} AS percentage FROM {t}"
        for c in cols
    )


def sql_quartiles(t: str, cols: list[str]) -> str:
    inner = ", ".join(
        f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in cols
    )
    return f"qq AS (SELECT {inner} FROM {t})"


def _out_cond(c: str) -> str:
    return f"({c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}))"


def sql_outliers(t: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {_out_cond(c)}) AS \"count\", "
        f"{_pct(f'count(*) FILTER (WHERE {_out_cond(c)})')} AS percentage FROM {t}, qq"
        for c in cols
    )


def sql_distribution(t: str, num: list[str], other: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", avg(CAST({c} AS DOUBLE)) AS mean, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, "
        f"stddev_samp(CAST({c} AS DOUBLE)) AS std, min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max, "
        f"CAST(NULL AS BIGINT) AS unique_values, CAST(NULL AS VARCHAR) AS most_common FROM {t}"
        for c in num
    ] + [
        f"SELECT '{c}' AS \"column\", CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
        f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), (SELECT count(DISTINCT {c}) FROM {t}), "
        f"(SELECT CAST({c} AS VARCHAR) FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} "
        f"ORDER BY count(*) DESC, CAST({c} AS VARCHAR) ASC LIMIT 1)"
        for c in other
    ]
    return "\nUNION ALL\n".join(parts)


def sql_dups(t: str, cols: list[str]) -> str:
    return (
        f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
        f"(SELECT count(*) AS n FROM {t} GROUP BY {', '.join(cols)})"
    )


def sql_score_parts(t: str, cols: list[str], num: list[str]) -> tuple[str, str]:
    """(CTEs ms / os / ds, SELECT of the score row) of the A10 score."""
    ctes = f"""
ms AS ({sql_missing(t, cols)}),
os AS ({sql_outliers(t, num)}),
ds AS ({sql_dups(t, cols)})"""
    select = f"""
SELECT (SELECT count(*) FROM {t}) AS total_rows, CAST({len(cols)} AS BIGINT) AS total_columns, duplicate_rows,
  greatest(100.0
    - least((SELECT avg(percentage) FROM ms) * 0.5, 30.0)
    - least(CASE WHEN (SELECT count(*) FROM {t}) > 0
                 THEN CAST(duplicate_rows AS DOUBLE) * 100.0 / (SELECT count(*) FROM {t}) ELSE 0.0 END * 0.3, 20.0)
    - least(coalesce((SELECT avg(percentage) FROM os), 0.0) * 0.2, 15.0), 0.0) AS quality_score
FROM ds"""
    return ctes, select


def sql_score(t: str, cols: list[str], num: list[str]) -> str:
    ctes, select = sql_score_parts(t, cols, num)
    return ctes + select


# ---------------------------------------------------------------- A6 / A17
@query("a6_missing_summary", sql=with_ctes("cust") + "\n" + sql_missing("cust", CUST_ALL))
def a6_missing_summary(spark, sf_dir):
    return Q.missing_summary(T.customers(spark, sf_dir))


@query(
    "a17_completeness",
    sql=with_ctes("cust") + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(count({c}) AS DOUBLE) / count(*) AS completeness FROM cust" for c in CUST_ALL
    ),
    rounding={"completeness": 6},
)
def a17_completeness(spark, sf_dir):
    return Q.completeness(T.customers(spark, sf_dir))


# ---------------------------------------------------------------- A7
DOC_DUP_COLS = ["text", "lang", "source", "n_chars"]


@query("a7_duplicate_rows", sql=sql_dups("documents", DOC_DUP_COLS))
def a7_duplicate_rows(spark, sf_dir):
    """Exact copies among documents (whole texts), ignoring the id."""
    return Q.duplicate_rows(read(spark, sf_dir, "documents").select(*DOC_DUP_COLS))


# ---------------------------------------------------------------- A8
@query(
    "a8_outliers_customers",
    sql=with_ctes("cust") + ",\n" + sql_quartiles("cust", CUST_NUM) + "\n" + sql_outliers("cust", CUST_NUM),
)
def a8_outliers_customers(spark, sf_dir):
    return Q.outlier_summary(T.customers(spark, sf_dir))


TX_NUM = ["customer_id", "product_id", "transaction_amount", "quantity"]


@query(
    "a8_outliers_transactions",
    sql=with_ctes("tx") + ",\n" + sql_quartiles("tx", TX_NUM) + "\n" + sql_outliers("tx", TX_NUM),
)
def a8_outliers_transactions(spark, sf_dir):
    return Q.outlier_summary(T.transactions(spark, sf_dir))


# ---------------------------------------------------------------- A9
# Means of data with few decimals can be exact decimal ties at 6 places
# (e.g. 0.0499185); rounding them at 9 keeps every exact value away from a
# rounding boundary. Standard deviations differ in the last bits between
# engines' algorithms, so they keep 6.
DIST_ROUND = {"mean": 9, "median": 6, "std": 6, "min": 6, "max": 6}


@query(
    "a9_distribution_customers",
    sql=with_ctes("cust") + "\n" + sql_distribution("cust", CUST_NUM, CUST_OTHER),
    rounding=DIST_ROUND,
)
def a9_distribution_customers(spark, sf_dir):
    return Q.distribution_summary(T.customers(spark, sf_dir))


@query(
    "a9_distribution_lineitem",
    sql=sql_distribution("lineitem", LI_NUM, LI_OTHER),
    rounding=DIST_ROUND,
)
def a9_distribution_lineitem(spark, sf_dir):
    return Q.distribution_summary(read(spark, sf_dir, "lineitem"))


# ---------------------------------------------------------------- A10 / A11
@query(
    "a10_quality_score_customers",
    sql=with_ctes("cust") + ",\n" + sql_quartiles("cust", CUST_NUM) + "," + sql_score("cust", CUST_ALL, CUST_NUM),
    rounding={"quality_score": 6},
)
def a10_quality_score_customers(spark, sf_dir):
    return Q.quality_score(T.customers(spark, sf_dir))


TX_SCORE_NUM = ["customer_id", "product_id", "transaction_amount", "quantity"]


@query(
    "a10_quality_score_transactions",
    sql=with_ctes("tx") + ",\n" + sql_quartiles("tx", TX_SCORE_NUM) + "," + sql_score("tx", TX_ALL, TX_SCORE_NUM),
    rounding={"quality_score": 6},
)
def a10_quality_score_transactions(spark, sf_dir):
    return Q.quality_score(T.transactions(spark, sf_dir))


def _report_sql() -> str:
    t, cols, num, oth = "cust", CUST_ALL, CUST_NUM, CUST_OTHER
    ctes, score = sql_score_parts(t, cols, num)

    def long(src: str, section: str, metrics: list[str]) -> str:
        return "\nUNION ALL\n".join(
            f"SELECT '{section}' AS section, \"column\", '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value, "
            f"CAST(NULL AS VARCHAR) AS text FROM {src}"
            for m in metrics
        )

    table = "\nUNION ALL\n".join(
        f"SELECT 'table', CAST(NULL AS VARCHAR), '{m}', CAST({m} AS DOUBLE), CAST(NULL AS VARCHAR) FROM sc"
        for m in ("total_rows", "total_columns", "duplicate_rows", "quality_score")
    )
    return (
        with_ctes("cust") + ",\n" + sql_quartiles(t, num) + "," + ctes
        + f",\ndd AS ({sql_distribution(t, num, oth)}),\nsc AS ({score})\n"
        + long("ms", "missing", ["count", "percentage"])
        + "\nUNION ALL\n" + long("os", "outliers", ["count", "percentage"])
        + "\nUNION ALL\n"
        + long("(SELECT * FROM dd WHERE unique_values IS NULL)", "distribution", ["mean", "median", "std", "min", "max"])
        + "\nUNION ALL\nSELECT 'distribution', \"column\", 'unique_values', CAST(unique_values AS DOUBLE), most_common "
        "FROM dd WHERE unique_values IS NOT NULL\nUNION ALL\n" + table
    )


@query("a11_quality_report", sql=_report_sql(), rounding={"value": 6})
def a11_quality_report(spark, sf_dir):
    return Q.quality_report(T.customers(spark, sf_dir))


# ---------------------------------------------------------------- A12
def _rules_sql(t: str, rules: list[tuple[str, str, str]]) -> str:
    body = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {cond}) AS violation_count, '{desc}' AS description FROM {t}"
        for name, cond, desc in rules
    )
    return f"SELECT * FROM ({body}) r WHERE violation_count > 0"


@query(
    "a12_business_rules_transactions",
    sql=with_ctes("tx") + "\n" + _rules_sql("tx", [
        ("positive_transaction_amounts", "transaction_amount <= 0", "Transaction amounts must be positive"),
        ("no_future_dates_transaction_timestamp", f"transaction_timestamp > TIMESTAMP '{RULES_AS_OF}'",
         "transaction_timestamp should not be in the future"),
    ]),
)
def a12_business_rules_transactions(spark, sf_dir):
    return Q.business_rules(T.transactions(spark, sf_dir), as_of=RULES_AS_OF)


@query(
    "a12_business_rules_customers",
    sql=with_ctes("cust") + "\n" + _rules_sql("cust", [
        ("reasonable_customer_age", "age < 18 OR age > 120", "Customer age should be between 18 and 120"),
        ("no_future_dates_registration_date", f"registration_date > TIMESTAMP '{RULES_AS_OF}'",
         "registration_date should not be in the future"),
    ]),
)
def a12_business_rules_customers(spark, sf_dir):
    return Q.business_rules(T.customers(spark, sf_dir), as_of=RULES_AS_OF)


# ---------------------------------------------------------------- A15 / J3
def _drift_sql() -> str:
    ref = f"(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{DRIFT_SPLIT}')"
    cur = f"(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{DRIFT_SPLIT}')"
    num = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", 'numerical' AS kind, "
        f"abs(c.m - r.m) / r.s AS drift_score, abs(c.m - r.m) / r.s > 0.1 AS drift_detected, "
        f"r.m AS reference_mean, c.m AS current_mean "
        f"FROM (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {ref}) r, (SELECT avg({c}) AS m FROM {cur}) c "
        f"WHERE r.s IS NOT NULL AND r.s <> 0"
        for c in LI_NUM
    )
    def dist(src: str, c: str) -> str:
        return (f"(SELECT CAST({c} AS VARCHAR) AS v, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS p "
                f"FROM {src} WHERE {c} IS NOT NULL GROUP BY 1)")
    cat = "\nUNION ALL\n".join(
        f"SELECT '{c}', 'categorical', sum(abs(coalesce(a.p, 0.0) - coalesce(b.p, 0.0))), "
        f"sum(abs(coalesce(a.p, 0.0) - coalesce(b.p, 0.0))) > 0.1, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) "
        f"FROM {dist(ref, c)} a FULL OUTER JOIN {dist(cur, c)} b ON a.v = b.v"
        for c in LI_OTHER
    )
    return num + "\nUNION ALL\n" + cat


def _drift_frames(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    split = F.lit(DRIFT_SPLIT).cast("timestamp_ntz")
    return li.where(F.col("l_shipdate") < split), li.where(F.col("l_shipdate") >= split)


@query(
    "a15_drift",
    sql=_drift_sql(),
    rounding={"drift_score": 6, "reference_mean": 9, "current_mean": 9},
)
def a15_drift(spark, sf_dir):
    ref, cur = _drift_frames(spark, sf_dir)
    return Q.drift_report(ref, cur)


@query(
    "a15_drift_overall",
    sql=f"SELECT coalesce(max(CAST(drift_detected AS INTEGER)) = 1, false) AS drift_detected, "
        f"coalesce(avg(drift_score), 0.0) AS overall_drift_score FROM ({_drift_sql()}) d",
    rounding={"overall_drift_score": 6},
)
def a15_drift_overall(spark, sf_dir):
    ref, cur = _drift_frames(spark, sf_dir)
    return Q.drift_overall(Q.drift_report(ref, cur))


@query(
    "j3_distribution_diff",
    sql=f"""
WITH a AS (SELECT l_returnflag AS value, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS reference_share
           FROM lineitem WHERE l_shipdate < TIMESTAMP '{DRIFT_SPLIT}' AND l_returnflag IS NOT NULL GROUP BY 1),
     b AS (SELECT l_returnflag AS value, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS current_share
           FROM lineitem WHERE l_shipdate >= TIMESTAMP '{DRIFT_SPLIT}' AND l_returnflag IS NOT NULL GROUP BY 1)
SELECT coalesce(a.value, b.value) AS value, coalesce(reference_share, 0.0) AS reference_share,
       coalesce(current_share, 0.0) AS current_share,
       abs(coalesce(reference_share, 0.0) - coalesce(current_share, 0.0)) AS abs_diff
FROM a FULL OUTER JOIN b ON a.value = b.value""",
    rounding={"reference_share": 6, "current_share": 6, "abs_diff": 6},
)
def j3_distribution_diff(spark, sf_dir):
    ref, cur = _drift_frames(spark, sf_dir)
    return Q.distribution_diff(ref, cur, "l_returnflag")


# ---------------------------------------------------------------- J2
@query(
    "j2_orphan_keys",
    sql="""
WITH ck AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey IS NOT NULL),
     pk AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal >= 0 AND c_custkey IS NOT NULL),
     s AS (SELECT (SELECT count(*) FROM pk) AS customers_count,
                  (SELECT count(*) FROM ck) AS unique_customers_in_transactions,
                  (SELECT count(*) FROM ck WHERE k NOT IN (SELECT k FROM pk)) AS orphaned_transaction_customers)
SELECT *, CASE WHEN unique_customers_in_transactions > 0
               THEN 1.0 - CAST(orphaned_transaction_customers AS DOUBLE) / unique_customers_in_transactions
               ELSE 1.0 END AS integrity_score
FROM s""",
    rounding={"integrity_score": 6},
)
def j2_orphan_keys(spark, sf_dir):
    """Orders whose customer is not among the accounts in good standing
    (non-negative balance): the anti join of J2 on real key sets."""
    parent = read(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    return orphan_keys(read(spark, sf_dir, "orders"), parent, "o_custkey", "c_custkey")


# ---------------------------------------------------------------- A16 / A18 / A19
@query(
    "a16_consistency",
    sql=with_ctes("cust", "tx") + """
SELECT 'customers_duplicates' AS "check", 'customer_id' AS "column",
       CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS value
FROM (SELECT count(*) AS n FROM cust GROUP BY customer_id)
UNION ALL
""" + "\nUNION ALL\n".join(
        f"SELECT 'transactions_nulls', '{c}', count(*) FILTER (WHERE {c} IS NULL) FROM tx" for c in TX_ALL
    ) + "\nUNION ALL\nSELECT 'negative_amounts', 'transaction_amount', count(*) FILTER (WHERE transaction_amount < 0) FROM tx",
)
def a16_consistency(spark, sf_dir):
    return Q.consistency(T.customers(spark, sf_dir), T.transactions(spark, sf_dir))


@query(
    "a18_customer_quality",
    sql=with_ctes("cust") + f""",
s AS (SELECT count(*) AS n,
             ({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in CUST_ALL)}) AS nulls,
             count(*) FILTER (WHERE age < 18 OR age > 100) AS age_outliers FROM cust),
d AS (SELECT sum(k - 1) AS d FROM (SELECT count(*) AS k FROM cust GROUP BY customer_id))
SELECT n AS total_records, CAST(d AS DOUBLE) / n AS duplicate_rate,
       CAST(nulls AS DOUBLE) / (n * {len(CUST_ALL)}) AS null_rate, age_outliers,
       greatest(1.0 - least(CAST(d AS DOUBLE) / n, 0.1) * 5 - least(CAST(nulls AS DOUBLE) / (n * {len(CUST_ALL)}), 0.1) * 3
                - least(CAST(age_outliers AS DOUBLE) / n, 0.05) * 10, 0.0) AS data_quality_score
FROM s, d""",
    rounding={"duplicate_rate": 6, "null_rate": 6, "data_quality_score": 6},
)
def a18_customer_quality(spark, sf_dir):
    return Q.customer_quality(T.customers(spark, sf_dir))


@query(
    "a19_transaction_quality",
    sql=with_ctes("tx") + f""",
s AS (SELECT count(*) AS total_records,
             count(*) FILTER (WHERE transaction_amount < 0) AS negative_amounts,
             count(*) FILTER (WHERE quantity <= 0) AS zero_quantities,
             count(*) FILTER (WHERE transaction_timestamp > TIMESTAMP '{RULES_AS_OF}') AS future_dates,
             ({' + '.join(f'count(*) FILTER (WHERE {c} IS NULL)' for c in TX_ALL)}) AS nulls FROM tx)
SELECT total_records, negative_amounts, zero_quantities, future_dates,
       CAST(nulls AS DOUBLE) / (total_records * {len(TX_ALL)}) AS null_rate,
       greatest(1.0 - least(CAST(negative_amounts AS DOUBLE) / total_records, 0.05) * 10
                - least(CAST(zero_quantities AS DOUBLE) / total_records, 0.05) * 10
                - least(CAST(nulls AS DOUBLE) / (total_records * {len(TX_ALL)}), 0.1) * 3, 0.0) AS data_quality_score
FROM s""",
    rounding={"null_rate": 6, "data_quality_score": 6},
)
def a19_transaction_quality(spark, sf_dir):
    return Q.transaction_quality(T.transactions(spark, sf_dir), as_of=RULES_AS_OF)


# ---------------------------------------------------------------- A20 / A21
@query(
    "a20_value_counts",
    sql=with_ctes("cust") + """
SELECT location, count(*) AS "count", CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS proportion
FROM cust WHERE location IS NOT NULL GROUP BY location""",
    rounding={"proportion": 6},
)
def a20_value_counts(spark, sf_dir):
    return value_counts(T.customers(spark, sf_dir), "location", normalize=True)


@query(
    "a21_distinct_pairs",
    sql=with_ctes("prod") + """
SELECT DISTINCT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS BIGINT) AS category_encoded FROM prod""",
)
def a21_distinct_pairs(spark, sf_dir):
    prods = T.products(spark, sf_dir)
    enc = LabelEncoder("category", "category_encoded").fit(prods).transform(prods)
    return distinct_pairs(enc, ["category", "category_encoded"])


# ---------------------------------------------------------------- A23 / A24
def validation_checks(cust, tx):
    """The data checks as one long table ``check, value, passed``; inputs are written once."""
    return data_checks(staged(cust, "customers"), staged(tx, "transactions"), RULES_AS_OF)


def _validate_all_sql() -> str:
    from kiln.plans.registry import REGISTRY

    a16, a18, a19 = (REGISTRY[n].sql for n in ("a16_consistency", "a18_customer_quality", "a19_transaction_quality"))
    return with_ctes("cust", "tx") + f""",
ck AS (SELECT DISTINCT customer_id AS k FROM tx WHERE customer_id IS NOT NULL),
pk AS (SELECT DISTINCT customer_id AS k FROM cust WHERE customer_id IS NOT NULL),
integ AS (SELECT (SELECT count(*) FROM ck) AS u, (SELECT count(*) FROM ck WHERE k NOT IN (SELECT k FROM pk)) AS o)
SELECT 'referential_integrity' AS "check",
       CASE WHEN u > 0 THEN 1.0 - CAST(o AS DOUBLE) / u ELSE 1.0 END AS value, o = 0 AS passed FROM integ
UNION ALL
SELECT "check", CAST(sum(value) AS DOUBLE), sum(value) = 0 FROM ({a16}) c GROUP BY "check"
UNION ALL
SELECT 'customer_quality', data_quality_score, data_quality_score >= 0.8 FROM ({a18}) q
UNION ALL
SELECT 'transaction_quality', data_quality_score, data_quality_score >= 0.8 FROM ({a19}) t"""


@query("a24_validate_all", sql=_validate_all_sql(), rounding={"value": 6})
def a24_validate_all(spark, sf_dir):
    return validation_checks(T.customers(spark, sf_dir), T.transactions(spark, sf_dir))


@query(
    "a23_check_rollup",
    sql=f"""SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_checks,
       count(*) FILTER (WHERE NOT passed) AS failed_checks,
       CASE WHEN count(*) FILTER (WHERE NOT passed) = 0 THEN 'PASSED' ELSE 'FAILED' END AS overall_status
FROM ({_validate_all_sql()}) v""",
)
def a23_check_rollup(spark, sf_dir):
    return Q.rollup_checks(validation_checks(T.customers(spark, sf_dir), T.transactions(spark, sf_dir)))


#: Declared type families of the validated tables.
EXPECTED = {
    "customers": {"customer_id": "int64", "age": "int64", "gender": "object", "income": "float64", "registration_date": "datetime64"},
    "transactions": {"transaction_id": "object", "customer_id": "int64", "transaction_amount": "float64", "segment": "object"},
}


def _validation_report_sql() -> str:
    complete = "\n".join(
        f"UNION ALL SELECT 'completeness', '{name}', '{c}', CAST(count({c}) AS DOUBLE) / count(*), NULL FROM {t}"
        for name, t, cols in (("customers", "cust", CUST_ALL), ("transactions", "tx", TX_ALL))
        for c in cols
    )
    return with_ctes("cust", "tx") + f""",
checks("section", "check", "column", value, passed) AS (
SELECT 'data', "check", CAST(NULL AS VARCHAR), value, passed FROM ({_validate_all_sql()}) d
{complete}
UNION ALL SELECT 'schema', 'customers', NULL, 0.0, true
UNION ALL SELECT 'schema', 'transactions', NULL, 1.0, false
UNION ALL SELECT 'catalog', 'customers', NULL, CAST({len(CUST_ALL)} AS DOUBLE), true
UNION ALL SELECT 'catalog', 'transactions', NULL, CAST({len(TX_ALL)} AS DOUBLE), true),
judged AS (SELECT count(*) AS n, count(*) FILTER (WHERE passed) AS good FROM checks WHERE passed IS NOT NULL)
SELECT * FROM checks
UNION ALL SELECT 'summary', 'total_checks', NULL, CAST(n AS DOUBLE), good = n FROM judged
UNION ALL SELECT 'summary', 'passed_checks', NULL, CAST(good AS DOUBLE), good = n FROM judged
UNION ALL SELECT 'summary', 'failed_checks', NULL, CAST(n - good AS DOUBLE), good = n FROM judged"""


@query("s21_validation_report", sql=_validation_report_sql(), rounding={"value": 6})
def s21_validation_report(spark, sf_dir):
    """Every check of a run, and the summary, read back from the written report.

    One declared column (``segment``) is absent, so the run fails.
    """
    out = scratch_path(spark, f"validation-report-{uuid.uuid4().hex}")
    checks, summary = validation_run(T.customers(spark, sf_dir), T.transactions(spark, sf_dir), EXPECTED, RULES_AS_OF, out)
    counts = ("total_checks", "passed_checks", "failed_checks")
    rolled = summary.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).cast("double").alias("value")) for c in counts])).alias("c"),
        (F.col("overall_status") == "PASSED").alias("passed"),
    ).select(F.lit("summary").alias("section"), "c.check", F.lit(None).cast("string").alias("column"), "c.value", "passed")
    return checks.unionByName(rolled)

"""Checks and cleaning over tables with injected faults.

The given tables never violate most rules, so these queries run the operators
on the same adapters with faults injected by key, in Spark and in SQL alike:
missing categories, impossible ages, future dates, repeated customers, bad
amounts and quantities, orphans, prices in every band, broken URLs, and texts
and pages with and without scripts. The SQL is that of the plain query over the
changed views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions import validators as V
from kiln.operators import prep
from kiln.operators import protection as P
from kiln.operators import quality as Q
from kiln.plans import q_prep, q_quality, q_validators  # noqa: F401  (their queries must be registered first)
from kiln.plans.registry import REGISTRY, query
from kiln.sources import tables as T
from kiln.sources.tables import ORACLE_CTES, read, with_ctes

FUTURE = "2030-01-01 00:00:00"

#: Column expressions that inject the faults, in SQL that both engines read.
CUSTOMER_FAULTS = {
    "age": "CASE WHEN customer_id % 50 = 0 THEN 400 WHEN customer_id % 50 = 1 THEN 5 ELSE age END",
    "gender": "CASE WHEN customer_id % 11 <> 0 THEN gender END",
    "location": "CASE WHEN customer_id % 13 <> 0 THEN location END",
    "registration_date": f"CASE WHEN customer_id % 17 = 0 THEN TIMESTAMP '{FUTURE}' ELSE registration_date END",
}
TWICE = "customer_id % 25 = 3"
TRANSACTION_FAULTS = {
    "customer_id": "CASE WHEN product_id % 60 = 7 THEN NULL WHEN product_id % 60 = 9 THEN customer_id + 1000000000 ELSE customer_id END",
    "transaction_amount": "CASE WHEN product_id % 40 = 0 THEN -transaction_amount WHEN product_id % 40 <> 1 THEN transaction_amount END",
    "quantity": "CASE WHEN product_id % 30 = 1 THEN 0.0 ELSE quantity END",
    "transaction_timestamp": f"CASE WHEN product_id % 70 = 3 THEN TIMESTAMP '{FUTURE}' ELSE transaction_timestamp END",
}
PRODUCT_FAULTS = {
    "price": "CASE product_id % 6 WHEN 0 THEN price / 100 WHEN 1 THEN price / 20 WHEN 2 THEN price / 5 "
    "WHEN 3 THEN 0.0 WHEN 4 THEN price END",
    "product_description": "CASE WHEN product_id % 7 <> 0 THEN product_description END",
}
URL = (
    "CASE page_id % 5 WHEN 0 THEN concat('x', url) WHEN 1 THEN replace(url, '://', ':/') "
    "WHEN 2 THEN concat(url, ' end') WHEN 3 THEN NULL ELSE url END"
)
TEXT = "CASE WHEN doc_id % 3 = 0 THEN concat(text, ' <script>alert(1)</script>') ELSE text END"
HTML = (
    "CASE page_id % 3 WHEN 0 THEN html WHEN 1 THEN replace(replace(html, '<', ' '), '>', ' ') "
    "ELSE concat('<p>page ', page_id, '</p>') END"
)


def _changed(df: DataFrame, faults: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.expr(e).cast(df.schema[c].dataType) for c, e in faults.items()})


def customers(spark, sf_dir) -> DataFrame:
    c = _changed(T.customers(spark, sf_dir), CUSTOMER_FAULTS)
    return c.withColumn("__n", F.expr(f"CASE WHEN {TWICE} THEN 2 ELSE 1 END")).withColumn(
        "__n", F.explode(F.sequence(F.lit(1), F.col("__n")))
    ).drop("__n")


def transactions(spark, sf_dir) -> DataFrame:
    return _changed(T.transactions(spark, sf_dir), TRANSACTION_FAULTS)


def products(spark, sf_dir) -> DataFrame:
    return _changed(T.products(spark, sf_dir), PRODUCT_FAULTS)


def _view(name: str, faults: dict[str, str], more: str = "") -> tuple[str, str]:
    """The adapter's SQL view and the same view with the faults."""
    plain = ORACLE_CTES[name]
    columns = ", ".join(f"{e} AS {c}" for c, e in faults.items())
    return plain, plain.replace(f"{name} AS (", f"{name}_given AS (", 1) + (
        f",\n{name}_one AS (SELECT * REPLACE ({columns}) FROM {name}_given),\n{name} AS (SELECT * FROM {name}_one{more})"
    )


VIEWS = [
    _view("cust", CUSTOMER_FAULTS, f" UNION ALL SELECT * FROM cust_one WHERE {TWICE}"),
    _view("tx", TRANSACTION_FAULTS),
    _view("prod", PRODUCT_FAULTS),
]


def injected(name: str, of: str, views: list[tuple[str, str]] = VIEWS):
    """Register ``name`` with the SQL of query ``of`` over the changed views."""
    sql = REGISTRY[of].sql
    for plain, changed in views:
        sql = sql.replace(plain, changed)
    if sql == REGISTRY[of].sql:
        raise ValueError(f"{of} reads none of the changed views")
    return query(name, sql=sql, rounding=REGISTRY[of].rounding)


@injected("f16_clean_customers_injected", "f16_clean_customers")
def f16_clean_customers_injected(spark, sf_dir):
    return prep.clean_customers(customers(spark, sf_dir), as_of=q_prep.AS_OF)


@injected("f15_product_features_injected", "f15_product_features")
def f15_product_features_injected(spark, sf_dir):
    return prep.product_features(products(spark, sf_dir))


@injected("a12_business_rules_transactions_injected", "a12_business_rules_transactions")
def a12_business_rules_transactions_injected(spark, sf_dir):
    return Q.business_rules(transactions(spark, sf_dir), as_of=q_quality.RULES_AS_OF)


@injected("a12_business_rules_customers_injected", "a12_business_rules_customers")
def a12_business_rules_customers_injected(spark, sf_dir):
    return Q.business_rules(customers(spark, sf_dir), as_of=q_quality.RULES_AS_OF)


@injected("a16_consistency_injected", "a16_consistency")
def a16_consistency_injected(spark, sf_dir):
    return Q.consistency(customers(spark, sf_dir), transactions(spark, sf_dir))


@injected("a18_customer_quality_injected", "a18_customer_quality")
def a18_customer_quality_injected(spark, sf_dir):
    return Q.customer_quality(customers(spark, sf_dir))


@injected("a19_transaction_quality_injected", "a19_transaction_quality")
def a19_transaction_quality_injected(spark, sf_dir):
    return Q.transaction_quality(transactions(spark, sf_dir), as_of=q_quality.RULES_AS_OF)


@injected("a24_validate_all_injected", "a24_validate_all")
def a24_validate_all_injected(spark, sf_dir):
    return q_quality.validation_checks(customers(spark, sf_dir), transactions(spark, sf_dir))


@injected("a23_check_rollup_injected", "a23_check_rollup")
def a23_check_rollup_injected(spark, sf_dir):
    return Q.rollup_checks(q_quality.validation_checks(customers(spark, sf_dir), transactions(spark, sf_dir)))


@injected("v3_url_check_injected", "v3_url_check", [("FROM pages", f"FROM (SELECT page_id, {URL} AS url FROM pages) p")])
def v3_url_check_injected(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", F.expr(URL).alias("url"))
    return pages.select("page_id", "url", V.is_url(F.col("url")).alias("valid"))


@injected(
    "v4_sql_injection_documents_injected",
    "v4_sql_injection_documents",
    [("FROM documents", f"FROM (SELECT doc_id, {TEXT} AS text FROM documents) d")],
)
def v4_sql_injection_documents_injected(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", F.expr(TEXT).alias("text"))
    return P.injection_scan(docs, "doc_id", "text")


@injected("v5_xss_pages_injected", "v5_xss_pages", [("FROM pages", f"FROM (SELECT page_id, {HTML} AS html FROM pages) p")])
def v5_xss_pages_injected(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", F.expr(HTML).alias("html"))
    return P.injection_scan(pages, "page_id", "html")


def _cust_sql(body: str) -> str:
    """``body`` over the changed customers."""
    plain, changed = VIEWS[0]
    return with_ctes("cust").replace(plain, changed) + body


def _mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM cust WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "a3_impute_modes_injected",
    sql=_cust_sql(f"""
SELECT customer_id, age, coalesce(gender, {_mode_sql("gender")}) AS gender,
       coalesce(income, (SELECT quantile_cont(income, 0.5) FROM cust)) AS income,
       coalesce(location, {_mode_sql("location")}) AS location, registration_date
FROM cust"""),
    rounding={"income": 4},
)
def a3_impute_modes_injected(spark, sf_dir):
    """Two text columns with gaps take their modes, incomes the median (A3)."""
    return prep.handle_missing_values(customers(spark, sf_dir))


@query(
    "a3_impute_text_injected",
    sql=_cust_sql("""
SELECT customer_id, age, coalesce(gender, '') AS gender, coalesce(income, (SELECT avg(income) FROM cust)) AS income,
       coalesce(location, '') AS location, registration_date
FROM cust"""),
    rounding={"income": 4},
)
def a3_impute_text_injected(spark, sf_dir):
    """Text gaps become the empty text, incomes the mean (A3)."""
    return prep.handle_missing_values(customers(spark, sf_dir), numerical="mean", categorical=None)

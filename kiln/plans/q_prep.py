"""Queries of the preparation pipeline: A1, A2, F16, F15, A3-A5, F1, P-series."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import dates
from kiln.operators import prep
from kiln.plans.registry import query
from kiln.sources import tables as T
from kiln.sources.tables import with_ctes

# Fixed reference time for every "now"-dependent operator over the order data.
AS_OF = "2002-01-01 00:00:00"

DAY_US = "86400000000.0"

# Cleaned customers (F16) as SQL: median fill of income (age has no gaps, so
# it keeps its integer type, as an integer column without NaN does), tenure,
# 'Unknown' fill, then the IQR filter on age.
CLEAN_CUSTOMERS_SQL = f"""
med AS (SELECT quantile_cont(income, 0.5) AS inc_med FROM cust),
cc0 AS (
  SELECT customer_id, age, gender,
         coalesce(income, (SELECT inc_med FROM med)) AS income,
         location, registration_date,
         CAST(floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(registration_date)) / {DAY_US}) AS BIGINT)
           AS customer_tenure_days
  FROM cust),
cc1 AS (
  SELECT customer_id, age, coalesce(gender, 'Unknown') AS gender, income,
         coalesce(location, 'Unknown') AS location, registration_date, customer_tenure_days
  FROM cc0),
qa AS (SELECT quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.75) AS q3 FROM cc1),
cc AS (
  SELECT cc1.* FROM cc1
  WHERE age BETWEEN (SELECT q1 - 1.5 * (q3 - q1) FROM qa) AND (SELECT q3 + 1.5 * (q3 - q1) FROM qa))"""


@query(
    "a1_customer_aggregate",
    sql=with_ctes("tx")
    + f""",
t AS (
  SELECT *, CAST(floor((epoch_us((SELECT max(transaction_timestamp) FROM tx))
                       - epoch_us(transaction_timestamp)) / {DAY_US}) AS BIGINT) AS days_since
  FROM tx)
SELECT customer_id,
       coalesce(sum(transaction_amount), 0.0) AS total_spent,
       avg(transaction_amount) AS avg_transaction_amount,
       count(transaction_amount) AS transaction_count,
       coalesce(stddev_samp(transaction_amount), 0.0) AS transaction_amount_std,
       min(days_since) AS recency_days,
       count(DISTINCT product_id) AS unique_products_purchased
FROM t WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    # means of 4-decimal amounts can be exact decimal ties at 6 places: 9
    rounding={"total_spent": 4, "avg_transaction_amount": 9, "transaction_amount_std": 6},
)
def a1_customer_aggregate(spark, sf_dir):
    return prep.customer_aggregates(T.transactions(spark, sf_dir))


@query(
    "p_enriched_transactions",
    sql=with_ctes("tx")
    + f"""
SELECT transaction_id, customer_id, product_id, transaction_amount, quantity, transaction_timestamp,
       CAST(transaction_timestamp AS DATE) AS transaction_date,
       hour(transaction_timestamp) AS hour_of_day,
       CAST(isodow(transaction_timestamp) - 1 AS BIGINT) AS day_of_week,
       month(transaction_timestamp) AS month,
       CAST(CASE WHEN isodow(transaction_timestamp) IN (6, 7) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
       CAST(floor((epoch_us((SELECT max(transaction_timestamp) FROM tx))
                  - epoch_us(transaction_timestamp)) / {DAY_US}) AS BIGINT) AS days_since_transaction
FROM tx""",
    rounding={"transaction_amount": 4},
)
def p_enriched_transactions(spark, sf_dir):
    """P1, P3, P4, P5, P8 over every order line."""
    return prep.enrich_transactions(T.transactions(spark, sf_dir))


@query(
    "f16_clean_customers",
    sql=with_ctes("cust") + "," + CLEAN_CUSTOMERS_SQL + "\nSELECT * FROM cc",
    rounding={"income": 4},
)
def f16_clean_customers(spark, sf_dir):
    return prep.clean_customers(T.customers(spark, sf_dir), as_of=AS_OF)


@query(
    "a2_interaction_features",
    sql=with_ctes("cust", "tx")
    + ","
    + CLEAN_CUSTOMERS_SQL
    + f""",
g AS (
  SELECT customer_id, transaction_timestamp AS ts, transaction_amount AS amt,
         month(transaction_timestamp) AS m,
         lag(transaction_timestamp) OVER (PARTITION BY customer_id ORDER BY transaction_timestamp) AS prev
  FROM tx WHERE customer_id IS NOT NULL),
s AS (
  SELECT customer_id, avg(amt) AS avg_price_range, count(*) AS purchase_frequency, count(ts) AS n_ts,
         sum(floor((epoch_us(ts) - epoch_us(prev)) / {DAY_US})) AS gap_sum
  FROM g GROUP BY customer_id),
mm AS (
  SELECT customer_id, m,
         row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, m ASC) AS rn
  FROM g WHERE m IS NOT NULL GROUP BY customer_id, m)
SELECT cc.customer_id,
       CASE WHEN s.n_ts > 1 THEN s.gap_sum / (s.n_ts - 1) ELSE 0.0 END AS avg_days_between_purchases,
       CAST(NULL AS VARCHAR) AS preferred_category,
       s.avg_price_range, s.purchase_frequency,
       coalesce(mm.m, 1) AS seasonal_preference
FROM cc JOIN s ON cc.customer_id = s.customer_id
LEFT JOIN mm ON mm.customer_id = s.customer_id AND mm.rn = 1""",
    rounding={"avg_days_between_purchases": 9, "avg_price_range": 9},
)
def a2_interaction_features(spark, sf_dir):
    cleaned = prep.clean_customers(T.customers(spark, sf_dir), as_of=AS_OF)
    return prep.interaction_features(cleaned, T.transactions(spark, sf_dir))


@query(
    "a2_intraday_categories",
    sql=with_ctes("tx", "prod")
    + f""",
g AS (
  SELECT customer_id, category, transaction_amount AS amt,
         transaction_timestamp + to_hours(5 * CAST(split_part(transaction_id, '-', 2) AS INTEGER)) AS ts
  FROM tx JOIN prod USING (product_id)),
l AS (SELECT *, lag(ts) OVER (PARTITION BY customer_id ORDER BY ts) AS prev FROM g),
s AS (
  SELECT customer_id, avg(amt) AS avg_price_range, count(*) AS purchase_frequency, count(ts) AS n_ts,
         sum(floor((epoch_us(ts) - epoch_us(prev)) / {DAY_US})) AS gap_sum
  FROM l GROUP BY customer_id),
m AS (
  SELECT customer_id, month(ts) AS m,
         row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, month(ts)) AS rn
  FROM g GROUP BY customer_id, month(ts)),
c AS (
  SELECT customer_id, category, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, category) AS rn
  FROM g GROUP BY customer_id, category)
SELECT s.customer_id,
       CASE WHEN n_ts > 1 THEN gap_sum / (n_ts - 1) ELSE 0.0 END AS avg_days_between_purchases,
       c.category AS preferred_category, avg_price_range, purchase_frequency, m.m AS seasonal_preference
FROM s JOIN m ON m.customer_id = s.customer_id AND m.rn = 1
JOIN c ON c.customer_id = s.customer_id AND c.rn = 1
JOIN customer ON c_custkey = s.customer_id""",
    rounding={"avg_days_between_purchases": 9, "avg_price_range": 9},
)
def a2_intraday_categories(spark, sf_dir):
    """A2 with the modal product category, over purchases moved into the day by their line number."""
    line = F.split_part("transaction_id", F.lit("-"), F.lit(2)).cast("int")
    shifted = F.col("transaction_timestamp") + F.make_dt_interval(hours=line * 5)
    tx = T.transactions(spark, sf_dir).withColumn("transaction_timestamp", shifted)
    tx = tx.join(T.products(spark, sf_dir).select("product_id", "category"), "product_id")
    return prep.interaction_features(T.customers(spark, sf_dir), tx, category="category")


@query(
    "p1_parsed_dates",
    sql="""
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 7 IN (0, 1) THEN NULL
            ELSE o_orderdate + to_seconds(o_orderkey % 86400) END AS parsed,
       CASE WHEN o_orderkey % 7 IN (0, 1) THEN NULL ELSE hour(o_orderdate + to_seconds(o_orderkey % 86400)) END AS hour
FROM orders""",
)
def p1_parsed_dates(spark, sf_dir):
    """Timestamps parsed from text; every seventh order has no date, every seventh one that can't be parsed."""
    o = T.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    moment = dates.as_ts("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("not a date")).when(
        F.col("o_orderkey") % 7 != 1, F.date_format(moment, "dd/MM/yyyy HH:mm:ss")
    )
    parsed = dates.parse_ts(F.col("text"), "dd/MM/yyyy HH:mm:ss")
    return o.select(F.col("o_orderkey").alias("order_id"), text.alias("text")).select(
        "order_id", parsed.alias("parsed"), F.hour(parsed).cast("bigint").alias("hour")
    )


@query(
    "f15_product_features",
    sql=with_ctes("prod")
    + """
SELECT product_id, category, price, coalesce(product_description, '') AS product_description,
       CAST(length(coalesce(product_description, '')) AS BIGINT) AS description_length,
       CAST(CASE WHEN trim(coalesce(product_description, '')) = '' THEN 0
            ELSE len(string_split_regex(trim(product_description), '\\s+')) END AS BIGINT)
         AS description_word_count,
       ln(1 + price) AS price_log,
       CASE WHEN price > 0 AND price <= 25 THEN 'low' WHEN price > 25 AND price <= 100 THEN 'medium'
            WHEN price > 100 AND price <= 500 THEN 'high' WHEN price > 500 THEN 'premium' END AS price_category,
       CAST(dense_rank() OVER (ORDER BY category) - 1 AS BIGINT) AS category_encoded
FROM prod""",
    rounding={"price_log": 6},
)
def f15_product_features(spark, sf_dir):
    """F15 without the TF-IDF block (that is f14_tfidf, long form)."""
    return prep.product_features(T.products(spark, sf_dir))


# Missing values injected from the data itself: a negative balance is a
# missing income, a customer without orders has no registration date.
@query(
    "a3_impute_missing",
    sql=with_ctes("cust")
    + """,
mo AS (
  SELECT gender AS v FROM cust WHERE gender IS NOT NULL GROUP BY gender
  ORDER BY count(*) DESC, gender ASC LIMIT 1)
SELECT customer_id, age,
       coalesce(gender, (SELECT v FROM mo)) AS gender,
       coalesce(income, (SELECT quantile_cont(income, 0.5) FROM cust)) AS income,
       location, registration_date
FROM cust""",
    rounding={"income": 4},
)
def a3_impute_missing(spark, sf_dir):
    return prep.handle_missing_values(T.customers(spark, sf_dir))


@query(
    "a5_mean_impute",
    sql=with_ctes("cust")
    + """
SELECT customer_id, age, gender,
       coalesce(income, (SELECT avg(income) FROM cust)) AS income, location, registration_date
FROM cust""",
    rounding={"income": 4},
)
def a5_mean_impute(spark, sf_dir):
    return prep.handle_missing_values(T.customers(spark, sf_dir), numerical="mean")


@query(
    "f1_normalize_features",
    sql=with_ctes("tx")
    + """,
a AS (
  SELECT customer_id, sum(transaction_amount) AS total_spent, count(*) AS n FROM tx
  WHERE customer_id IS NOT NULL GROUP BY customer_id),
s AS (SELECT avg(total_spent) AS m1, stddev_pop(total_spent) AS s1, avg(n) AS m2, stddev_pop(n) AS s2 FROM a)
SELECT customer_id, total_spent, n,
       (total_spent - m1) / CASE WHEN s1 = 0 THEN 1 ELSE s1 END AS total_spent_normalized,
       (n - m2) / CASE WHEN s2 = 0 THEN 1 ELSE s2 END AS n_normalized
FROM a, s""",
    rounding={"total_spent": 4, "total_spent_normalized": 6, "n_normalized": 6},
)
def f1_normalize_features(spark, sf_dir):
    tx = T.transactions(spark, sf_dir)
    a = tx.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.sum("transaction_amount").alias("total_spent"), F.count("*").alias("n")
    )
    return prep.normalize_features(a, ["total_spent", "n"])


INTERACTION_SCHEMA = (
    "customer_id bigint, avg_days_between_purchases double, preferred_category string, "
    "avg_price_range double, purchase_frequency bigint, seasonal_preference bigint"
)


def _c1(spark, sf_dir):
    import uuid

    from kiln.plans.prep_run import run_data_preparation
    from kiln.session import scratch_path

    out = scratch_path(spark, f"prep-run-{uuid.uuid4().hex[:12]}")
    return run_data_preparation(spark, sf_dir, out, as_of=AS_OF)


from kiln.plans.registry import REGISTRY as _REG  # noqa: E402


@query(
    "c1_prepared_interactions",
    sql=_REG["a2_interaction_features"].sql,
    rounding=_REG["a2_interaction_features"].rounding,
)
def c1_prepared_interactions(spark, sf_dir):
    """The whole preparation run; its interaction-features output, read back
    from the written CSV."""
    from kiln.sources import files

    paths = _c1(spark, sf_dir)
    return files.read_table(spark, paths["interaction_features"], "csv", schema=INTERACTION_SCHEMA)

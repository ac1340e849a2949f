"""Readers for the input tables and adapters to the e-commerce data model.

The operators work on three logical tables -- customers, products and
transactions -- with the column names of the original data model. These
adapters derive them from the TPC-H style tables with joins and aggregates
only, so each one grows with its inputs:

* customers   <- customer + nation (+ first order date from orders)
* products    <- part
* transactions<- orders JOIN lineitem
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.dates import as_ts

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table (filters / projections push down)."""
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


# From this many scan partitions per core on, row groups are not looked at: they are
# many, and footers need not be read twice.
MANY = 64


def spread(df: DataFrame) -> DataFrame:
    """Give an under-split scan one partition per core.

    A row group is read by a single task, whatever the size of the file, so of
    a file with one row group all row-local work before the first shuffle (regular
    expressions, tokenisation, the map side of joins and aggregates) would run on
    one core. A scan is cut by bytes: it may have partitions enough and rows in
    few of them, which a count over the footers shows (no column is read).
    Fewer partitions than the cluster's default parallelism, or rows in no more than
    half as many, are spread round-robin; other inputs are left as they are.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    if parts < target or (parts < MANY * target and 2 * _parts_with_rows(df) <= target):
        return df.repartition(max(parts, target))
    return df


def _parts_with_rows(df: DataFrame) -> int:
    return df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*")).count()


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: the transactions table of the data model.

    ``transaction_amount`` is the discounted line price. The join is on the
    order key; both sides are large, so Spark shuffles both on the key (or
    AQE picks a broadcast when a filtered side turns out small).
    """
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("transaction_amount"),
        F.col("l_quantity").alias("quantity"),
        as_ts("o_orderdate").alias("transaction_timestamp"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with age, gender, income, location and registration date.

    * age: a deterministic stand-in ``18 + custkey % 62`` (the table has none);
    * income: account balance, missing where the balance is negative -- real
      missing values for the imputation operators to fill;
    * location: nation name (nation is a fixed 25-row dimension, broadcast
      after its size is checked);
    * registration_date: first order date (missing for customers without
      orders), from a pre-aggregated orders scan.
    """
    cust = read(spark, sf_dir, "customer")
    nation = (
        read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    )
    first_order = (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    return (
        cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
        .join(first_order, cust.c_custkey == first_order.o_custkey, "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            (F.lit(18) + F.col("c_custkey") % 62).cast("bigint").alias("age"),
            F.col("c_mktsegment").alias("gender"),
            F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("income"),
            F.col("n_name").alias("location"),
            as_ts("first_order").alias("registration_date"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products: id, category (brand), price, description (part name)."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_name").alias("product_description"),
    )


# SQL views of the same adapters, shared by the DuckDB oracle statements.
ORACLE_CTES = {
    "tx": """tx AS (
    SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
           o.o_custkey AS customer_id, l.l_partkey AS product_id,
           l.l_extendedprice * (1.0 - l.l_discount) AS transaction_amount,
           l.l_quantity AS quantity, o.o_orderdate AS transaction_timestamp
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "cust": """cust AS (
    SELECT c.c_custkey AS customer_id, CAST(18 + c.c_custkey % 62 AS BIGINT) AS age,
           c.c_mktsegment AS gender,
           CASE WHEN c.c_acctbal >= 0 THEN c.c_acctbal END AS income,
           n.n_name AS location, fo.first_order AS registration_date
    FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) fo
      ON c.c_custkey = fo.o_custkey)""",
    "prod": """prod AS (
    SELECT p_partkey AS product_id, p_brand AS category, p_retailprice AS price,
           p_name AS product_description FROM part)""",
}


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding the named adapter views."""
    return "WITH " + ",\n".join(ORACLE_CTES[n] for n in names)


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric customer frame for the feature operators: ``customer_id, age,
    income, credit_score, category``. ``credit_score`` is the number of
    order lines the customer bought (pre-aggregated per customer before the
    join), ``category`` the market segment."""
    lines = (
        read(spark, sf_dir, "lineitem").select("l_orderkey")
        .join(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
              F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey").agg(F.count("*").cast("double").alias("credit_score"))
    )
    cust = customers(spark, sf_dir)
    return cust.join(lines, cust.customer_id == lines.o_custkey, "left").select(
        "customer_id",
        F.col("age").cast("double").alias("age"),
        "income",
        F.coalesce("credit_score", F.lit(0.0)).alias("credit_score"),
        F.col("gender").alias("category"),
        "registration_date",
    )


ORACLE_CTES["prof"] = """prof AS (
    SELECT cust.customer_id, CAST(cust.age AS DOUBLE) AS age, cust.income,
           coalesce(l.credit_score, 0.0) AS credit_score, cust.gender AS category, cust.registration_date
    FROM cust LEFT JOIN (
        SELECT o.o_custkey, CAST(count(*) AS DOUBLE) AS credit_score
        FROM lineitem li JOIN orders o ON li.l_orderkey = o.o_orderkey GROUP BY o.o_custkey) l
      ON cust.customer_id = l.o_custkey)"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality / toxicity labels and numeric features of
    the whole text: length, word count, digit share, upper-case share, lines."""
    from kiln.functions.text import word_count

    d = read(spark, sf_dir, "documents")
    lab = read(spark, sf_dir, "labels")
    t = F.col("text")
    n = F.char_length(t)
    share = lambda pat: F.try_divide((n - F.char_length(F.regexp_replace(t, pat, ""))).cast("double"), n)
    return d.join(lab, "doc_id").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        word_count(t).cast("double").alias("word_count"),
        share("[0-9]").alias("digit_share"),
        share("[A-Z]").alias("upper_share"),
        (n - F.char_length(F.regexp_replace(t, "\n", "")) + 1).cast("double").alias("line_count"),
        "quality",
        "toxic",
    )


ORACLE_CTES["ldoc"] = """ldoc AS (
    SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS n_chars,
           CAST(CASE WHEN d.text IS NULL THEN NULL WHEN trim(regexp_replace(d.text, '\\s+', ' ', 'g')) = '' THEN 0
                     ELSE len(string_split(trim(regexp_replace(d.text, '\\s+', ' ', 'g')), ' ')) END AS DOUBLE) AS word_count,
           CASE WHEN length(d.text) = 0 THEN NULL ELSE
             CAST(length(d.text) - length(regexp_replace(d.text, '[0-9]', '', 'g')) AS DOUBLE) / length(d.text) END AS digit_share,
           CASE WHEN length(d.text) = 0 THEN NULL ELSE
             CAST(length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g')) AS DOUBLE) / length(d.text) END AS upper_share,
           CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS DOUBLE) AS line_count,
           l.quality, l.toxic
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

"""Synthetic customers, products and transactions.

Categories come from given tables: the caller passes the tables whose values are
to be drawn. Draws use Spark's seeded ``rand`` / ``randn``, so generation is
distributed (``spark.range``) and repeatable per seed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Vocabulary:
    """Values to draw from."""

    genders: list[str]
    locations: list[str]
    categories: list[str]


def vocabulary(genders: DataFrame, locations: DataFrame, categories: DataFrame, most: int = 1000) -> Vocabulary:
    """The distinct values of one column of each table, at most ``most`` of each (in sorted order)."""

    def values(df: DataFrame) -> list[str]:
        c = df.columns[0]
        rows = df.where(F.col(c).isNotNull()).distinct().orderBy(c).limit(most).collect()
        if not rows:
            raise ValueError(f"no value of {c} to draw from")
        return [r[0] for r in rows]

    return Vocabulary(values(genders), values(locations), values(categories))


def _pick(values: list[str], seed: int) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(F.rand(seed) * len(values)) + 1).cast("int"))


def generate(spark: SparkSession, words: Vocabulary, n_customers: int = 1000, n_products: int = 500,
             n_transactions: int = 5000, seed: int = 42, as_of: str = "2024-01-01 00:00:00"):
    """(customers, products, transactions) DataFrames."""
    now = F.lit(as_of).cast("timestamp")
    customers = spark.range(n_customers).select(
        F.format_string("CUST_%06d", "id").alias("customer_id"),
        (F.floor(F.rand(seed) * 62) + 18).cast("bigint").alias("age"),
        _pick(words.genders, seed + 1).alias("gender"),
        (F.randn(seed + 2) * 15000 + 50000).alias("income"),
        _pick(words.locations, seed + 3).alias("location"),
        (now - F.make_interval(days=(F.floor(F.rand(seed + 4) * 999) + 1).cast("int"))).alias("registration_date"),
    )
    products = spark.range(n_products).select(
        F.format_string("PROD_%06d", "id").alias("product_id"),
        _pick(words.categories, seed + 5).alias("category"),
        (F.rand(seed + 6) * 490 + 10).alias("price"),
    )
    products = products.withColumn("product_description", F.concat_ws(" ", "category", F.substring("product_id", 6, 6)))
    transactions = spark.range(n_transactions).select(
        F.format_string("TXN_%08d", "id").alias("transaction_id"),
        F.format_string("CUST_%06d", F.floor(F.rand(seed + 7) * n_customers).cast("int")).alias("customer_id"),
        F.format_string("PROD_%06d", F.floor(F.rand(seed + 8) * n_products).cast("int")).alias("product_id"),
        (F.rand(seed + 9) * 290 + 10).alias("transaction_amount"),
        (now - F.make_interval(days=(F.floor(F.rand(seed + 10) * 364) + 1).cast("int"))).alias("transaction_timestamp"),
    )
    return customers, products, transactions

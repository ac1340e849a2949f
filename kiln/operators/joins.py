"""Set comparisons J2-J4, J7."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Referential integrity (J2): distinct child keys absent from the parent.

    Returns one row: ``customers_count`` (distinct parent keys),
    ``unique_customers_in_transactions`` (distinct child keys),
    ``orphaned_transaction_customers`` and ``integrity_score``
    (``1 - orphans / distinct child keys``; 1 when there are none).
    The anti join is written as one ``groupBy`` over the union of both key
    sets (one shuffle, combined map-side), then a global count.
    """
    parent_key = parent_key or key
    ck = child.select(F.col(key).alias("k"), F.lit(1).alias("c"), F.lit(0).alias("p"))
    pk = parent.select(F.col(parent_key).alias("k"), F.lit(0).alias("c"), F.lit(1).alias("p"))
    per_key = (
        ck.unionByName(pk)
        .where(F.col("k").isNotNull())
        .groupBy("k")
        .agg(F.max("c").alias("c"), F.max("p").alias("p"))
    )
    row = per_key.agg(
        F.count_if(F.col("p") == 1).alias("customers_count"),
        F.count_if(F.col("c") == 1).alias("unique_customers_in_transactions"),
        F.count_if((F.col("c") == 1) & (F.col("p") == 0)).alias("orphaned_transaction_customers"),
    )
    return row.withColumn(
        "integrity_score",
        F.when(
            F.col("unique_customers_in_transactions") > 0,
            F.lit(1.0) - F.col("orphaned_transaction_customers") / F.col("unique_customers_in_transactions"),
        ).otherwise(F.lit(1.0)),
    )


def column_diff(left: DataFrame, right: DataFrame) -> dict[str, list[str]]:
    """Column-name sets both ways and the common columns (J4; metadata only)."""
    lc, rc = list(left.columns), list(right.columns)
    return {
        "only_left": [c for c in lc if c not in rc],
        "only_right": [c for c in rc if c not in lc],
        "common": [c for c in lc if c in rc],
    }

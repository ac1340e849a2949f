"""The whole data-preparation run (C1): verify -> ingest -> quality ->
transform -> save.

Spark shape of the run: the joined customers and transactions feed several
outputs, so each is written once as Parquet in the shared folder (survives the
loss of executors; every output reads only its columns). Products are a scan.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from kiln.operators import prep
from kiln.operators.quality import quality_report
from kiln.session import staged
from kiln.sources import files
from kiln.sources import tables as T

OUTPUTS = ("customer_features", "product_features", "customer_aggregated", "interaction_features")


def run_data_preparation(spark: SparkSession, sf_dir: str, out_dir: str, as_of: str,
                         fmt: str = "csv", tfidf: bool = True) -> dict[str, str]:
    """Run the preparation over the tables in ``sf_dir``; returns the output
    paths (four tables plus one quality report per input)."""
    files.require_inputs(spark, [f"{sf_dir}/{t}.parquet" for t in ("customer", "nation", "part", "orders", "lineitem")])

    customers = staged(T.customers(spark, sf_dir), "customers")
    products = T.products(spark, sf_dir)
    tx = staged(T.transactions(spark, sf_dir), "transactions")

    paths: dict[str, str] = {}
    for name, df in (("customer", customers), ("product", products), ("transaction", tx)):
        p = os.path.join(out_dir, "quality", name)
        files.write_table(quality_report(df, written=df is not products), p, "json")
        paths[f"quality_{name}"] = p

    clean = prep.clean_customers(customers, as_of=as_of)
    aggregated = prep.customer_aggregates(tx)
    product_feats = prep.product_features(products, tfidf=tfidf)
    interactions = prep.interaction_features(clean, tx)

    for name, df in zip(OUTPUTS, (clean, product_feats, aggregated, interactions)):
        p = os.path.join(out_dir, name)
        files.write_table(df, p, fmt)
        paths[name] = p
    return paths

"""Every output of the whole preparation run (C1), read back from where the run wrote it.

The oracle of an output is that of the operator behind it.
"""

from __future__ import annotations

import uuid

from kiln.plans import q_prep, q_quality  # noqa: F401  (their oracles)
from kiln.plans.prep_run import run_data_preparation
from kiln.plans.registry import REGISTRY, query
from kiln.session import scratch_path
from kiln.sources import files

REPORT = "section string, column string, metric string, value double, text string"


def outputs(spark, sf_dir) -> dict[str, str]:
    """Paths of a run's outputs, tables as Parquet."""
    out = scratch_path(spark, f"prep-run-{uuid.uuid4().hex}")
    return run_data_preparation(spark, sf_dir, out, as_of=q_prep.AS_OF, fmt="parquet")


def _like(name: str, source: str):
    return query(name, sql=REGISTRY[source].sql, rounding=REGISTRY[source].rounding)


@_like("c1_customer_features", "f16_clean_customers")
def c1_customer_features(spark, sf_dir):
    return files.read_table(spark, outputs(spark, sf_dir)["customer_features"])


@_like("c1_customer_aggregated", "a1_customer_aggregate")
def c1_customer_aggregated(spark, sf_dir):
    return files.read_table(spark, outputs(spark, sf_dir)["customer_aggregated"])


@_like("c1_product_features", "f15_product_features")
def c1_product_features(spark, sf_dir):
    """Without the TF-IDF columns, which have an oracle of their own in long form."""
    out = files.read_table(spark, outputs(spark, sf_dir)["product_features"])
    return out.drop(*[c for c in out.columns if c.startswith("tfidf_")])


@_like("c1_quality_customers", "a11_quality_report")
def c1_quality_customers(spark, sf_dir):
    """The quality report of the customers, as the run's JSON lines."""
    return files.read_table(spark, outputs(spark, sf_dir)["quality_customer"], "json", schema=REPORT)

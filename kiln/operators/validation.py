"""All data checks of a validation run in one pass, with their report.

The inputs are written once and registered in the catalog; the checks read the
columns they need from there, so a join behind an input runs once however many
checks there are. The report is one row per check next to a summary row, both
JSON lines, and can be read back.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.operators import quality as Q
from kiln.operators.joins import orphan_keys
from kiln.session import scratch_path
from kiln.sources import catalog, files

CHECK_SCHEMA = "section string, check string, column string, value double, passed boolean"
SUMMARY_SCHEMA = "as_of string, total_checks bigint, passed_checks bigint, failed_checks bigint, overall_status string"


def data_checks(customers: DataFrame, tx: DataFrame, as_of: str) -> DataFrame:
    """``check, value, passed`` of integrity (J2), consistency (A16) and the scores."""
    integrity = orphan_keys(tx, customers, "customer_id").select(
        F.lit("referential_integrity").alias("check"),
        F.col("integrity_score").alias("value"),
        (F.col("orphaned_transaction_customers") == 0).alias("passed"),
    )
    consistent = Q.consistency(customers, tx).groupBy("check").agg(F.sum("value").cast("double").alias("value")).select(
        "check", "value", (F.col("value") == 0).alias("passed")
    )

    def score(name: str, df: DataFrame) -> DataFrame:
        value = F.col("data_quality_score")
        return df.select(F.lit(name).alias("check"), value.alias("value"), (value >= 0.8).alias("passed"))

    return (
        integrity.unionByName(consistent)
        .unionByName(score("customer_quality", Q.customer_quality(customers)))
        .unionByName(score("transaction_quality", Q.transaction_quality(tx, as_of=as_of)))
    )


def _completeness(name: str, df: DataFrame) -> DataFrame:
    return Q.completeness(df).select(
        F.lit("completeness").alias("section"), F.lit(name).alias("check"), "column",
        F.col("completeness").alias("value"), F.lit(None).cast("boolean").alias("passed"),
    )


def _metadata_rows(spark: SparkSession, database: str, tables: dict[str, DataFrame], expected: dict[str, dict[str, str]]) -> DataFrame:
    """Schemas (A14: value = columns missing or of another type) and catalog entries (S17: value = columns)."""
    rows = []
    for name, declared in expected.items():
        report = Q.schema_report_lenient(tables[name], declared)
        wrong = len(report["missing_columns"]) + len(report["type_mismatches"])
        rows.append(("schema", name, None, float(wrong), report["schema_valid"]))
    for entry in catalog.catalog_check(spark, database, list(tables)):
        rows.append(("catalog", entry["table"], None, float(entry.get("columns", 0)), entry["exists"]))
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def validation_run(
    customers: DataFrame, tx: DataFrame, expected: dict[str, dict[str, str]], as_of: str, out_dir: str
) -> tuple[DataFrame, DataFrame]:
    """Run every check, write the report under ``out_dir`` and return it read back.

    ``expected`` declares the columns of ``customers`` and ``transactions`` by type
    family. Checks without a limit (completeness) have a null ``passed`` and count
    neither as passed nor as failed; of an empty table they have a null value. The
    run has passed if no check failed.
    """
    spark = customers.sparkSession
    run = f"validation_{uuid.uuid4().hex}"
    root = scratch_path(spark, run)
    for name, df in (("customers", customers), ("transactions", tx)):
        files.write_table(df, f"{root}/{name}", "parquet")
    catalog.crawl(spark, run, root)
    try:
        tables = {name: spark.table(f"{run}.{name}") for name in ("customers", "transactions")}
        checks = data_checks(tables["customers"], tables["transactions"], as_of).select(
            F.lit("data").alias("section"), "check", F.lit(None).cast("string").alias("column"), "value", "passed"
        )
        for name, df in tables.items():
            checks = checks.unionByName(_completeness(name, df))
        checks = checks.unionByName(_metadata_rows(spark, run, tables, expected))
        write_report(checks, F.lit(as_of), out_dir)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{run}` CASCADE")  # external tables: their files stay
    return read_report(spark, out_dir)


def write_report(checks: DataFrame, as_of: Column, out_dir: str) -> None:
    """The checks as JSON lines, then their summary (A23) from what was written."""
    where = os.path.join(out_dir, "checks")
    files.write_table(checks, where, "json")
    stored = checks.sparkSession.read.schema(CHECK_SCHEMA).json(where)
    summary = Q.rollup_checks(stored.where("passed IS NOT NULL")).select(as_of.alias("as_of"), "*")
    files.write_table(summary, os.path.join(out_dir, "summary"), "json")


def read_report(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(checks, summary)`` of a written report."""
    return (
        spark.read.schema(CHECK_SCHEMA).json(os.path.join(out_dir, "checks")),
        spark.read.schema(SUMMARY_SCHEMA).json(os.path.join(out_dir, "summary")),
    )

"""The validation run: its checks, its report and how often it reads its inputs."""

import uuid
from datetime import datetime

from kiln.operators import validation
from kiln.session import scratch_path

CUST = "customer_id bigint, age bigint, gender string, income double, registration_date timestamp"
TX = "transaction_id string, customer_id bigint, transaction_amount double, quantity double, transaction_timestamp timestamp"
AT = datetime(2024, 1, 1)
EXPECTED = {"customers": {"customer_id": "int64", "gender": "int64"}, "transactions": {"customer_id": "int64"}}


def _run(spark, cust, tx):
    out = scratch_path(spark, f"test-validation-{uuid.uuid4().hex}")
    checks, summary = validation.validation_run(cust, tx, EXPECTED, "2024-06-01 00:00:00", out)
    return {(r.section, r.check, r.column): (r.value, r.passed) for r in checks.collect()}, summary.first()


def test_report_of_small_tables(spark):
    cust = spark.createDataFrame([(1, 30, "f", 10.0, AT), (2, None, "m", float("nan"), AT)], CUST)
    tx = spark.createDataFrame([("a", 1, 5.0, 1.0, AT), ("b", 3, 5.0, 1.0, AT)], TX)
    before = {d.name for d in spark.catalog.listDatabases()}
    checks, summary = _run(spark, cust, tx)
    assert checks["data", "referential_integrity", None] == (0.5, False)
    assert checks["completeness", "customers", "age"] == (0.5, None)
    assert checks["completeness", "customers", "income"] == (0.5, None)  # NaN is missing
    assert checks["schema", "customers", None] == (1.0, False)  # gender is no integer
    assert checks["schema", "transactions", None] == (0.0, True)
    assert checks["catalog", "transactions", None] == (5.0, True)
    judged = [passed for _, passed in checks.values() if passed is not None]
    assert (summary.total_checks, summary.passed_checks) == (len(judged), sum(judged))
    assert summary.overall_status == "FAILED" and summary.failed_checks == len(judged) - sum(judged)
    assert {d.name for d in spark.catalog.listDatabases()} == before


def test_empty_tables_have_a_report(spark):
    checks, summary = _run(spark, spark.createDataFrame([], CUST), spark.createDataFrame([], TX))
    assert checks["completeness", "customers", "age"] == (None, None)
    assert checks["data", "referential_integrity", None] == (1.0, True)
    assert summary.total_checks > 0


def test_inputs_are_evaluated_once(spark):
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    def count(v):
        seen.add(1)
        return v

    counted = F.udf(count, "bigint")
    cust = spark.createDataFrame([(i, 30, "f", 1.0, AT) for i in range(20)], CUST).withColumn("age", counted("age"))
    tx = spark.createDataFrame([(str(i), i % 20, 5.0, 1.0, AT) for i in range(40)], TX)
    _run(spark, cust, tx)
    assert seen.value == 20

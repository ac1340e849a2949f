"""Queries of the sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.plans.registry import query
from kiln.session import scratch_path
from kiln.sources import feature_table as FT
from kiln.sources import files
from kiln.sources import tables as T
from kiln.sources.catalog import safe_query
from kiln.sources.tables import read, with_ctes

CUST_SCHEMA = (
    "customer_id bigint, age bigint, gender string, income double, location string, registration_date timestamp"
)
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
FEATURE_AS_OF = "2002-01-01 00:00:00"
EARLY_AS_OF = "1998-01-01 00:00:00"


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("s1_csv_roundtrip", sql=with_ctes("cust") + "\nSELECT * FROM cust")
def s1_csv_roundtrip(spark, sf_dir):
    """Customers written as CSV with a header and read back with the
    declared schema (S1, S9)."""
    path = _scratch(spark, "customers-csv")
    files.write_table(T.customers(spark, sf_dir), path, "csv")
    return files.read_table(spark, path, "csv", schema=CUST_SCHEMA)


@query("s3_json_roundtrip", sql="SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s3_json_roundtrip(spark, sf_dir):
    """Events written as JSON lines and read back with the schema (S3)."""
    path = _scratch(spark, "events-json")
    files.write_table(read(spark, sf_dir, "events"), path, "json")
    return files.read_table(spark, path, "json", schema=EVENT_SCHEMA)


@query(
    "s2_parquet_scan",
    sql="SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity > 25",
)
def s2_parquet_scan(spark, sf_dir):
    """Parquet scan with the projection and the filters pushed into the reader."""
    li = files.read_table(spark, f"{sf_dir}/lineitem.parquet", "parquet")
    return li.where((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 25)).select(
        "l_orderkey", "l_partkey", "l_quantity"
    )


@query(
    "s7_union_by_name",
    sql="""
SELECT c_custkey AS party_key, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, 'customer' AS kind FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS party_key, s_name AS name, s_acctbal AS acctbal, 'supplier' AS kind FROM supplier""",
)
def s7_union_by_name(spark, sf_dir):
    """Customers and suppliers concatenated by column name; the segment
    missing on the supplier side becomes NULL (S7)."""
    c = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("kind"),
    )
    s = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"),
        F.lit("supplier").alias("kind"),
    )
    return files.union_by_name([c, s])


@query(
    "s10_partition_pruning",
    sql=with_ctes("tx") + """
SELECT transaction_id, customer_id, product_id, transaction_amount, quantity, transaction_timestamp,
       year(transaction_timestamp) AS year, month(transaction_timestamp) AS month
FROM tx WHERE year(transaction_timestamp) = 1998 AND month(transaction_timestamp) IN (1, 2)""",
    rounding={"transaction_amount": 4},
)
def s10_partition_pruning(spark, sf_dir):
    """Transactions written as ``year=/month=`` partitions; reading two
    months touches only their folders (S10)."""
    path = _scratch(spark, "transactions-by-month")
    files.write_by_month(T.transactions(spark, sf_dir), path, "transaction_timestamp")
    back = spark.read.parquet(path)
    out = back.where((F.col("year") == 1998) & F.col("month").isin(1, 2))
    return out.withColumns({"year": F.col("year").cast("bigint"), "month": F.col("month").cast("bigint")})


@query(
    "s12_parametrised_sql",
    sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 100000.0""",
)
def s12_parametrised_sql(spark, sf_dir):
    """Bound parameters, never text splicing."""
    return safe_query(
        spark,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderpriority = :prio AND o_totalprice > :low",
        {"prio": "1-URGENT", "low": 100000.0},
        orders=read(spark, sf_dir, "orders"),
    )


CUST_COLS = ["customer_id", "age", "gender", "income", "location", "registration_date"]
EARLY_REG = "1997-01-01 00:00:00"


def _records_sql(src: str, as_of: str) -> str:
    """Long form of the records: one row per present (non-missing) value."""
    parts = [
        f"SELECT customer_id AS record_id, TIMESTAMP '{as_of}' AS event_time, '{c}' AS feature_name, "
        f"CAST({c} AS VARCHAR) AS value FROM {src} WHERE {c} IS NOT NULL"
        for c in CUST_COLS
    ] + [
        f"SELECT customer_id, TIMESTAMP '{as_of}', 'event_time', '{as_of}' FROM {src}"
    ]
    return "\nUNION ALL\n".join(parts)


def _explode_records(rec):
    return rec.select("record_id", "event_time", F.explode("record").alias("feature_name", "value"))


@query(
    "s13_feature_records",
    sql=with_ctes("cust") + "\n" + _records_sql("cust", FEATURE_AS_OF),
)
def s13_feature_records(spark, sf_dir):
    """Customers as feature records: name -> value as text, missing values
    left out, event time defaulted (S13)."""
    rec = FT.feature_records(T.customers(spark, sf_dir), "customer_id", F.lit(FEATURE_AS_OF).cast("timestamp"))
    return _explode_records(rec)


_LATEST_CTES = f"""{with_ctes("cust")},
early AS (SELECT * FROM cust WHERE registration_date < TIMESTAMP '{EARLY_REG}'),
r AS ({_records_sql('early', EARLY_REG)}
      UNION ALL
      {_records_sql('cust', FEATURE_AS_OF)}),
latest AS (SELECT record_id, max(event_time) AS event_time FROM r GROUP BY record_id)"""


def _customer_group(spark, cust) -> FT.FeatureGroup:
    """A group that took two batches: customers registered before 1997, then all customers."""
    group = FT.FeatureGroup(
        f"customer_features_{uuid.uuid4().hex[:12]}", "customer_id", "event_time",
        f"{CUST_SCHEMA}, event_time timestamp", _scratch(spark, "feature-group"),
    )
    group.create(spark)
    group.append(cust.where(F.col("registration_date") < F.lit(EARLY_REG).cast("timestamp")), F.lit(EARLY_REG).cast("timestamp"))
    group.append(cust, F.lit(FEATURE_AS_OF).cast("timestamp"))
    return group


@query(
    "s15_latest_records",
    sql=_LATEST_CTES + """
SELECT r.* FROM r JOIN latest ON r.record_id = latest.record_id AND r.event_time = latest.event_time""",
)
def s15_latest_records(spark, sf_dir):
    """The newest record per id of a group with two batches."""
    return _explode_records(_customer_group(spark, T.customers(spark, sf_dir)).latest(spark))


@query(
    "s14_feature_lookup",
    sql=_LATEST_CTES + """
SELECT cust.*, latest.event_time FROM cust JOIN latest ON latest.record_id = cust.customer_id
WHERE cust.customer_id IN (SELECT o_custkey FROM orders)""",
)
def s14_feature_lookup(spark, sf_dir):
    """The newest features, in their declared types, of every customer with an order."""
    group = _customer_group(spark, T.customers(spark, sf_dir))
    return group.typed(group.lookup(read(spark, sf_dir, "orders").select("o_custkey")))


def _inventory(spark, sf_dir):
    stored = files.stored_rows({t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in T.TABLE_NAMES})
    return files.storage_inventory(spark, sf_dir, expected=T.TABLE_NAMES).join(stored, "prefix", "left")


@query("s16_storage_inventory")
def s16_storage_inventory(spark, sf_dir):
    """Files, bytes, newest modification and rows per table folder of the input."""
    return _inventory(spark, sf_dir)


@query(
    "s16_stored_rows",
    sql="\nUNION ALL\n".join(
        f"SELECT '{t}' AS prefix, true AS has_files, count(*) AS \"rows\" FROM {t}" for t in T.TABLE_NAMES
    ),
)
def s16_stored_rows(spark, sf_dir):
    """The part of the inventory that SQL can say: which tables are there and their rows."""
    return _inventory(spark, sf_dir).select("prefix", (F.col("files") > 0).alias("has_files"), "rows")

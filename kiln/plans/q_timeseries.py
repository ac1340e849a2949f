"""Queries of the time-series operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import timeseries as TS
from kiln.plans.registry import query
from kiln.sources import tables as T
from kiln.sources.tables import read, with_ctes

TS_ROUND = {
    "sales": 4,
    "month_sin": 6, "month_cos": 6, "day_sin": 6, "day_cos": 6,
    "sales_ma_7": 6, "sales_ma_30": 6, "sales_std_7": 6,
    "sales_lag_1": 4, "sales_lag_7": 4, "sales_lag_30": 4,
}


def sql_features(src: str, key: str) -> str:
    """Feature SELECT over ``src(key, date, sales)``."""
    w = f"PARTITION BY {key} ORDER BY date"
    def roll(n, fn):
        frame = f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        return f"CASE WHEN count(sales) OVER {frame} = {n} THEN {fn}(sales) OVER {frame} END"
    return f"""
SELECT {key}, date, sales,
       year(date) AS year, month(date) AS month, CAST(isodow(date) - 1 AS BIGINT) AS day_of_week,
       dayofyear(date) AS day_of_year, quarter(date) AS quarter,
       CAST(isodow(date) - 1 >= 5 AS BIGINT) AS is_weekend,
       sin(2 * pi() * month(date) / 12.0) AS month_sin, cos(2 * pi() * month(date) / 12.0) AS month_cos,
       sin(2 * pi() * (isodow(date) - 1) / 7.0) AS day_sin, cos(2 * pi() * (isodow(date) - 1) / 7.0) AS day_cos,
       {roll(7, 'avg')} AS sales_ma_7, {roll(30, 'avg')} AS sales_ma_30, {roll(7, 'stddev_samp')} AS sales_std_7,
       lag(sales, 1) OVER ({w}) AS sales_lag_1, lag(sales, 7) OVER ({w}) AS sales_lag_7,
       lag(sales, 30) OVER ({w}) AS sales_lag_30
FROM {src}"""


def sql_daily(table: str, key: str, ts: str, value: str) -> str:
    return f"""d AS (SELECT {key}, CAST({ts} AS DATE) AS date, sum({value}) AS sales FROM {table} GROUP BY 1, 2),
b AS (SELECT {key}, min(date) AS lo, max(date) AS hi FROM d GROUP BY 1),
cal AS (SELECT {key}, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
s AS (SELECT cal.{key}, cal.date, coalesce(CAST(d.sales AS DOUBLE), 0.0) AS sales
      FROM cal LEFT JOIN d ON cal.{key} = d.{key} AND cal.date = d.date)"""


def _series(spark, sf_dir, table, key, ts, value):
    s = TS.daily_series(read(spark, sf_dir, table), key, ts, value)
    return TS.fill_calendar(s, key).withColumnRenamed("value", "sales")


@query(
    "f20_event_series_features",
    sql="WITH " + sql_daily("events", "event_type", "ts", "value") + sql_features("s", "event_type"),
    rounding=TS_ROUND,
)
def f20_event_series_features(spark, sf_dir):
    """Daily value per event type, every calendar feature, rolling means /
    std and lags."""
    s = _series(spark, sf_dir, "events", "event_type", "ts", "value")
    return TS.time_series_features(s, "event_type")


@query(
    "f20_order_series_features",
    sql="WITH " + sql_daily("orders", "o_orderpriority", "o_orderdate", "o_totalprice") + sql_features("s", "o_orderpriority"),
    rounding=TS_ROUND,
)
def f20_order_series_features(spark, sf_dir):
    """Daily order value per priority, the same feature set."""
    s = _series(spark, sf_dir, "orders", "o_orderpriority", "o_orderdate", "o_totalprice")
    return TS.time_series_features(s, "o_orderpriority")


@query(
    "w8_daily_calendar",
    sql="""
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
d AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1)
SELECT cal.date, coalesce(d.n, 0) AS orders FROM cal LEFT JOIN d ON cal.date = d.date""",
)
def w8_daily_calendar(spark, sf_dir):
    """Every day between the first and last order, with its order count."""
    o = read(spark, sf_dir, "orders")
    daily = o.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count("*").alias("orders"))
    bounds = daily.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    from kiln.functions.dates import daily_range

    cal = bounds.select(F.explode(daily_range(F.col("lo"), F.col("hi"))).alias("date"))
    return cal.join(daily, "date", "left").select("date", F.coalesce("orders", F.lit(0)).alias("orders"))


@query(
    "w3_purchase_gaps",
    sql=with_ctes("tx") + """,
p AS (SELECT customer_id, transaction_timestamp, count(*) AS n_rows FROM tx
      WHERE customer_id IS NOT NULL AND transaction_timestamp IS NOT NULL GROUP BY 1, 2)
SELECT customer_id, transaction_timestamp, n_rows,
       CAST(floor((epoch_us(transaction_timestamp)
                  - epoch_us(lag(transaction_timestamp) OVER (PARTITION BY customer_id ORDER BY transaction_timestamp)))
                  / 86400000000.0) AS BIGINT) AS gap_days
FROM p""",
)
def w3_purchase_gaps(spark, sf_dir):
    return TS.ordered_gaps(T.transactions(spark, sf_dir), "customer_id", "transaction_timestamp")

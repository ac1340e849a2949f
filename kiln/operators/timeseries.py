"""Time-series features (F20 = W8, P6, P5, P7, W1, W2) and ordered gaps.

A raw event table is first reduced to one row per (series, day) -- a
partial/final aggregate -- so every window below partitions by series and
holds at most one row per calendar day of that series, whatever the volume
of raw events. Rolling statistics follow the pandas rule: missing until the
window holds ``n`` values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions import dates


def daily_series(df: DataFrame, key: str, ts_col: str, value_col: str, agg: str = "sum") -> DataFrame:
    """Aggregate raw rows to ``(key, date, value)`` per calendar day."""
    fn = {"sum": F.sum, "avg": F.avg, "count": F.count}[agg]
    return df.groupBy(F.col(key), F.to_date(dates.as_ts(ts_col)).alias("date")).agg(fn(value_col).alias("value"))


def fill_calendar(series: DataFrame, key: str, value_col: str = "value", fill: float = 0.0) -> DataFrame:
    """Every day from the first to the last date of each series (W8), with
    missing days filled: ``explode(sequence(first, last, 1 day))`` per key,
    then a join on (key, date)."""
    bounds = series.groupBy(key).agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    cal = bounds.select(key, F.explode(dates.daily_range(F.col("lo"), F.col("hi"))).alias("date"))
    return cal.join(series, [key, "date"], "left").withColumn(
        value_col, F.coalesce(F.col(value_col).cast("double"), F.lit(float(fill)))
    )


def rolling(x: Column, w: Window, n: int, fn) -> Column:
    """``fn`` over the last ``n`` rows, missing unless all ``n`` are present."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(x).over(frame) == n, fn(x).over(frame))


def time_series_features(
    df: DataFrame,
    key: str,
    date_col: str = "date",
    value_col: str = "sales",
    windows: Sequence[int] = (7, 30),
    std_windows: Sequence[int] = (7,),
    lags: Sequence[int] = (1, 7, 30),
) -> DataFrame:
    """Calendar parts, weekend flag, cyclical month / weekday, rolling means
    and sample stds, and lags of ``value_col`` within each series."""
    d = F.col(date_col)
    out = df.withColumns(
        {
            "year": F.year(d).cast("bigint"),
            "month": F.month(d).cast("bigint"),
            "day_of_week": dates.weekday_mon0(d),
            "day_of_year": F.dayofyear(d).cast("bigint"),
            "quarter": F.quarter(d).cast("bigint"),
        }
    )
    out = out.withColumn("is_weekend", (F.col("day_of_week") >= 5).cast("bigint"))
    m_sin, m_cos = dates.cyclical(F.col("month"), 12)
    d_sin, d_cos = dates.cyclical(F.col("day_of_week"), 7)
    out = out.withColumns({"month_sin": m_sin, "month_cos": m_cos, "day_sin": d_sin, "day_cos": d_cos})
    w = Window.partitionBy(key).orderBy(date_col)
    x = F.col(value_col)
    feats = {}
    for n in windows:
        feats[f"{value_col}_ma_{n}"] = rolling(x, w, n, F.avg)
    for n in std_windows:
        feats[f"{value_col}_std_{n}"] = rolling(x, w, n, F.stddev_samp)
    for n in lags:
        feats[f"{value_col}_lag_{n}"] = F.lag(x, n).over(w)
    return out.withColumns(feats)


def ordered_gaps(df: DataFrame, key: str, ts_col: str) -> DataFrame:
    """Whole-day gap to the previous distinct timestamp of the same key.

    A timestamp that is not the first of its calendar day follows one less
    than a day earlier, so its gap is 0; only a day's first timestamp needs
    the last timestamp of the key's previous active day. The ordered window
    therefore runs over (key, day) rows -- at most one per calendar day of a
    key -- and a join on (key, day) brings the gaps back to the timestamps
    (a hot key-day is split by the adaptive skew-join handling).
    """
    per_ts = (
        df.where(F.col(key).isNotNull() & F.col(ts_col).isNotNull())
        .groupBy(key, dates.as_ts(ts_col).alias(ts_col))
        .agg(F.count("*").alias("n_rows"))
        .withColumn("__d", F.to_date(ts_col))
    )
    w = Window.partitionBy(key).orderBy("__d")
    days = (
        per_ts.groupBy(key, "__d")
        .agg(F.min(ts_col).alias("__first"), F.max(ts_col).alias("__last"))
        .withColumn("__prev_last", F.lag("__last").over(w))
        .select(key, "__d", "__first", "__prev_last")
    )
    gap = F.when(
        F.col(ts_col) == F.col("__first"), dates.elapsed_days(F.col(ts_col), F.col("__prev_last"))
    ).otherwise(F.lit(0).cast("bigint"))
    return per_ts.join(days, [key, "__d"]).select(key, ts_col, "n_rows", gap.alias("gap_days"))

"""The data-preparation pipeline operators.

Every operator is ``DataFrame -> DataFrame``. Fitted statistics (medians,
means, modes, the maximum timestamp) are computed by Spark aggregates; only
scalars reach the driver, and they enter the plan as literals or as a scalar
subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from kiln.functions import dates, numeric, text
from kiln.functions.stats import exact_quantiles, fit_row, mode_per_group
from kiln.operators.encoding import LabelEncoder
from kiln.session import cut_lineage


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type (P23: ``select_dtypes(include=number)``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


# --------------------------------------------------------------------------
# Transactions (P1, P3, P4, P5, P8) and the customer aggregate (A1)
# --------------------------------------------------------------------------

def enrich_transactions(tx: DataFrame, ts_col: str = "transaction_timestamp") -> DataFrame:
    """Add date, hour, weekday (Mon=0), month, weekend flag and the whole days
    since the table's latest transaction.

    The latest timestamp is a scalar subquery: computed once by a global
    (partial + final) aggregate and inlined, no join.
    """
    ts = dates.as_ts(ts_col)
    latest = tx.select(F.max(ts)).scalar()
    return tx.withColumns(
        {
            ts_col: ts,
            "transaction_date": F.to_date(ts),
            "hour_of_day": F.hour(ts).cast("bigint"),
            "day_of_week": dates.weekday_mon0(ts),
            "month": F.month(ts).cast("bigint"),
            "is_weekend": dates.is_weekend(ts),
            "days_since_transaction": dates.elapsed_days(latest, ts),
        }
    )


def customer_aggregates(
    tx: DataFrame,
    key: str = "customer_id",
    amount: str = "transaction_amount",
    product: str = "product_id",
    ts_col: str = "transaction_timestamp",
) -> DataFrame:
    """Per customer: total, mean, count, sample std (missing -> 0) of the
    amount, recency in whole days, distinct products (A1).

    Recency is ``min(days since the latest transaction)``; the floor of
    elapsed days is monotone in the timestamp, so it equals the elapsed days
    between the table's latest timestamp and the customer's latest one. The
    aggregate therefore needs a single shuffle of the transactions (the
    distinct count is planned as a (customer, product) pre-aggregation), and
    the global latest timestamp is read from the much smaller result.
    NULL customer keys are dropped, as ``groupby`` does.
    """
    ts = dates.as_ts(ts_col)
    # The NULL-customer group is kept until the global latest timestamp has
    # been read from the (small) aggregate: the latest transaction of the
    # whole table counts even when its customer is missing.
    agg = tx.groupBy(key).agg(
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("total_spent"),
        F.avg(amount).alias("avg_transaction_amount"),
        F.count(amount).alias("transaction_count"),
        F.coalesce(F.stddev_samp(amount), F.lit(0.0)).alias("transaction_amount_std"),
        F.max(ts).alias("__last"),
        F.countDistinct(product).alias("unique_products_purchased"),
    )
    # The aggregate (one row per customer) is written once to the shared
    # checkpoint folder; the global latest is a scalar read of it, so the
    # transactions are scanned and joined once.
    agg = cut_lineage(agg)
    latest = agg.select(F.max("__last")).scalar()
    return agg.where(F.col(key).isNotNull()).withColumn(
        "recency_days", dates.elapsed_days(latest, F.col("__last"))
    ).select(
        key,
        "total_spent",
        "avg_transaction_amount",
        "transaction_count",
        "transaction_amount_std",
        "recency_days",
        "unique_products_purchased",
    )


# --------------------------------------------------------------------------
# Interaction features (A2 with J1 and W3)
# --------------------------------------------------------------------------

def interaction_features(
    customers: DataFrame,
    tx: DataFrame,
    key: str = "customer_id",
    amount: str = "transaction_amount",
    ts_col: str = "transaction_timestamp",
    category: str | None = None,
) -> DataFrame:
    """Per customer present in both tables: mean amount, number of purchases,
    modal month (ties -> smallest), mean whole-day gap between consecutive
    purchases (0 for a single purchase); ``preferred_category`` is NULL unless
    ``category`` names a column of ``tx``, whose modal value it then is (ties ->
    smallest, NULL values not counted).

    Skew safety: transactions are first combined map-side into one row per
    (customer, calendar day) with the day's first and last timestamp --
    gaps inside a day are 0 -- so the per-customer ordered window sees at
    most one row per active day, however many rows a hot customer has. The
    modal month and the counts come from the same pre-aggregate. A customer
    row that appears twice in ``customers`` yields two output rows (inner
    join semantics).
    """
    ts = dates.as_ts(ts_col)
    # Two timestamps on the same calendar day are less than a day apart, so
    # their whole-day gap is 0: only the first and last purchase of each
    # (customer, day) matter. Rows are combined map-side into one row per
    # (customer, day) -- rows without a timestamp into one row per customer --
    # so the ordered window sees at most one row per calendar day of a
    # customer, whatever the timestamp granularity or the customer's volume.
    per_day = (
        tx.where(F.col(key).isNotNull())
        .groupBy(key, F.to_date(ts).alias("__d"))
        .agg(
            F.min(ts).alias("__first"),
            F.max(ts).alias("__last"),
            F.count("*").alias("__rows"),
            F.sum(amount).alias("__amt"),
            F.count(amount).alias("__n_amt"),
        )
    )
    # One shuffle by customer: the window over days (gaps) and a window by
    # (customer, month) (month counts) both run on that partitioning, and a
    # single per-customer aggregate finishes everything, modal month included.
    w = Window.partitionBy(key).orderBy("__d")
    x = per_day.withColumns(
        {
            "__gap": dates.elapsed_days(F.col("__first"), F.lag("__last").over(w)),
            "__m": F.month("__d").cast("bigint"),
        }
    ).withColumn("__mn", F.sum("__rows").over(Window.partitionBy(key, "__m")))
    month_key = F.when(F.col("__d").isNotNull(), F.struct((-F.col("__mn")).alias("n"), F.col("__m").alias("m")))
    stats = x.groupBy(key).agg(
        (F.sum("__amt") / F.sum("__n_amt")).alias("avg_price_range"),
        F.sum("__rows").alias("purchase_frequency"),
        F.coalesce(F.sum("__gap"), F.lit(0)).alias("__gap_sum"),
        F.sum(F.when(F.col("__d").isNotNull(), F.col("__rows")).otherwise(F.lit(0))).alias("__n_ts"),
        F.min(month_key)["m"].alias("seasonal_preference"),
    )
    feats = stats.select(
        key,
        F.when(F.col("__n_ts") > 1, F.col("__gap_sum") / (F.col("__n_ts") - F.lit(1))).otherwise(F.lit(0.0)).alias(
            "avg_days_between_purchases"
        ),
        F.lit(None).cast("string").alias("preferred_category"),
        "avg_price_range",
        F.col("purchase_frequency").cast("bigint").alias("purchase_frequency"),
        F.coalesce(F.col("seasonal_preference"), F.lit(1).cast("bigint")).alias("seasonal_preference"),
    )
    if category is not None:
        # Counted per (customer, category) first, so a hot customer is one row per category.
        counts = tx.where(F.col(category).isNotNull()).groupBy(key, F.col(category).alias("__c")).agg(F.count("*").alias("__n"))
        modal = counts.groupBy(key).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col("__c").alias("c")))["c"].alias("__modal"))
        order = feats.columns
        feats = feats.join(modal, key, "left").withColumn("preferred_category", F.col("__modal").cast("string")).select(*order)
    return customers.select(key).where(F.col(key).isNotNull()).join(feats, key, "inner")


# --------------------------------------------------------------------------
# Customer cleaning (F16 = A4, P1, P2, P9, P10)
# --------------------------------------------------------------------------

def clean_customers(
    df: DataFrame,
    as_of: Column | str,
    age: str = "age",
    income: str = "income",
    reg: str = "registration_date",
    fill_unknown: Sequence[str] = ("gender", "location"),
) -> DataFrame:
    """Median-impute age and income, parse the registration date, add the
    tenure in whole days up to ``as_of``, fill missing categories with
    ``'Unknown'`` and keep ages inside ``[Q1 - 1.5 IQR, Q3 + 1.5 IQR]``.

    Two small fits: the medians, then the quartiles of the imputed age.
    """
    as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    # One quantile fit gives the medians and, when age has no gaps, also the
    # quartiles of the (then unchanged) imputed age.
    qs = exact_quantiles(df, [age, income], [0.25, 0.5, 0.75])
    med = {c: [qs[c][1]] for c in (age, income)}
    nulls = fit_row(df, [F.count_if(F.col(age).isNull()), F.count_if(F.col(income).isNull())])
    out = df.withColumns(
        {
            age: _fill_numeric(df, age, med[age][0], nulls[0] > 0),
            income: _fill_numeric(df, income, med[income][0], nulls[1] > 0),
            reg: dates.as_ts(reg),
        }
    )
    out = out.withColumn("customer_tenure_days", dates.elapsed_days(as_of_col, F.col(reg)))
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit("Unknown")) for c in fill_unknown if c in df.columns})
    if nulls[0] == 0:
        q1, q3 = qs[age][0], qs[age][2]
    else:
        q1, q3 = exact_quantiles(out, [age], [0.25, 0.75])[age]
    if q1 is None:
        return out.limit(0)
    iqr = q3 - q1
    return out.where(F.col(age).between(q1 - 1.5 * iqr, q3 + 1.5 * iqr))


def _fill_numeric(df: DataFrame, col: str, value: float | None, had_nulls: bool) -> Column:
    """coalesce with the fitted value; a column that had gaps becomes double
    (pandas turns an integer column with gaps into float)."""
    if not had_nulls or value is None:
        return F.col(col)
    return F.coalesce(F.col(col).cast("double"), F.lit(float(value)))


# --------------------------------------------------------------------------
# Product features (F15 = P9, P11, F14, P12, P13, F7)
# --------------------------------------------------------------------------

def product_features(df: DataFrame, tfidf: bool = False, tfidf_terms: int = 100) -> DataFrame:
    """Description length and word count, optional TF-IDF columns
    ``tfidf_0..``, ``price_log``, ``price_category`` bands and the 0-based
    rank of the category among the sorted distinct categories."""
    out, model = df, None
    if "product_description" in df.columns:
        desc = F.coalesce(F.col("product_description"), F.lit(""))
        out = out.withColumns(
            {
                "product_description": desc,
                "description_length": text.length(desc),
                "description_word_count": text.word_count(desc),
            }
        )
        if tfidf:
            from kiln.operators.text_features import TfidfVectorizer

            model = TfidfVectorizer(
                input_col="product_description", id_col="product_id", max_features=tfidf_terms, ngram_max=2
            ).fit(out)
    if "category" in df.columns:
        # before the wide columns: beyond 100 columns Spark compiles no join
        out = LabelEncoder("category", "category_encoded").fit(out).transform(out)
    if model is not None:
        out = model.transform_wide(out, width=tfidf_terms)
    if "price" in df.columns:
        out = out.withColumns(
            {
                "price_log": numeric.log1p(F.col("price")),
                "price_category": numeric.price_band(F.col("price")),
            }
        )
    if "category" in df.columns:
        out = out.select(*[f"`{c}`" for c in out.columns if c != "category_encoded"], "category_encoded")
    return out


# --------------------------------------------------------------------------
# Missing values (A3, A4, A5)
# --------------------------------------------------------------------------

def handle_missing_values(
    df: DataFrame,
    numerical: str = "median",
    categorical: str | None = "mode",
    text_fill: str | None = "empty_string",
) -> DataFrame:
    """Impute every column that has gaps: numeric with the median or mean,
    text with the mode (ties -> smallest) or, when the categorical rule is
    not ``mode``, with ``''``.

    One aggregate finds the null counts and means; medians use the exact
    distributed quantile; all text modes come from one shuffle of
    (column, value) pairs.
    """
    num_cols = numeric_columns(df)
    str_cols = string_columns(df)
    row = fit_row(
        df,
        [F.count_if(F.col(c).isNull()).alias(f"n__{c}") for c in df.columns]
        + [F.avg(c).alias(f"m__{c}") for c in num_cols],
    )
    gappy_num = [c for c in num_cols if row[f"n__{c}"] > 0]
    gappy_str = [c for c in str_cols if row[f"n__{c}"] > 0]
    fills: dict[str, Column] = {}
    if numerical == "median" and gappy_num:
        med = exact_quantiles(df, gappy_num, [0.5])
        for c in gappy_num:
            fills[c] = _fill_numeric(df, c, med[c][0], True)
    elif numerical == "mean":
        for c in gappy_num:
            fills[c] = _fill_numeric(df, c, row[f"m__{c}"], True)
    if categorical == "mode" and gappy_str:
        modes = global_modes(df, gappy_str)
        for c in gappy_str:
            if modes.get(c) is not None:
                fills[c] = F.coalesce(F.col(c), F.lit(modes[c]))
    elif text_fill == "empty_string":
        for c in gappy_str:
            fills[c] = F.coalesce(F.col(c), F.lit(""))
    return df.withColumns(fills) if fills else df


def global_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Mode of each listed column (ties -> smallest) in one shuffle."""
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in cols])
        ).alias("kv")
    ).select("kv.k", "kv.v")
    rows = mode_per_group(pairs, ["k"], "v", "mode").collect()
    return {r["k"]: r["mode"] for r in rows}


# --------------------------------------------------------------------------
# Standard scaling as the pipeline uses it (F1)
# --------------------------------------------------------------------------

def normalize_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<col>_normalized = (x - mean) / population std`` (zero std -> 1,
    so a constant column maps to 0); missing values stay missing."""
    from kiln.operators.scaling import StandardScaler

    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    model = StandardScaler(present, suffix="_normalized").fit(df)
    return model.transform(df)

"""Data-quality operators.

Reports are long-format DataFrames (one row per column and metric), never a
driver-side dictionary. Cost model per table:

* every counter of a table is one ``agg`` (partial + final aggregate);
* equality of rows and values goes by 128-bit digests: shuffles and map-side
  buffers hold digests, never whole texts. Distinct counts of all columns come
  from ONE shuffle of exploded (column, digest) pairs -- instead of one
  ``count(DISTINCT)`` per column, which Spark would plan as an Expand that copies
  every row once per column -- and a most common value is looked up at the end;
* scores and reports write their input once, observe its counts while it is
  written, and aggregate the written columns;
* NaN is missing, as NULL;
* quartiles use the exact distributed selection of ``kiln.functions.stats``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from kiln.functions.numeric import without_nan
from kiln.functions.stats import exact_quantiles, fit_row
from kiln.session import staged, staged_with


def _q(name: str) -> str:
    return f"`{name}`"


def numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def other_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]


def _stack(df: DataFrame, items: Sequence[tuple[str, Sequence[Column]]], names: Sequence[str]) -> DataFrame:
    """Turn one wide row into long rows: one row per (label, values...)."""
    rows = [F.struct(F.lit(lbl).alias(names[0]), *[v.alias(n) for v, n in zip(vals, names[1:])]) for lbl, vals in items]
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# --------------------------------------------------------------------------
# A6 missing values, A17 completeness
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Profile:
    """An input written once: the table without NaN, its rows, and the missing values of each column."""

    table: DataFrame
    rows: int
    missing: dict[str, int]


def profiled(df: DataFrame, written: bool = False) -> Profile:
    """Write ``df`` (NaN as NULL) and count its rows and gaps on the way. A scan of
    written columns (``written``) is not written again, only counted."""
    df = without_nan(df)
    counts = {"n": F.count("*")} | {f"m{i}": F.count_if(F.col(_q(c)).isNull()) for i, c in enumerate(df.columns)}
    if written:
        table, seen = df, fit_row(df, [c.alias(k) for k, c in counts.items()])
    else:
        table, seen = staged_with(df, "profile", counts)
    return Profile(table, int(seen["n"]), {c: int(seen[f"m{i}"]) for i, c in enumerate(df.columns)})


def missing_summary(df: DataFrame) -> DataFrame:
    """Per column: missing count and percentage rounded to 2 places."""
    df = without_nan(df)
    aggs = [F.count("*").alias("__n")] + [
        F.count_if(F.col(_q(c)).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)
    ]
    return _missing_rows(df.agg(*aggs), df.columns)


def _missing_rows(wide: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``__n, m0, m1, ...`` to one row per column."""
    items = [
        (c, [F.col(f"m{i}"), F.round(F.try_divide(F.col(f"m{i}") * 100.0, F.col("__n")), 2)])
        for i, c in enumerate(cols)
    ]
    return _stack(wide, items, ["column", "count", "percentage"])


def _missing_of(p: Profile) -> DataFrame:
    cols = list(p.missing)
    schema = "__n bigint, " + ", ".join(f"m{i} bigint" for i in range(len(cols)))
    return _missing_rows(p.table.sparkSession.createDataFrame([(p.rows, *p.missing.values())], schema), cols)


def completeness(df: DataFrame) -> DataFrame:
    """Per column: ``1 - missing / rows``."""
    df = without_nan(df)
    aggs = [F.count("*").alias("__n")] + [F.count(_q(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    wide = df.agg(*aggs)
    items = [(c, [F.try_divide(F.col(f"c{i}").cast("double"), F.col("__n"))]) for i, c in enumerate(df.columns)]
    return _stack(wide, items, ["column", "completeness"])


# --------------------------------------------------------------------------
# A7 duplicate rows
# --------------------------------------------------------------------------

def digest(*cols: Column) -> list[Column]:
    """128 bits of the values as two columns ``a, b``: equal values (NULL equal to NULL) have equal digests.

    Two chained 64-bit hashes with different beginnings. A hash passes over NULL,
    so the places of the NULLs are hashed as well.
    """
    gaps = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(F.lit(1), gaps, *cols).alias("a"), F.xxhash64(F.lit("2"), gaps, *cols).alias("b")]


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows equal to an earlier row on ``cols`` (all columns by default):
    ``sum(n - 1)`` over groups of equal rows; NULLs compare equal, and NaN to NULL (A7)."""
    df = without_nan(df.select(*[_q(c) for c in cols or df.columns]))
    groups = df.select(*digest(*[F.col(_q(c)) for c in df.columns])).groupBy("a", "b").agg(F.count("*").alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


# --------------------------------------------------------------------------
# A8 IQR outliers
# --------------------------------------------------------------------------

def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> dict[str, tuple[float, float] | None]:
    q = exact_quantiles(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = q[c]
        out[c] = None if q1 is None else (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def outlier_summary(df: DataFrame, cols: Sequence[str] | None = None, bounds: dict | None = None) -> DataFrame:
    """Per numeric column: rows outside ``[Q1 - 1.5 IQR, Q3 + 1.5 IQR]`` and
    their percentage of all rows, rounded to 2 places (A8). ``bounds`` may
    be given when the quartiles are already fitted."""
    cols = list(cols if cols is not None else numeric_cols(df))
    bounds = bounds if bounds is not None else iqr_bounds(df, cols)
    aggs = [F.count("*").alias("__n")]
    for i, c in enumerate(cols):
        b = bounds[c]
        cond = F.lit(False) if b is None else (F.col(_q(c)) < b[0]) | (F.col(_q(c)) > b[1])
        aggs.append(F.count_if(cond).alias(f"o{i}"))
    wide = df.agg(*aggs)
    items = [
        (c, [F.col(f"o{i}"), F.round(F.try_divide(F.col(f"o{i}") * 100.0, F.col("__n")), 2)])
        for i, c in enumerate(cols)
    ]
    return _stack(wide, items, ["column", "count", "percentage"])


# --------------------------------------------------------------------------
# A9 distribution summary
# --------------------------------------------------------------------------

DIST_SCHEMA = StructType(
    [
        StructField("column", StringType()),
        StructField("mean", DoubleType()),
        StructField("median", DoubleType()),
        StructField("std", DoubleType()),
        StructField("min", DoubleType()),
        StructField("max", DoubleType()),
        StructField("unique_values", LongType()),
        StructField("most_common", StringType()),
    ]
)


def value_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(k, v)`` rows: every non-missing value of every listed column, as text."""
    arr = F.array(*[F.struct(F.lit(c).alias("k"), F.col(_q(c)).cast("string").alias("v")) for c in cols])
    return df.select(F.explode(arr).alias("kv")).select("kv.k", "kv.v").where(F.col("v").isNotNull())


def category_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: distinct count and mode (ties -> smallest); columns without values are left out.

    Values are counted by digest; a row per column reaches the driver. A column
    whose values are all single has its smallest value as mode, found by a plain
    aggregate. Elsewhere the mode is looked up among the values whose digest has the
    highest count: those digests are written, so that few of them are broadcast
    by their known size and no value is shuffled.
    """
    at = {c: i for i, c in enumerate(cols)}
    counts = staged(_digested(df, cols, at).groupBy("c", "a", "b").agg(F.count("*").alias("n")), "value-counts")
    seen = {cols[r["c"]]: r for r in counts.groupBy("c").agg(F.count("*").alias("unique_values"), F.max("n").alias("most")).collect()}
    single, many = ([c for c in seen if (seen[c]["most"] == 1) == once] for once in (True, False))
    parts = []
    if single:
        least = df.agg(*[F.min(F.col(_q(c)).cast("string")).alias(f"m{i}") for i, c in enumerate(single)])
        parts.append(_stack(least, [(c, [F.col(f"m{i}")]) for i, c in enumerate(single)], ["k", "most_common"]))
    if many:
        most = F.create_map(*[F.lit(x) for c in many for x in (at[c], seen[c]["most"])])
        ties = staged(counts.where(F.col("n") == most[F.col("c")]).select("c", "a", "b"), "value-ties")
        found = _digested(df, many, at).join(ties, ["c", "a", "b"], "left_semi").groupBy("c").agg(F.min("v").alias("most_common"))
        name = F.create_map(*[F.lit(x) for c in many for x in (at[c], c)])
        parts.append(found.select(name[F.col("c")].alias("k"), "most_common"))
    if not parts:
        return df.sparkSession.createDataFrame([], "k string, unique_values bigint, most_common string")
    unique = F.create_map(*[F.lit(x) for c in seen for x in (c, seen[c]["unique_values"])])
    return reduce(DataFrame.unionByName, parts).select("k", unique[F.col("k")].cast("bigint").alias("unique_values"), "most_common")


def _digested(df: DataFrame, cols: Sequence[str], at: dict[str, int]) -> DataFrame:
    """``value_pairs`` with the column's number ``c`` for its name, and the value's digest ``a, b``."""
    arr = F.array(*[F.struct(F.lit(at[c]).alias("c"), F.col(_q(c)).cast("string").alias("v")) for c in cols])
    pairs = df.select(F.explode(arr).alias("cv")).select("cv.c", "cv.v").where(F.col("v").isNotNull())
    return pairs.select("c", "v", *digest(F.col("v")))


def distribution_summary(df: DataFrame, medians: dict | None = None, moments: dict | None = None) -> DataFrame:
    """mean, median, sample std, min, max of numeric columns; distinct count
    and most common value of the others (A9)."""
    num, oth = numeric_cols(df), other_cols(df)
    parts = []
    if num:
        # mean, std, min and max come from the first pass of the quantile fit.
        if medians is not None and moments is not None:
            med, mom = medians, moments
        else:
            mom = {}
            med = exact_quantiles(df, num, [0.5], moments=mom)
        rows = [(c, mom[c][1], med[c][0], mom[c][2],
                 None if mom[c][3] is None else float(mom[c][3]), None if mom[c][4] is None else float(mom[c][4]),
                 None, None) for c in num]
        parts.append(df.sparkSession.createDataFrame(rows, DIST_SCHEMA))
    if oth:
        cs = category_stats(df, oth)
        # Columns that are entirely missing have no pairs: give them 0 / NULL.
        present = df.sparkSession.createDataFrame([(c,) for c in oth], "k string")
        cs = present.join(cs, "k", "left")
        parts.append(
            cs.select(
                F.col("k").alias("column"),
                *[F.lit(None).cast("double").alias(n) for n in ("mean", "median", "std", "min", "max")],
                F.coalesce("unique_values", F.lit(0)).cast("bigint").alias("unique_values"),
                "most_common",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------
# A10 / A11 quality score and full report
# --------------------------------------------------------------------------

def quality_score(df: DataFrame) -> DataFrame:
    """0-100 score (A10): 100 - min(0.5 x mean missing %, 30)
    - min(0.3 x duplicate %, 20) - min(0.2 x mean outlier %, 15), floor 0;
    the percentages are the rounded ones of the report. The input is evaluated once."""
    p = profiled(df)
    return _score(p, _missing_of(p).collect(), outlier_summary(p.table).collect())


def _score(p: Profile, miss: list, outl: list) -> DataFrame:
    """The score from the rows of the reports (one per column) and the duplicates."""
    def mean(rows: list) -> Column:
        known = [r.percentage for r in rows if r.percentage is not None]
        return F.lit(sum(known) / len(known) if known else None).cast("double")

    dups, n = duplicate_rows(p.table), F.lit(p.rows).cast("bigint")
    mean_missing, mean_outlier = mean(miss), F.coalesce(mean(outl), F.lit(0.0))
    dup_pct = F.when(n > 0, F.try_divide(F.col("duplicate_rows") * 100.0, n)).otherwise(F.lit(0.0))
    score = (
        F.lit(100.0)
        - F.least(mean_missing * 0.5, F.lit(30.0))
        - F.least(dup_pct * 0.3, F.lit(20.0))
        - F.least(mean_outlier * 0.2, F.lit(15.0))
    )
    return dups.select(
        n.alias("total_rows"),
        F.lit(len(p.missing)).cast("bigint").alias("total_columns"),
        "duplicate_rows",
        F.greatest(score, F.lit(0.0)).alias("quality_score"),
    )


def quality_report(df: DataFrame, written: bool = False) -> DataFrame:
    """Full report (A11) in long form: ``section, column, metric, value, text``.

    The input is evaluated once: it is written, its counts are observed meanwhile,
    and each further aggregate reads the written columns once. ``written`` says that
    it is a scan of written columns already.
    """
    def long(frame: DataFrame, section: str, metrics: Sequence[str]) -> DataFrame:
        return frame.select(
            F.lit(section).alias("section"),
            F.col("column"),
            F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("m"),
        ).select("section", "column", "m.metric", "m.value", F.lit(None).cast("string").alias("text"))

    # One quantile fit (quartiles and median of every numeric column) feeds
    # the outlier bounds, the medians and the score.
    p = profiled(df, written)
    df, num = p.table, numeric_cols(p.table)
    mom: dict = {}
    q = exact_quantiles(df, num, [0.25, 0.5, 0.75], moments=mom) if num else {}
    bounds = {c: None if q[c][0] is None else (q[c][0] - 1.5 * (q[c][2] - q[c][0]), q[c][2] + 1.5 * (q[c][2] - q[c][0]))
              for c in num}
    miss_df = _missing_of(p)
    outl_rows = outlier_summary(df, num, bounds).collect()  # a row per column
    outl_df = df.sparkSession.createDataFrame(outl_rows, "column string, count bigint, percentage double")
    miss = long(miss_df, "missing", ["count", "percentage"])
    outl = long(outl_df, "outliers", ["count", "percentage"])
    dist = distribution_summary(df, {c: [q[c][1]] for c in num}, mom)
    dnum = long(dist.where(F.col("unique_values").isNull()), "distribution", ["mean", "median", "std", "min", "max"])
    dcat = dist.where(F.col("unique_values").isNotNull()).select(
        F.lit("distribution").alias("section"), "column", F.lit("unique_values").alias("metric"),
        F.col("unique_values").cast("double").alias("value"), F.col("most_common").alias("text"),
    )
    score = _score(p, miss_df.collect(), outl_rows)
    tbl = score.select(
        F.lit("table").alias("section"), F.lit(None).cast("string").alias("column"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                            for m in ("total_rows", "total_columns", "duplicate_rows", "quality_score")])).alias("m"),
    ).select("section", "column", "m.metric", "m.value", F.lit(None).cast("string").alias("text"))
    return miss.unionByName(outl).unionByName(dnum).unionByName(dcat).unionByName(tbl)


# --------------------------------------------------------------------------
# A12 business rules
# --------------------------------------------------------------------------

def business_rules(
    df: DataFrame,
    as_of: Column | str,
    amount: str = "transaction_amount",
    age: str = "age",
    date_cols: Sequence[str] = ("transaction_timestamp", "registration_date"),
) -> DataFrame:
    """Violated rules with their counts (A12): non-positive amounts, ages
    outside 18..120, dates after ``as_of``. Rules whose column is absent are
    skipped; an empty result means the table is valid."""
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    rules: list[tuple[str, Column, str]] = []
    if amount in df.columns:
        rules.append(("positive_transaction_amounts", F.col(amount) <= 0, "Transaction amounts must be positive"))
    if age in df.columns:
        rules.append(("reasonable_customer_age", (F.col(age) < 18) | (F.col(age) > 120),
                      "Customer age should be between 18 and 120"))
    for c in date_cols:
        if c in df.columns:
            rules.append((f"no_future_dates_{c}", F.col(c).cast("timestamp") > now, f"{c} should not be in the future"))
    if not rules:
        schema = "rule string, violation_count bigint, description string"
        return df.sparkSession.createDataFrame([], schema)
    wide = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, (_, cond, _) in enumerate(rules)])
    items = [(name, [F.col(f"r{i}"), F.lit(desc)]) for i, (name, _, desc) in enumerate(rules)]
    return _stack(wide, items, ["rule", "violation_count", "description"]).where(F.col("violation_count") > 0)


# --------------------------------------------------------------------------
# A13 / A14 schema reports (metadata only)
# --------------------------------------------------------------------------

# Accepted declared type names per Spark type family.
TYPE_FAMILIES = {
    "int64": ["int", "integer", "numeric"],
    "float64": ["float", "numeric", "decimal"],
    "object": ["string", "text", "categorical"],
    "datetime64[ns]": ["datetime", "timestamp"],
    "bool": ["boolean", "bool"],
}


def spark_family(dtype) -> str:
    """The family name of a Spark type, in the pandas dtype vocabulary."""
    name = dtype.typeName()
    if name in ("long", "integer", "short", "byte"):
        return "int64"
    if name in ("double", "float", "decimal"):
        return "float64"
    if name in ("string", "varchar", "char"):
        return "object"
    if name in ("timestamp", "timestamp_ntz", "date"):
        return "datetime64[ns]"
    if isinstance(dtype, BooleanType):
        return "bool"
    return name


def schema_report(df: DataFrame, expected: dict[str, str], lenient_numeric: bool = False) -> dict:
    """Strict schema check (A13): missing, unexpected, type mismatches;
    unexpected columns also invalidate. ``lenient_numeric`` lets an integer
    column satisfy a declared ``float``."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in expected if c not in actual]
    unexpected = [c for c in actual if c not in expected]
    mismatches = {}
    for c, want in expected.items():
        if c not in actual:
            continue
        fam = spark_family(actual[c])
        ok = want.lower() in TYPE_FAMILIES.get(fam, [])
        if not ok and lenient_numeric and fam == "int64" and want.lower() in TYPE_FAMILIES["float64"]:
            ok = True
        if not ok:
            mismatches[c] = {"expected": want, "actual": fam}
    return {
        "schema_valid": not (missing or unexpected or mismatches),
        "missing_columns": missing,
        "unexpected_columns": unexpected,
        "type_mismatches": mismatches,
    }


def schema_report_lenient(df: DataFrame, expected: dict[str, str]) -> dict:
    """Lenient schema check (A14): extra columns allowed; the declared type
    must be a substring of the actual family name."""
    actual = {f.name: spark_family(f.dataType) for f in df.schema.fields}
    mism = [
        {"column": c, "expected": t, "actual": actual[c]}
        for c, t in expected.items()
        if c in actual and t not in actual[c]
    ]
    missing = [c for c in expected if c not in actual]
    return {
        "expected_columns": list(expected),
        "actual_columns": list(actual),
        "missing_columns": missing,
        "extra_columns": [c for c in actual if c not in expected],
        "type_mismatches": mism,
        "schema_valid": not missing and not mism,
    }


# --------------------------------------------------------------------------
# A15 drift, J3 distribution comparison
# --------------------------------------------------------------------------

def drift_report(
    ref: DataFrame,
    cur: DataFrame,
    numerical_threshold: float = 0.1,
    categorical_threshold: float = 0.1,
) -> DataFrame:
    """Per common column (A15): numeric -> ``|mean_cur - mean_ref| / std_ref``
    (sample std; columns with zero std are skipped); other -> L1 distance of
    the value frequencies (missing side = 0). Columns: column, kind,
    drift_score, drift_detected, reference_mean, current_mean.

    The categorical part puts both tables' (column, value) pairs through one
    ``groupBy`` (a full outer comparison without a join).
    """
    common = [c for c in ref.columns if c in cur.columns]
    ref_types = {f.name: f.dataType for f in ref.schema.fields}
    num = [c for c in common if isinstance(ref_types[c], NumericType)]
    cat = [c for c in common if c not in num]
    parts = []
    if num:
        r = fit_row(ref, [F.avg(c) for c in num] + [F.stddev_samp(c) for c in num])
        k = len(num)
        cur_means = cur.agg(*[F.avg(c).alias(f"c{i}") for i, c in enumerate(num)])
        items = []
        for i, c in enumerate(num):
            mean_r, std_r = r[i], r[k + i]
            if std_r is None or std_r == 0:
                continue
            score = F.abs(F.col(f"c{i}") - F.lit(mean_r)) / F.lit(std_r)
            items.append((c, [F.lit("numerical"), score, score > numerical_threshold, F.lit(mean_r).cast("double"), F.col(f"c{i}")]))
        if items:
            parts.append(_stack(cur_means, items, ["column", "kind", "drift_score", "drift_detected", "reference_mean", "current_mean"]))
    if cat:
        both = value_pairs(ref, cat).withColumn("side", F.lit(0)).unionByName(
            value_pairs(cur, cat).withColumn("side", F.lit(1))
        )
        counts = both.groupBy("k", "v").agg(
            F.count_if(F.col("side") == 0).alias("nr"), F.count_if(F.col("side") == 1).alias("nc")
        )
        # totals are one number per column and side: literals, no join on the column name
        tr, tc = (
            F.create_map(*[x for c, n in zip(cat, fit_row(df, [F.count(_q(c)) for c in cat])) for x in (F.lit(c), F.lit(n))])[F.col("k")]
            for df in (ref, cur)
        )
        scored = (
            counts
            .withColumn(
                "d",
                F.abs(
                    F.coalesce(F.try_divide(F.col("nr").cast("double"), tr), F.lit(0.0))
                    - F.coalesce(F.try_divide(F.col("nc").cast("double"), tc), F.lit(0.0))
                ),
            )
            .groupBy("k")
            .agg(F.sum("d").alias("drift_score"))
        )
        parts.append(
            scored.select(
                F.col("k").alias("column"),
                F.lit("categorical").alias("kind"),
                "drift_score",
                (F.col("drift_score") > categorical_threshold).alias("drift_detected"),
                F.lit(None).cast("double").alias("reference_mean"),
                F.lit(None).cast("double").alias("current_mean"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_overall(report: DataFrame) -> DataFrame:
    """Overall drift: any column flagged, mean of all scores."""
    return report.agg(
        F.coalesce(F.max(F.col("drift_detected").cast("int")) == 1, F.lit(False)).alias("drift_detected"),
        F.coalesce(F.avg("drift_score"), F.lit(0.0)).alias("overall_drift_score"),
    )


def distribution_diff(ref: DataFrame, cur: DataFrame, col: str) -> DataFrame:
    """Full outer join of two normalised value distributions, missing side
    = 0 (J3): value, reference share, current share, absolute difference."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        nn = df.where(F.col(col).isNotNull())
        total = nn.select(F.count("*")).scalar()
        return nn.groupBy(F.col(col).alias("value")).agg((F.count("*") / total).alias(name))

    j = shares(ref, "reference_share").join(shares(cur, "current_share"), "value", "full")
    j = j.fillna(0.0, ["reference_share", "current_share"])
    return j.withColumn("abs_diff", F.abs(F.col("reference_share") - F.col("current_share")))


# --------------------------------------------------------------------------
# A16-A19 integrity and 0-1 quality scores
# --------------------------------------------------------------------------

def consistency(customers: DataFrame, tx: DataFrame, id_col: str = "customer_id", amount: str = "transaction_amount") -> DataFrame:
    """Duplicated customer ids, missing values per transaction column and
    negative amounts (A16), long form ``check, column, value``."""
    dup = customers.groupBy(id_col).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("v")
    ).select(F.lit("customers_duplicates").alias("check"), F.lit(id_col).alias("column"), F.col("v").alias("value"))
    tx = without_nan(tx)
    wide = tx.agg(*[F.count_if(F.col(_q(c)).isNull()).alias(f"m{i}") for i, c in enumerate(tx.columns)], F.count_if(F.col(amount) < 0).alias("neg"))
    items = [("transactions_nulls", [F.lit(c), F.col(f"m{i}")]) for i, c in enumerate(tx.columns)]
    counted = _stack(wide, [*items, ("negative_amounts", [F.lit(amount), F.col("neg")])], ["check", "column", "value"])
    return dup.unionByName(counted)


def customer_quality(df: DataFrame, id_col: str = "customer_id", age: str = "age") -> DataFrame:
    """0-1 customer score (A18): 1 - 5 min(dup rate, .1) - 3 min(null rate, .1)
    - 10 min(age outside 18..100 share, .05), floor 0."""
    df = without_nan(df)
    ncols = len(df.columns)
    stats = df.agg(
        F.count("*").alias("n"),
        sum((F.count_if(F.col(_q(c)).isNull()) for c in df.columns), F.lit(0)).alias("nulls"),
        F.count_if((F.col(age) < 18) | (F.col(age) > 100)).alias("age_outliers"),
    )
    # duplicated() counts repeats of the id, NULL included as a value.
    dups = df.groupBy(id_col).agg(F.count("*").alias("k")).agg(F.sum(F.col("k") - 1).alias("d")).select("d").scalar()
    dr = F.col("duplicate_rate")
    nr = F.col("null_rate")
    out = stats.select(
        F.col("n").alias("total_records"),
        F.try_divide(dups.cast("double"), F.col("n")).alias("duplicate_rate"),
        F.try_divide(F.col("nulls").cast("double"), F.col("n") * ncols).alias("null_rate"),
        F.col("age_outliers"),
    )
    score = (
        F.lit(1.0)
        - F.least(dr, F.lit(0.1)) * 5
        - F.least(nr, F.lit(0.1)) * 3
        - F.least(F.try_divide(F.col("age_outliers").cast("double"), F.col("total_records")), F.lit(0.05)) * 10
    )
    return out.withColumn("data_quality_score", F.greatest(score, F.lit(0.0)))


def transaction_quality(
    df: DataFrame,
    as_of: Column | str,
    amount: str = "transaction_amount",
    quantity: str = "quantity",
    date_col: str = "transaction_timestamp",
) -> DataFrame:
    """0-1 transaction score (A19): 1 - 10 min(negative share, .05)
    - 10 min(non-positive quantity share, .05) - 3 min(null rate, .1),
    floor 0; plus the count of dates after ``as_of``."""
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    df = without_nan(df)
    ncols = len(df.columns)
    s = df.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col(amount) < 0).alias("negative_amounts"),
        F.count_if(F.col(quantity) <= 0).alias("zero_quantities"),
        F.count_if(F.col(date_col).cast("timestamp") > now).alias("future_dates"),
        sum((F.count_if(F.col(_q(c)).isNull()) for c in df.columns), F.lit(0)).alias("__nulls"),
    )
    n = F.col("total_records")
    s = s.withColumn("null_rate", F.try_divide(F.col("__nulls").cast("double"), n * ncols)).drop("__nulls")
    score = (
        F.lit(1.0)
        - F.least(F.try_divide(F.col("negative_amounts").cast("double"), n), F.lit(0.05)) * 10
        - F.least(F.try_divide(F.col("zero_quantities").cast("double"), n), F.lit(0.05)) * 10
        - F.least(F.col("null_rate"), F.lit(0.1)) * 3
    )
    return s.withColumn("data_quality_score", F.greatest(score, F.lit(0.0)))


# --------------------------------------------------------------------------
# A23 roll-up of checks
# --------------------------------------------------------------------------

def rollup_checks(checks: DataFrame, passed_col: str = "passed") -> DataFrame:
    """Total, passed and failed checks and the overall status."""
    return checks.agg(
        F.count("*").alias("total_checks"),
        F.count_if(F.col(passed_col)).alias("passed_checks"),
        F.count_if(~F.col(passed_col)).alias("failed_checks"),
    ).withColumn(
        "overall_status", F.when(F.col("failed_checks") == 0, F.lit("PASSED")).otherwise(F.lit("FAILED"))
    )

"""Distributed statistics used to *fit* operators.

Fitted state is always a handful of scalars (a mean, a few quantiles, a
dictionary of categories); it is computed by Spark aggregates and only the
final scalars reach the driver.

Exact quantiles
---------------
pandas / DuckDB ``quantile_cont`` interpolate linearly between the order
statistics at ``floor(q*(n-1))`` and ``ceil(q*(n-1))``. Spark's exact
``percentile`` gives the same numbers but keeps a map of *every distinct
value* in one aggregation buffer, which a global aggregate merges in a
single task -- unusable on a high-cardinality column at 100 TB.

``exact_quantiles`` instead finds the needed order statistics by selection:

1. one pass counts the rows; a second aggregates a sample of bounded size
   (``accuracy``), whose order brackets every needed rank between two values. (The sketches of ``percentile_approx`` grow with every merge, so
   the one task that merges them grows faster than the number of partitions.)
2. one pass: ``count_if(x < lo)`` / ``count_if(x <= hi)`` *verify* each
   bracket exactly (a failed side is widened to the column's min / max), so the
   sample decides how much is ranked, never the result;
3. one pass: the values inside all brackets are grouped to (bracket, value,
   count) rows, range-partitioned and checkpointed; partition offsets and a
   running count inside each partition give every row its rank range, and only
   the rows that cover a needed rank -- two per bracket -- reach the driver.

The number of jobs is fixed: it depends neither on the table nor on the
number of columns, ranks or values in a bracket.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from kiln.session import cut_lineage

APPROX_ACCURACY = 10_000
SAMPLED = 40  # sampled rows per unit of accuracy
SPREAD = 5.0  # half width of a bracket, in standard deviations of a sampled rank


def fit_row(df: DataFrame, exprs: Sequence[Column]) -> Row:
    """Evaluate global aggregates and return the single result row."""
    return df.agg(*exprs).collect()[0]


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    pos = q * (n - 1)
    lo = math.floor(pos)
    hi = math.ceil(pos)
    return lo, hi, pos - lo


def _bracket_ends(sample: Column, probs: Sequence[float]) -> Column:
    """The sampled values that bracket each of ``probs``: all low ends, then all high ends (NULL without a sample)."""
    values, size = F.sort_array(sample), F.size(sample)

    def at(p: float, side: int) -> Column:
        rank = F.round(p * size + side * (SPREAD * math.sqrt(p * (1.0 - p)) * F.sqrt(size) + 2)).cast("int")
        return F.element_at(values, F.least(F.greatest(rank, F.lit(1)), size))

    return F.when(size > 0, F.array(*[at(p, -1) for p in probs], *[at(p, 1) for p in probs]))


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    accuracy: int = APPROX_ACCURACY,
    moments: dict | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each column (NULL / NaN ignored).

    Returns ``{col: [value per prob]}``; a column without values gives None.
    ``accuracy`` sets how narrow the brackets are, not the result.
    When a dict is passed as ``moments`` it is filled with ``{col: (n, mean,
    sample std, min, max)}`` from the same first pass.
    """
    cols = list(cols)
    if not cols:
        return {}
    num = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    # The passes below read only these columns: keep them for the duration of
    # the fit (memory, spilling to disk; lost blocks are recomputed from
    # lineage) instead of re-reading and re-deriving the input each pass.
    base = df.select(*[num[c].alias(c) for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _exact_quantiles(base, cols, probs, accuracy, moments)
    finally:
        base.unpersist()


def _exact_quantiles(base, cols, probs, accuracy, moments):
    drawn = min(1.0, SAMPLED * accuracy / max(base.count(), 1))
    aggs: list[Column] = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"n__{c}"),
            F.min(c).alias(f"mn__{c}"),
            F.max(c).alias(f"mx__{c}"),
            # one sample per column serves both ends of every bracket
            _bracket_ends(F.collect_list(F.when(F.col("__drawn"), F.col(c))), probs).alias(f"pa__{c}"),
        ]
        if moments is not None:
            aggs += [F.avg(c).alias(f"av__{c}"), F.stddev_samp(c).alias(f"sd__{c}")]
    r1 = fit_row(base.withColumn("__drawn", F.rand(seed=42) < drawn), aggs)
    if moments is not None:
        for c in cols:
            moments[c] = (r1[f"n__{c}"], r1[f"av__{c}"], r1[f"sd__{c}"], r1[f"mn__{c}"], r1[f"mx__{c}"])

    # One bracket per (column, probability): it must cover both order statistics.
    k = len(probs)
    spans = []
    for c in cols:
        if r1[f"n__{c}"]:
            # a column without a sampled value is bracketed by its ends
            pa = r1[f"pa__{c}"] or [r1[f"mn__{c}"]] * k + [r1[f"mx__{c}"]] * k
            spans += [(c, i, *_ranks(r1[f"n__{c}"], p), pa[i], pa[k + i]) for i, p in enumerate(probs)]
    out: dict[str, list[float | None]] = {c: [None] * k for c in cols}
    if not spans:
        return out

    # Verify every bracket with exact counts; widen a failed side.
    checks = [n for c, _, _, _, _, a, b in spans for n in (F.count_if(F.col(c) < a), F.count_if(F.col(c) <= b))]
    r2 = fit_row(base, checks)
    brackets = []
    for j, (c, _, lo, hi, _, a, b) in enumerate(spans):
        below, upto = r2[2 * j], r2[2 * j + 1]
        if below > lo:
            a, below = r1[f"mn__{c}"], 0
        if upto <= hi:
            b = r1[f"mx__{c}"]
        brackets.append((c, a, b, lo - below, hi - below))

    found = _order_stats(base, brackets)
    for j, (c, i, _, _, frac, _, _) in enumerate(spans):
        v_lo, v_hi = found[j]
        out[c][i] = v_lo + (v_hi - v_lo) * frac if frac else v_lo
    return out


def _order_stats(base: DataFrame, brackets) -> dict[int, tuple[float, float]]:
    """The two values at the wanted ranks of each bracket ``(column, low,
    high, rank, rank)``; ranks count from the bracket's first row."""
    inside = [
        F.when(F.col(c).between(a, b), F.struct(F.lit(j).alias("j"), F.col(c).alias("v")))
        for j, (c, a, b, _, _) in enumerate(brackets)
    ]
    counts = (
        base.select(F.explode(F.array(*inside)).alias("kv"))
        .where(F.col("kv").isNotNull())
        .groupBy(F.col("kv.j").alias("j"), F.col("kv.v").alias("v"))
        .agg(F.count("*").alias("n"))
    )
    parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # checkpointed: both branches below must see the same partition ids
    d = cut_lineage(counts.repartitionByRange(parts, "j", "v").withColumn("p", F.spark_partition_id()))
    before = Window.partitionBy("j").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (bracket, partition): at most brackets + partitions rows, whatever the table
    offsets = d.groupBy("j", "p").agg(F.sum("n").alias("size")).select(
        "j", "p", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("off")
    )
    upto = F.sum("n").over(Window.partitionBy("j", "p").orderBy("v"))
    ranked = d.withColumn("upto", upto).join(F.broadcast(offsets), ["j", "p"]).select(
        "j", "v", (F.col("off") + F.col("upto")).alias("end"), (F.col("off") + F.col("upto") - F.col("n")).alias("start")
    )

    def covers(at: int) -> Column:
        rank = F.create_map(*[F.lit(x) for j, b in enumerate(brackets) for x in (j, int(b[at]))])[F.col("j")]
        return (F.col("start") <= rank) & (rank < F.col("end"))

    rows = ranked.select("j", "v", covers(3).alias("lo"), covers(4).alias("hi")).where("lo OR hi").collect()
    lows = {r["j"]: r["v"] for r in rows if r["lo"]}
    highs = {r["j"]: r["v"] for r in rows if r["hi"]}
    return {j: (lows[j], highs[j]) for j in range(len(brackets))}


def mode_per_group(df: DataFrame, keys: Iterable[str], col: str, out: str) -> DataFrame:
    """Most frequent non-NULL value of ``col`` per key; ties -> smallest value.

    Two aggregates instead of a per-group value map: (key, value) counts are
    combined map-side, so a hot key only ever ships one row per distinct value.
    """
    keys = list(keys)
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("neg_n"), F.col(col).alias("v")))
    return counts.groupBy(*keys).agg(best["v"].alias(out))


def global_mode(df: DataFrame, col: str) -> object:
    """Mode of one column over the whole table (ties -> smallest)."""
    rows = mode_per_group(df.withColumn("__all", F.lit(0)), ["__all"], col, "m").collect()
    return rows[0]["m"] if rows else None

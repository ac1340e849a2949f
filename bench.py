"""Benchmark of the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_seconds, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver); the time includes its fit passes.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a1_customer_aggregate",
    "a2_interaction_features",
    "f16_clean_customers",
    "f15_product_features",
    "a11_quality_report",
    "a9_distribution_lineitem",
    "a15_drift",
    "f17_advanced_features",
    "f19_binned_ratio_scaled",
    "f14_tfidf_documents",
    "f13_bag_of_words",
    "f20_order_series_features",
    "v4_sql_injection_documents",
    "v6_sanitise_html",
    "v12_lockout",
    "m6_anova_f_scores",
    "m9_mutual_information",
    # the reference's only timed workload: 50 rounds of squared-error boosted trees
    "m11_boosted_trees",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from kiln.plans.registry import load_all
    from kiln.session import get_spark

    spark = get_spark(f"local[{cpus}]", app="kiln-bench", **{"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    reg = load_all()
    names = [n for n in HEADLINE if n in reg]
    # Warm-up: JVM start-up and class loading are not query time.
    reg["a6_missing_summary"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        reg[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()

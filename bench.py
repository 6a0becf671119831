"""Benchmark the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is executed to completion through the no-op sink (full plan, no
driver collection of results).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trolley.session import get_spark  # noqa: E402

HEADLINE = [
    "dim_basket", "fact_sales", "v_kpi_summary", "v_monthly_revenue", "v_category_performance",
    "abc_analysis", "daily_series", "frequent_itemsets_apriori", "frequent_itemsets_fpgrowth",
    "association_rules", "rule_significance", "cooccurrence", "score_layout", "placement_random",
    "rule_stability", "brand_itemsets", "product_itemsets", "product_itemsets_fpgrowth", "product_rules",
    "recommender_eval", "product_recommender_eval", "dq_gate", "fc_metrics", "optimise_layout",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    from trolley.plans.registry import load_all
    qs, _ = load_all()
    names = [n for n in HEADLINE if n in qs]
    if len(sys.argv) > 1:
        names = [n for n in sys.argv[1:] if n in qs]
    # warm-up: JVM, parquet footers
    qs["v_monthly_revenue"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None}))


if __name__ == "__main__":
    main()

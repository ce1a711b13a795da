"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and fully executed into Spark's ``noop`` sink (no
collect to the driver).  Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from keepwise.plans.catalog import QUERIES, load_all  # noqa: E402
from keepwise.session import local_session  # noqa: E402

HEADLINE = [
    "value_at_risk_top", "value_at_risk_ranked", "top_decile_share", "engineered_features",
    "churn_rate_by_category", "describe_numeric", "chi_square", "welch_t", "correlation_matrix",
    "roc_auc", "average_precision", "calibration_curve", "optimal_threshold",
    "km_by_contract", "median_survival", "uplift_budget", "strategy_matrix",
    "action_assignment", "policy_summary", "executive_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [a for a in sys.argv[1:]] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16)
    load_all()
    spark.range(10).count()   # JVM warm-up outside the timings
    times, failed = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:          # report the failure, keep the line printable
            failed[name] = type(exc).__name__
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": m.group(1) if m else sf_dir}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

Each query runs three times and the median counts, so the first, cold run does not.
Results are consumed in full (noop sink), none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "customer_360", "daily_transaction_summary", "credit_risk_dashboard", "ceo_dashboard", "fraud_txn_risk", "fraud_score", "rfm", "cohort_retention", "sessionization", "product_affinity",
    "obt_flatten", "join_as_of", "join_skew_salt", "win_running_total", "win_moving_avg_7", "scd2", "cdc_apply", "fact_account_balance", "dq_results", "merchant_category_summary",
    "fraud_velocity_detection", "percentile_analysis", "basel_car", "risk_trend", "pivot", "st_tumbling",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from finquarry.plans import QUERIES
    from finquarry.session import build_session

    spark = build_session(f"local[{cpus}]", cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.mode("overwrite").format("noop").save()
        return time.perf_counter() - start

    times = {}
    for name in chosen:
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

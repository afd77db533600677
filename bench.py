"""Wall seconds of the headline queries: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.

Prints one JSON line. Each query is run once to warm up and then ``BENCH_RUNS`` times; the median counts.
Every run computes the whole result: rows go to the no-op sink, so nothing is cut by a limit or a count.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.plans.registry import load
from tidemark.session import local_session

HEADLINE = [
    "d2_order_detail", "d3_order_cancel", "d4_payment_success", "d5_refund", "d6_refund_payment", "d7_order_interval",
    "b5_dim_merge", "f6_province_orders", "g5_retract_versions", "g6_latest_version", "g9_strictly_newer",
    "f9_running_profile", "j1_keyword_explode", "job_dim_sync", "job_dwd_base_log", "job_dws_keyword", "job_dws_traffic",
    "job_dws_home_detail", "job_dws_login", "job_dws_cart_uu", "job_dws_province", "job_dws_sku", "job_tag_log",
    "job_tag_user", "job_tag_order", "h1_device_scores", "h3_pay_time_scores", "h11_user_label",
    "d12_age_level_user_interval",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus, "bench")
    queries, seconds = load(), {}
    for name in names:
        times = []
        for i in range(runs + 1):
            began = time.perf_counter()
            queries[name].run(spark, sf).write.format("noop").mode("overwrite").save()
            if i:
                times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "total wall seconds of headline queries, warm median", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/")), "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()

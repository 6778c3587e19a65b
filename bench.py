"""Headline-query timings.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query once to warm the JVM on the smallest data, then times one
full execution per query at ``$BENCH_SF_DIR`` (results go to Spark's ``noop`` sink, so
the whole plan runs but nothing is collected).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "orders_clean",
    "dq_report",
    "department_loyalty",
    "product_loyalty",
    "order_trends",
    "rfm_segments",
    "segment_summary",
    "reorder_features",
    "stratified_split",
    "roc_auc",
    "pr_curve",
    "campaign_targets",
    "model_comparison",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from basketry.session import get_session
    from basketry.plans.registry import QUERIES

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, int(cpus)))
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        QUERIES["orders_clean"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float | None] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # a failed plan is reported, the others still run
            times[name] = None
            print(f"{name}: FAILED {type(exc).__name__}: {str(exc)[:200]}", file=sys.stderr, flush=True)
            continue
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    done = [v for v in times.values() if v is not None]
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(done), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus),
                      "failed": [k for k, v in times.items() if v is None]}))


if __name__ == "__main__":
    main()

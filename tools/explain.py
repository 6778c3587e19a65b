"""Print the executed physical plan of a registered query and a one-line summary.

    python tools/explain.py orders_clean [/root/testdata/sf0.01]

The plan is taken after execution, so it is AQE's final plan (broadcast conversions,
reused exchanges, coalesced partitions).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    from basketry.plans.registry import QUERIES
    from basketry.session import get_session

    spark = get_session()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(plan)
    final = plan.split("== Initial Plan ==")[0]
    print({
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition", final)),
        "reused_exchanges": final.count("ReusedExchange"),
        "broadcast_joins": final.count("BroadcastHashJoin"),
        "sort_merge_joins": final.count("SortMergeJoin"),
        "read_schemas": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", final))),
    })


if __name__ == "__main__":
    main()

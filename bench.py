"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from listmill import plans
from listmill.session import session

HEADLINE = (
    "exact_duplicate_groups", "shingle_counts", "benchmark_containment", "near_duplicate_components", "membership_first_seen_latest", "wording_transitions", "repeat_lookback", "keyed_upsert_merge",
    "ranked_clustered_queue", "facet_counts", "distinct_on_representative", "lateral_top1", "validation_pivot", "cost_union_totals", "route_union_provenance", "html_to_text",
)


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = session(f"local[{cpus}]", 8, spark__driver__memory="8g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        plans.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": folder}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

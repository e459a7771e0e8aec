"""Time the headline queries and print one JSON line.

Each query runs to completion (all rows produced, none kept) on ``$BENCH_SF_DIR`` with
``local[$BENCH_CPUS]``; the value is the total in seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tastemill.plans import catalog
from tastemill.session import build_session

HEADLINE = (
    "validate_interactions",
    "popularity",
    "popular_items",
    "implicit_matrix",
    "split_time_global",
    "split_per_user",
    "filter_low_activity_users",
    "ground_truth_purchases",
    "evaluate_ranking",
    "popularity_evaluation",
    "user_embedding",
    "retrieve_top_k",
    "vector_search",
    "rerank",
    "keyword_search",
    "semantic_search",
    "fuse_rankings",
    "assign_variant",
    "offline_ab",
    "psi",
    "detect_drift",
    "intra_list_diversity",
    "personalization",
    "latency_percentiles",
    "request_rollup",
    "load_summary",
    "user_state",
    "latest_event_per_user",
    "sanitize_messages",
    "check_embeddings",
)


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # Start the JVM, the file readers and the Python workers before the clock.
    catalog.QUERIES["popular_items"](spark, sf_dir).collect()
    spark.range(8).repartition(8).mapInArrow(lambda it: it, "id long").count()
    took = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    return 0


if __name__ == "__main__":
    sys.exit(main())

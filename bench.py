"""Times headline queries and prints one JSON line.

Each query runs to the end (all result rows are produced) on
``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans import catalog
from tidemark.session import build_session

HEADLINE = (
    "user_features", "item_features", "pair_features", "popularity_percentile", "incremental_user_counts",
    "pit_lookup", "asof_training_set", "store_upsert", "validate_view", "quarantine", "events_roundtrip", "dedup_events",
    "train_val_split", "negative_samples", "id_index", "factor_score", "ncf_score", "auc", "ndcg_at_k",
    "knn_l2", "knn_ivf", "knn_lsh", "two_stage_recs", "popular_by_region", "batch_recs",
    "request_rate", "histogram_quantile", "latency_percentiles", "active_requests", "alert_breaches", "alerts_firing",
    "keyword_search", "search_snippets", "stream_request_windows", "stream_daily_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "tidemark-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("request_counts", "item_completion", "id_index"):  # start-up of the JVM is not timed
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline query time", "value": total, "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()

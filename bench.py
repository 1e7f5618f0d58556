"""Headline timings, best of ``BENCH_RUNS`` runs each. Prints one JSON line.

Variables: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS (default 2), BENCH_QUERIES (comma-separated).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regiocast.catalog import load_all
from regiocast.session import build_session

HEADLINE = [
    "stage_card_sales", "stage_commercial", "base_mart", "extended_mart", "signal_mart",
    "forecast_results", "evaluation_metrics", "feature_importance", "ablation_results",
    "next_month_share", "budget_split", "metric_query", "question_routing", "document_search",
    "vector_search", "broken_links", "feature_coverage", "stream_month_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    catalog = load_all()
    catalog["table_scan"](spark, sf_dir).collect()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times = {}
    for name in names:
        tries = []
        for _ in range(runs):
            start = time.perf_counter()
            catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            tries.append(time.perf_counter() - start)
        times[name] = round(min(tries), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()

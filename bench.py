"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs $BENCH_WARM times to warm up (default 2) and then $BENCH_RUNS times (default 1); the median wall time counts, from building
the frame to the last row, which goes to Spark's no-op sink.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cotejo import build_session
from queryset import all_queries

HEADLINE = (
    "reconcile_actions", "upserted_attributes", "synced_polygons", "deleted_duplicates", "duplicate_keys",
    "newly_archived", "problem_list", "run_metrics", "classified_by_clean_text", "group_counts_by_age",
    "segmented_export_manifest", "merged_sheet", "cell_changes", "parcel_overlaps", "polygon_overlaps",
    "task_mail_report", "month_documents", "held_meetings", "first_events_per_calendar", "documents_as_keys",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs, warm = int(os.environ.get("BENCH_RUNS", "1")), int(os.environ.get("BENCH_WARM", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]", cpus, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}
    for name in HEADLINE:
        taken = []
        for _ in range(warm + runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[warm:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline queries at one scale; prints one JSON line.

Each query is built and fully computed; its result is written to the no-op sink so that nothing is
collected. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "knn_ip",
    "knn_l2",
    "knn_ivf",
    "knn_lsh",
    "search_batch",
    "match_gallery",
    "embed_documents",
    "chunk_windows",
    "clean_html",
    "clean_html_native",
    "profile_text_columns",
    "flatten_wide",
    "sql_text_records",
    "row_text_cells",
    "upsert_last_wins",
    "sync_report",
    "job_csv_sync",
    "daily_mark",
    "low_run_events",
    "debounce_sessions",
    "gated_marks",
    "aspect_ratio",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from vecloom.plans.queries import QUERIES
    from vecloom.session import local_session

    spark = local_session("vecloom-bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # start the JVM's and the Python workers' engines on one cheap query of each kind
    for warm in ("min_len_filter", "clean_html", "embed_documents", "match_gallery"):
        timed(warm)
    seconds = {name: round(timed(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

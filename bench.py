"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. Every
query is run once to warm up and then timed as the best of BENCH_RUNS (default 1) full runs into
a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "merge_new_users", "merge_clients", "merge_devices", "merge_devices_rich", "merge_app_versions",
    "daily_active", "daily_active_by_log_type", "daily_active_rich", "sessions", "hourly_active",
    "user_totals", "retention_by_day", "retention_windows", "channel_retention_next_day", "ad_lifecycle",
    "ad_events_show", "api_ad_status", "upgrade_success", "flag_duplicate_ids", "device_signals",
    "score_devices", "rollup_new", "rollup_active", "client_rollups", "event_counts", "engagement",
    "star_daily", "top_per_group_month", "times_in_top", "user_item_score", "user_profile",
    "recommend_similar", "recommend_by_category", "diff_tables", "upsert",
    "sessions_incremental", "replace_range", "stream_new_users",
    "similar_pairs", "merge_new_users_bucketed", "rollup_new_refreshed", "active_windows_bitmap",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    from tallyline import catalog
    from tallyline.session import local_session

    spark = local_session("bench", cores, partitions=int(cores) if cores.isdigit() else 8, memory="16g")
    queries = catalog.queries()
    wanted = sys.argv[1:] or HEADLINE
    times = {}
    for name in wanted:
        best = None
        for i in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if i:  # the first run warms up code generation and file caches
                best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name:32s} {best:.3f}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cores}))


if __name__ == "__main__":
    main()

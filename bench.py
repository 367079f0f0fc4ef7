"""Benchmark: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Each query runs to completion through a no-op sink (every row is computed, nothing is collected), cold:
with its own ``Network``, so its time holds every stage it needs, written tables included. ``warm_total``
runs them all once more over one shared network. The session starts before the first time is taken.
Prints ONE JSON line. ``$BENCH_QUERIES`` (comma-separated) picks some.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bluelines.plans import catalogue  # noqa: E402
from bluelines.session import build_session  # noqa: E402

HEADLINE = [
    "stream_list_all", "upstream_pairs", "downstream_points", "work_segments", "break_segments",
    "side_channels", "start_of_route", "nearest_segment", "snap_measure", "snapped_table", "locate_along", "clip_lines",
    "stream_export", "full_run", "attr_link", "code_descendant", "run_collapse", "insert_ignore", "first_per_key",
    "table_fingerprint", "change_status", "snapshot_diff", "ingest_available_now", "url_to_path",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(name: str, spark, sf_dir: str) -> float:
    t = time.time()
    run(catalogue.QUERIES[name](spark, sf_dir))
    return round(time.time() - t, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    t = time.time()
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    spark.range(1000).selectExpr("sum(id)").collect()
    start = round(time.time() - t, 3)
    times = {}
    for name in chosen:
        times[name] = timed(name, spark, sf_dir)
        catalogue.forget()  # the next query starts cold; after timing
    warm = round(sum(timed(name, spark, sf_dir) for name in chosen), 3)
    catalogue.forget()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "warm_total": warm, "session_start": start, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()

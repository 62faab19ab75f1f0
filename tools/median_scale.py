"""Measure the J5 median strategies on a generated hot-group input.

Usage: ``python tools/median_scale.py EVENT_LOG_DIR [rows] [distinct]``

Generates ``rows`` titles (default 30M) where a third belong to one genre.
``distinct=many`` (default) gives that genre one distinct runtime per row;
``distinct=few`` gives every genre runtimes 1..240. Runs the J5 report with
``median="percentile"`` and ``median="bounded"`` twice each (cold, warm),
and prints per strategy the wall times and the longest single task, read
from Spark's event log written to EVENT_LOG_DIR.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marquee.operators import runtime_by_genre  # noqa: E402
from marquee.session import build_session  # noqa: E402

METHODS = ("percentile", "bounded")


def main() -> None:
    log_dir = sys.argv[1]
    rows = int(sys.argv[2]) if len(sys.argv) > 2 else 30_000_000
    distinct = sys.argv[3] if len(sys.argv) > 3 else "many"
    spark = build_session("local[8]", shuffle_partitions=64, extra={
        "spark.driver.memory": "8g", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"})
    runtime = ("CASE WHEN id % 3 = 0 THEN id ELSE id % 240 + 1 END" if distinct == "many"
               else "pmod(xxhash64(id), 240) + 1")
    titles = spark.range(rows).selectExpr(
        "'movie' AS title_type",
        "CASE WHEN id % 3 = 0 THEN 'Drama' ELSE CAST(id % 7 AS STRING) END AS primary_genre",
        f"CAST({runtime} AS INT) AS runtime_minutes")
    walls: dict[str, list[float]] = {}
    medians: dict[str, float] = {}
    for method in METHODS * 2:
        spark.sparkContext.setJobGroup(method, method)
        t0 = time.perf_counter()
        out = runtime_by_genre(titles, min_count=1, median=method).collect()
        walls.setdefault(method, []).append(round(time.perf_counter() - t0, 2))
        medians[method] = {r.primary_genre: r.median_runtime for r in out}["Drama"]
    app_id = spark.sparkContext.applicationId
    spark.stop()

    stage_group: dict[int, str] = {}
    longest = dict.fromkeys(METHODS, 0)
    (log,) = glob.glob(os.path.join(log_dir, f"*{app_id}*"))
    if os.path.isdir(log):
        (log,) = glob.glob(os.path.join(log, "events_*"))
    with open(log) as fh:
        for line in fh:
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = event.get("Properties", {}).get("spark.jobGroup.id")
                for stage in event["Stage IDs"]:
                    stage_group[stage] = group
            elif event["Event"] == "SparkListenerTaskEnd":
                group = stage_group.get(event["Stage ID"])
                info = event["Task Info"]
                if group in longest:
                    longest[group] = max(longest[group], info["Finish Time"] - info["Launch Time"])
    print(json.dumps({"rows": rows, "distinct": distinct, "wall_sec": walls,
                      "longest_task_ms": longest, "drama_median": medians}))


if __name__ == "__main__":
    main()

"""
out, shuffle bytes written.  Metrics come from Spark's event log written to
a fresh scratch folder (the UI stays off).

    python scripts/measure.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.registered import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def _read_log(log_dir: str) -> dict[str, dict[str, int]]:
    job_group, stage_group, out = {}, {}, {}
    for path in glob.glob(f"{log_dir}/**", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:  # one JSON event per line
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                    job_group[ev["Job ID"]] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not group or not m:
                        continue
                    agg = out.setdefault(group, {"rows_read": 0, "shuffle_bytes": 0})
                    agg["rows_read"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    agg["shuffle_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="tidemark-eventlog-")
    spark = build_session("local[8]", app_name="tidemark-measure", shuffle_partitions=8, extra={
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir,
        "spark.eventLog.rolling.enabled": "false",
        "spark.eventLog.compress": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-warehouse-"),
    })
    sc = spark.sparkContext
    for warm in ("tumbling_count", "stream_replay_closed"):  # JVM warm-up, untimed
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()
    walls, rows_out = {}, {}
    for name, fn in QUERIES.items():
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        walls[name] = time.perf_counter() - t0
        sc.setJobGroup(f"{name}#count", "rows out")
        rows_out[name] = df.count()
    spark.stop()
    metrics = _read_log(log_dir)
    print("| query | wall s | rows read | rows out | shuffle bytes |")
    print("| --- | --- | --- | --- | --- |")
    for name in QUERIES:
        m = metrics.get(name, {})
        print(f"| `{name}` | {walls[name]:.2f} | {m.get('rows_read', 0):,} | {rows_out[name]:,} | "
              f"{m.get('shuffle_bytes', 0):,} |")


if __name__ == "__main__":
    main()

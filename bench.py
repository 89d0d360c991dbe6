"""Benchmark: every registered query at ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]``.  Each query is fully executed into the ``noop``
sink (no driver collect).  Prints one JSON line.

Before timing, one batch query and one stream query run untimed, so the
one-time JVM warm-up (class loading, code generation, state store setup) is
not charged to whichever query happens to come first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.registered import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(
        f"local[{cpus}]",
        app_name="tidemark-bench",
        shuffle_partitions=cpus,
        extra={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            # local bench: keep the default database folder out of the cwd
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-bench-warehouse-"),
        },
    )
    # Warm the JVM (class loading, codegen cache) outside the timings.
    for warm in ("tumbling_count", "stream_replay_closed"):
        QUERIES[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name, fn in QUERIES.items():
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

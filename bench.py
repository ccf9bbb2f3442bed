"""Benchmark: run every registered query on the driver tables and time it.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [key ...]

Each query is executed in full into Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver).  Prints one JSON line:
``{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from patchlens.registry import all_queries  # noqa: E402
from patchlens.session import checkpoint_dir, get_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", 2 * cpus, app_name="patchlens-bench",
                        extra={"spark.driver.memory": "16g",
                               "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    if not spark.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(spark, tempfile.mkdtemp(prefix="patchlens-bench-", dir="/tmp"))
    spark.range(1000).selectExpr("sum(id)").collect()  # warm the JVM

    qs = all_queries()
    keys = argv[1:] or list(qs)
    times: dict[str, float] = {}
    for k in keys:
        t0 = time.perf_counter()
        qs[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
        print(f"# {k}: {times[k]:.2f}s", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))

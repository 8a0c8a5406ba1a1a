"""Benchmark: run every registered query on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``
and print ONE JSON line with per-query seconds (median of ``$BENCH_REPS`` warm runs).

Each query is fully executed through the ``noop`` sink (no collect to the driver), so the
time covers the whole plan including the eager jobs some operators run (key assignment
checkpoints, bounded-broadcast row checks).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from martkit.session import local_session
    from martkit.plans.queries import QUERIES

    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = local_session(cpus, shuffle_partitions=parts, app="martkit-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.sql.files.maxPartitionBytes": "64m"})
    names = [n for n in QUERIES if not only or n in only]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    errors = {}
    for n in names:  # warm-up: JIT, file listing caches, Python imports
        try:
            run(n)
        except Exception as exc:  # noqa: BLE001 - one failing query must not lose the whole report
            errors[n] = f"{type(exc).__name__}: {str(exc)[:200]}"
    times = {n: round(statistics.median(run(n) for _ in range(reps)), 3) for n in names if n not in errors}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "reps": reps,
           "shuffle_partitions": parts}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

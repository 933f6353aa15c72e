"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (the whole plan runs,
nothing is collected to the driver). Every query runs $BENCH_WARMUP times
untimed first (default 1: code generation, JIT and class loading are paid
there), then once timed; ``queries`` holds the timed runs and ``cold`` the
first runs. Prints one JSON line on stdout; progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skewkit.plans.registry import all_queries  # noqa: E402
from skewkit.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    # one shuffle partition per core; AQE coalesces batch stages, and stateful
    # streams keep this count for their state stores
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=parts, app_name="skewkit-bench")

    # JVM / file-listing warm-up, not timed
    spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")).write.format("noop").mode("overwrite").save()

    warmup = int(os.environ.get("BENCH_WARMUP", "1"))

    def timed(fn) -> float:
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in all_queries().items():
        if only and name not in only:
            continue
        try:
            for i in range(warmup):
                t = timed(fn)
                if i == 0:
                    cold[name] = t
            times[name] = timed(fn)
        except Exception as exc:  # keep measuring the others; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
            cold.pop(name, None)
            print(f"{name:28s} FAILED {errors[name]}", file=sys.stderr, flush=True)
            continue
        print(f"{name:28s} {times[name]:8.3f}s  (cold {cold.get(name, times[name]):.3f}s)",
              file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

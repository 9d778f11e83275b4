"""Benchmark: star build, then the five timed evaluation queries and the wide
sales mart on the materialized star.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line.  ``value`` is the sum of the median warm times of the
six headline queries; cold times, the best warm run and the star build are
reported separately.
"""

from __future__ import annotations

import json
import os
import re
import sys
import uuid
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from medistar.params import Params  # noqa: E402
from medistar.plans import queries as Q  # noqa: E402
from medistar.plans.star import build_star_to  # noqa: E402
from medistar.sources import adapter  # noqa: E402
from medistar.session import get_spark, shared_path  # noqa: E402

WARM_RUNS = 5


def run(df, sink: str) -> None:
    if sink == "noop":
        df.write.format("noop").mode("overwrite").save()
    else:
        df.collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus), app="medistar-bench")
    # the star is written under the shared checkpoint folder (never a machine-local temp dir)
    wh = shared_path(spark, "bench_star", uuid.uuid4().hex)

    t0 = time.time()
    star = build_star_to(spark, adapter.load_driver_raw(spark, sf_dir), wh, Params())
    build = time.time() - t0

    headline = dict(Q.TIMED)
    headline["sales_mart"] = Q.sales_mart
    cold, warm, best = {}, {}, {}
    for name, fn in headline.items():
        sink = "noop" if name == "sales_mart" else "collect"
        t = time.time()
        run(fn(star), sink)
        cold[name] = round(time.time() - t, 3)
        times = []
        for _ in range(WARM_RUNS):
            t = time.time()
            run(fn(star), sink)
            times.append(time.time() - t)
        warm[name] = round(sorted(times)[len(times) // 2], 3)
        best[name] = round(min(times), 3)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_warm_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "warm_best": best,
        "star_build_sec": round(build, 3),
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

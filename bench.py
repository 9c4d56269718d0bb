"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into Spark's ``noop`` sink (the full plan,
no driver collect). One warm-up pass (JIT, file listing) runs first and is
not counted. Prints one JSON line: ``value`` is the total over the fixed
headline set; ``queries`` also lists the extra ones (``extra_total``).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from airlens.plans import catalog  # noqa: E402
from airlens.session import build_session  # noqa: E402

HEADLINE = [
    "score_readings",
    "score_with_table",
    "hourly_city_aqi",
    "city_summary",
    "overall_aqi_city_day",
    "windowed_aqi",
    "windowed_aqi_bucketed",
    "latest_windows",
    "serving_view",
]
EXTRA = ["latest_windows_direct", "trailing_hour_direct", "windowed_aqi_stream",
         "readings_from_latest", "select_stations"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    names = HEADLINE + [n for n in EXTRA if n in catalog.QUERIES]
    run(catalog.QUERIES["hourly_city_aqi"](spark, sf_dir))          # warm-up
    times = {}
    for name in names:
        t0 = time.perf_counter()
        run(catalog.QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times[n] for n in HEADLINE), 3),
        "unit": "sec",
        "queries": times,
        "extra_total": round(sum(times[n] for n in names if n not in HEADLINE), 3),
        "sf": sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

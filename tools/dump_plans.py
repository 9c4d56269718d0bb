"""Write the physical plans of the headline queries to PLANS.md.

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airlens.plans import catalog  # noqa: E402
from airlens.session import build_session  # noqa: E402

NOTES = {
    "hourly_city_aqi": "Pruned scan (4 of 6 columns), 25-row nation/region dimension broadcast, "
                       "staged scoring projections inside one codegen stage, partial then final "
                       "HashAggregate on (city, country, hour).",
    "city_summary": "Second aggregate over the hourly rows: a SortAggregate because of the "
                    "max(struct) that picks the earliest hour at the maximum; partial before the "
                    "exchange, so a hot city ships one row per map task.",
    "windowed_aqi_bucketed": "5-minute bucket aggregate first (partial/final HashAggregate), then "
                             "Generate x12 over buckets only, then the window aggregate.",
    "latest_windows_direct": "Bucket aggregate, then a partial WindowGroupLimit (top-1 per city) "
                             "before the shuffle; no window expansion at all.",
    "trailing_hour_direct": "Bucket aggregate before the as-of mark (a reused scalar subquery); "
                            "cities active in the last hour are aggregated over it, the others "
                            "take their newest bucket (partial top-1); a union, no join.",
    "serving_view": "History (hourly merged from 5-minute buckets, then the summary) and the "
                    "snapshot (newest bucket per city) from bucket aggregates; left join on "
                    "(city, country), strategy chosen by AQE from runtime sizes.",
    "select_stations": "Partial WindowGroupLimit (largest quota) before the per-country shuffle; "
                       "the quota prefix sums run on the config-sized table.",
    "readings_from_latest": "Entries (big) join exploded sensors (per document, no shuffle) on "
                            "(location_id, sensor_id); no broadcast hint, AQE decides.",
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/dump_plans.py` on `{sf}` after one run (AQE final plans; `*(n)` marks whole-stage codegen).", ""]
    for name, note in NOTES.items():
        df = catalog.QUERIES[name](spark, sf)
        df.collect()                     # runs this plan, so AQE's final plan is shown
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln[:200] + (" …" if len(ln) > 200 else "") for ln in plan.splitlines()]
        out += [f"## {name}", "", note, "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline queries on the bench tables; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose tables and cores. Every query runs once to warm the JVM
and is then timed ``BENCH_RUNS`` times; the best run counts. The result is written to
Spark's no-op sink, so the time is the query's and not the driver's.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "zonal_daily", "zonal_many_lakes", "zonal_polygon", "regional_daily", "regional_monthly", "points_in_polygon",
    "inset_membership", "expected_pixels", "lake_candidates", "regional_quality_daily", "lake_quality",
    "lake_quality_summary", "clip_global", "interp_limit3", "rolling_centre7", "climate_pivot", "lake_pixels_mean",
    "resample_7d", "resample_wmon", "rolling_28d", "resample_month", "features_daily", "features_monthly",
    "chart_lake_daily", "facet_shading", "table_profile", "manifest_audit", "time_labels",
)


def main() -> None:
    from checks.queries import QUERIES
    from limnia.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    times = {}
    for name in HEADLINE:
        once(name)
        times[name] = round(min(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf,
    }))


if __name__ == "__main__":
    main()

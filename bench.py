"""Benchmark: ETL build + headline queries on one scale factor.

``value`` counts the landing and the warehouse build as well as the queries.

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_HEADLINE=1 to time only the headline set instead of every registered query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadflow import registry  # noqa: E402
from roadflow.plans.warehouse import warehouse_for  # noqa: E402
from roadflow.session import local_session  # noqa: E402
from roadflow.sources.landing import landing_for  # noqa: E402

HEADLINE = [
    "etl_clean_summary", "etl_validate_aadf", "etl_fact_load_stats",
    "regional_traffic_summary", "top_busiest_roads", "yoy_growth_trend", "local_authority_growth",
    "road_category_distribution", "geospatial_hotspots", "covid_recovery_by_region", "cycling_growth",
    "directional_flow", "vehicle_km_by_region", "road_category_performance", "top_growing_roads",
    "congestion_proxy", "motorway_vs_aroad", "coverage_by_region_category", "directional_imbalance_sql",
    "yearly_overview", "hotspots", "measure_yoy_calendar",
    "estimation_method_by_year", "road_category_trends", "directional_imbalance_pivot",
    "road_utilization_top100", "peak_hour_pattern", "day_of_week_pattern", "year_hour_heatmap",
    "raw_key_findings", "serve_top_roads_by_year", "serve_geo_hotspots", "cloud_kpis",
    "dq_orphan_facts", "dq_report", "reconcile_direction_sums", "reconcile_subset", "etl_pages_flatten",
]

SKIP_IN_ALL: set[str] = set()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="roadflow-bench",
                          extra={"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    timings: dict[str, float] = {}

    t = time.time()
    land = landing_for(spark, sf_dir)
    land.prepare(["raw_aadf", "count_points", "raw_counts", "road_segments"])
    land.prepare(["raw_aadf_typed", "full_aadf"])
    land.table("subset_aadf")
    land.pages_path()
    land.csv_path("raw_aadf")
    timings["build_landing"] = round(time.time() - t, 3)

    t = time.time()
    warehouse_for(spark, sf_dir)
    timings["build_warehouse"] = round(time.time() - t, 3)

    qs = registry.queries()
    names = HEADLINE if os.environ.get("BENCH_HEADLINE") else [n for n in qs if n not in SKIP_IN_ALL]
    total = sum(timings.values())
    for name in names:
        t = time.time()
        run(qs[name](spark, sf_dir))
        dt = round(time.time() - t, 3)
        timings[name] = dt
        total += dt

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "etl_sec": round(timings["build_landing"] + timings["build_warehouse"], 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

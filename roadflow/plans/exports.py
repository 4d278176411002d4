"""Published exports: which results are written as CSV, under which names and columns.

One list serves the registered query and the batch run.  Results of a bounded
number of rows are one file each, written after the aggregate has run in its
own stages; results that grow with the count points keep one file per task.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import decimals_as_double
from ..sources.sinks import write_csv
from . import analyses, quality, reports, serving
from .snapshots import Snapshots

# Export name -> (report, its columns in order).
REPORTS = {
    "regional_traffic_summary": ("regional_traffic_summary", [
        "RegionName", "TotalMotorVehicles", "TotalHGVs", "TotalAllVehicles"]),
    "top_busiest_roads": ("top_busiest_roads", ["RoadName", "RoadCategory", "TotalTraffic", "AvgDailyFlow"]),
    "yoy_growth_trend": ("yoy_growth_trend", ["Year", "TotalTraffic", "PrevYear", "YoY_GrowthPct"]),
    "hgv_passenger_mix": ("hgv_passenger_mix", ["RegionName", "HGV_Total", "Passenger_Total", "HGV_Pct"]),
    "local_authority_growth": ("local_authority_growth", [
        "LocalAuthorityName", "Traffic2023", "Traffic2018", "GrowthPct"]),
    "road_category_distribution": ("road_category_distribution", [
        "RoadCategory", "NumCountPoints", "TotalTraffic", "AvgFlowPerPoint"]),
    "geospatial_hotspots": ("geospatial_hotspots", [
        "Latitude", "Longitude", "RoadName", "RegionName", "LocalAuthorityName", "TotalTraffic", "AvgDailyFlow"]),
    "covid_impact": ("covid_impact", ["Year", "Cars", "Buses", "LGVs", "HGVs", "Cycles", "AllMotor"]),
    "cycling_trends": ("cycling_share_export", ["Year", "TotalCycles", "TotalMotor", "CycleSharePct"]),
    "lgv_ecommerce_trend": ("lgv_growth_trend", ["Year", "TotalLGVs", "TotalMotor", "LGV_Share_Pct"]),
    "motorway_vs_aroad": ("motorway_vs_aroad", ["Year", "Motorway_Flow", "ARoad_Flow", "Minor_Flow"]),
    "hgv_axle_breakdown": ("hgv_axle_breakdown", [
        "Year", "Rigid2", "Rigid3", "Rigid4Plus", "Artic3_4", "Artic5", "Artic6", "TotalHGV"]),
    "bus_coach_decline": ("bus_coach_decline", ["Year", "TotalBuses", "TotalMotor", "Bus_SharePct"]),
    "motorcycle_trends": ("motorcycle_trends", ["Year", "TotalMotorcycles", "Motorcycle_SharePct"]),
}
# File names of the analyses of the direction extract and of the hourly counts.
DIRECTION_ANALYSES = [
    "estimation_method_by_year", "estimation_method_detailed", "road_category_trends", "hgv_axle_trends",
    "vehicle_mode_trends", "directional_imbalance", "road_utilization_top100",
]
POINT_ANALYSES = ["count_point_coverage", "region_coverage_density"]
COUNT_ANALYSES = [
    "peak_hour_pattern", "day_of_week_pattern", "seasonal_pattern", "year_hour_heatmap", "road_category_hourly",
]
#: Results with a row per count point.
PER_POINT = {"geospatial_hotspots"}

Results = dict[str, Callable[[], DataFrame]]


def report_results(wh) -> Results:
    return {name: lambda report=report, columns=columns: getattr(reports, report)(wh).select(*columns)
            for name, (report, columns) in REPORTS.items()}


def analysis_results(raw: DataFrame, points: DataFrame | None = None, counts: DataFrame | None = None) -> Results:
    """The analyses of the extracts that are there; ``raw`` are the direction rows."""
    def of(names, df):
        return {n: lambda n=n: getattr(analyses, "directional_imbalance_pivot" if n == "directional_imbalance" else n)(df)
                for n in names}

    return (of(DIRECTION_ANALYSES, raw) | (of(POINT_ANALYSES, points) if points is not None else {})
            | (of(COUNT_ANALYSES, counts) if counts is not None else {}))


def serving_results(stored: Snapshots) -> Results:
    return {f"serving/{name}": lambda name=name: serving.served(stored, name) for name in serving.DATASETS}


def quality_results(wh) -> Results:
    return {"data_quality_report": lambda: quality.dq_report(wh)}


def write_results(results: Results, root: str, parallel: int = 4) -> list[tuple[str, str, str]]:
    """Write each result as CSV under ``root``; (name, OK or ERROR, path or the whole error) for each.

    The results are independent jobs and are submitted concurrently; one that
    fails is recorded and the others are still written.  A name's last part
    says whether the result grows with the count points."""
    def one(name: str) -> tuple[str, str, str]:
        path = f"{root}/{name}"
        try:
            write_csv(decimals_as_double(results[name]()), path, single_file=name.rpartition("/")[2] not in PER_POINT)
            return name, "OK", path
        except Exception as e:  # noqa: BLE001
            return name, "ERROR", f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(one, results))


TEXT_COLUMNS = {"RegionName", "RoadName", "RoadCategory", "LocalAuthorityName"}


def written_content(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """What the written files hold: a row per report and column with the rows,
    the filled cells, and their sum (of numbers to four places, of text lengths)."""
    from functools import reduce

    parts = []
    for name in names:
        df = spark.read.option("header", True).csv(f"{root}/{name}")
        cells = []
        for c in REPORTS[name][1]:
            value = F.length(c) if c in TEXT_COLUMNS else F.round(F.col(c).cast("double"), 4)
            cells.append(F.struct(
                F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(c).alias("filled"),
                F.coalesce(F.sum(value.cast("decimal(30,4)")), F.lit(0)).cast("double").alias("total")))
        parts.append(df.agg(F.array(*cells).alias("all")).select(F.lit(name).alias("report"), F.explode("all").alias("x"))
                     .select("report", "x.*"))
    return reduce(DataFrame.unionByName, parts)

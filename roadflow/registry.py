"""Name -> query registry: every registered query is a function of
``(spark, sf_dir)`` returning a DataFrame over data Spark derives from the
tables in ``sf_dir`` (landed raw extracts, or the warehouse built from
them)."""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.exprs import decimals_as_double
from .operators import clean as cleaning
from .plans import analyses as an
from .plans import quality as dq
from .plans import reports
from .plans import serving as sv
from .plans import extracts
from .plans import warehouse as whm
from .plans.snapshots import Snapshots
from .plans.sqltext import Catalogue
from .plans.warehouse import warehouse_for
from .session import materialise, new_output_dir
from .sources import pages as pg
from .sources.landing import landing_for

Query = Callable[[SparkSession, str], DataFrame]

WAREHOUSE_REPORTS = [
    # core business reports
    "regional_traffic_summary", "top_busiest_roads", "yoy_growth_trend", "hgv_passenger_mix",
    "local_authority_growth", "road_category_distribution", "geospatial_hotspots",
    # advanced reports
    "covid_impact", "covid_recovery_by_region", "cycling_growth", "cycling_modal_shift",
    "directional_flow", "vehicle_km_by_region", "road_category_performance", "top_growing_roads",
    "lgv_growth_trend", "congestion_proxy", "motorway_vs_aroad", "hgv_axle_breakdown",
    "bus_coach_decline", "motorcycle_trends", "coverage_by_region_category",
    "directional_imbalance_sql", "cycling_share_export",
    # serving queries
    "table_row_counts", "regions_list", "yearly_totals_api", "traffic_by_region", "top_roads",
    "vehicle_mix_by_region", "hotspots", "available_years", "yearly_overview", "regional_overview",
    "national_vehicle_mix", "vehicle_mix_long", "vehicle_trend_long", "cycling_trend",
    "lgv_share_trend", "bus_share_trend", "measure_total_motor", "measure_hgv_pct",
    "measure_yoy_calendar",
]


def _on_warehouse(name: str) -> Query:
    fn = getattr(reports, name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(warehouse_for(spark, sf_dir))

    run.__name__ = name
    return run


def _raw(spark, sf):
    return landing_for(spark, sf).table("raw_aadf")


def _typed(spark, sf):
    """Raw direction extract with measures already parsed to numbers."""
    return landing_for(spark, sf).table("raw_aadf_typed")


def _points(spark, sf):
    return landing_for(spark, sf).table("count_points")


def _counts(spark, sf):
    return landing_for(spark, sf).table("raw_counts")


# --------------------------------------------------------------------------
# ETL stage queries
# --------------------------------------------------------------------------

def etl_fact_load(spark, sf):
    wh = warehouse_for(spark, sf)
    return decimals_as_double(wh.fact.select(*whm.FACT_COLUMNS))


def etl_dim_date(spark, sf):
    """The calendar, with the rows that the fact holds of each year."""
    wh = warehouse_for(spark, sf)
    rows = wh.fact.groupBy("DateKey").agg(F.count(F.lit(1)).alias("FactRows"))
    return wh.dim("DimDate").join(rows, "DateKey", "left").withColumn("FactRows", F.coalesce("FactRows", F.lit(0)))


def etl_dim_keys_stable(spark, sf):
    """Two refreshes of the dimensions, the first without every third point: points that the first knows keep their keys
    in the second, whatever their ids, and the others get the next ones."""
    points = _points(spark, sf)
    base = new_output_dir(spark, "warehouse-keys")
    whm.build_dimensions(spark, points.where(F.col("count_point_id") % 3 != 0), base)
    return whm.build_dimensions(spark, points, base).table("DimCountPoint").select("CountPointID", "CountPointKey")


def etl_rejected_rows(spark, sf):
    """What the load has set apart: rows by reason, year and direction, and their all-vehicle text as it came."""
    rows = warehouse_for(spark, sf).rejected()
    return rows.groupBy("status", F.col("DateKey").alias("Year"), F.col("direction_of_travel").alias("Direction")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("all_motor_vehicles").alias("largest_text"))


def etl_fact_load_stats(spark, sf):
    return whm.load_stats(warehouse_for(spark, sf))


def etl_incremental_load(spark, sf, first_years=(2017, 2018, 2019)):
    """Load a few years into a fresh warehouse, then every missing year,
    then once more (a no-op); returns the resulting fact."""
    raw = landing_for(spark, sf).table("raw_aadf")
    wh = warehouse_for(spark, sf).with_new_fact(new_output_dir(spark, "warehouse-incr"))
    whm.incremental_load(wh, raw, set(first_years))
    whm.incremental_load(wh, raw)
    whm.incremental_load(wh, raw)
    return decimals_as_double(wh.fact.select(*whm.FACT_COLUMNS))


def etl_pages_flatten(spark, sf):
    return decimals_as_double(pg.flatten_pages(pg.read_pages(spark, landing_for(spark, sf).pages_path())))


def etl_pages_completeness(spark, sf):
    return pg.pages_completeness(pg.read_pages(spark, landing_for(spark, sf).pages_path()))


def stream_pages_ingest(spark, sf):
    from .streaming.page_ingest import ingest_pages

    src = landing_for(spark, sf).pages_path()
    out = new_output_dir(spark, "pages-stream")
    return decimals_as_double(ingest_pages(spark, src, f"{out}/table", f"{out}/_checkpoint").drop("current_page"))


def etl_page_gaps(spark, sf):
    """A delivery that lacks pages 3, 4 and 6 of each ten, and holds every fifth page twice."""
    out = new_output_dir(spark, "pages-gaps")
    pg.write_page_files(landing_for(spark, sf).envelopes(~(F.col("page") % 10).isin(3, 4, 6)), out)
    again = pg.page_lines(spark, out).where(F.col("page") % 5 == 0)
    again.select("value").write.mode("append").option("compression", "gzip").text(out)
    return pg.page_gaps(pg.read_pages(spark, out))


def _streamed(spark, sf):
    """Pages streamed into a warehouse in three runs, the last without new files: odd pages, then even pages with the
    odd thirds again (under other file names) and a cut copy of every fifth page."""
    from .streaming.page_load import load_pages

    key = ("streamed", spark.sparkContext.applicationId, os.path.abspath(sf))
    with _LOCK:
        if key not in _SERVING:
            land, page = landing_for(spark, sf), F.col("page")
            root = new_output_dir(spark, "pages-load")
            base, folder = f"{root}/warehouse", f"{root}/pages"
            whm.build_dimensions(spark, _points(spark, sf), base)
            pg.write_page_files(land.envelopes(page % 2 == 1), folder)
            load_pages(spark, folder, base, f"{root}/checkpoint")
            pg.write_page_files(land.envelopes(page % 2 == 0), folder, mode="append")
            cut = F.expr("substring(value, 1, length(value) div 2)")
            more = F.array_compact(F.array(F.when(page % 6 == 3, F.col("value")), F.when(page % 5 == 0, cut)))
            again = pg.page_lines(spark, folder).select(F.explode(more).alias("value"))
            again.write.mode("append").option("compression", "gzip").text(folder)
            for _ in range(2):
                load_pages(spark, folder, base, f"{root}/checkpoint")
            _SERVING[key] = base
    return whm.open_warehouse(spark, _SERVING[key])


def stream_pages_fact(spark, sf):
    return _streamed(spark, sf).fact.select(*whm.FACT_COLUMNS)


def stream_page_receipts(spark, sf):
    from .streaming.page_load import receipts

    return receipts(_streamed(spark, sf)).groupBy("status").agg(
        F.count(F.lit(1)).alias("n_pages"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.count("text").alias("n_texts"))


def csv_append_once(spark, sf):
    """The hourly counts appended as CSV in a run per half-year, the first run twice; what the folder then holds."""
    from .schemas import RAW_COUNTS_SCHEMA
    from .sources.sinks import append_csv, read_appended

    path = new_output_dir(spark, "csv-append")
    counts = _counts(spark, sf)
    half = F.month("count_date") > 6
    for run, rows in (("first", counts.where(~half)), ("first", counts.where(~half)), ("second", counts.where(half))):
        append_csv(rows, path, run)
    return an.seasonal_pattern(read_appended(spark, path, RAW_COUNTS_SCHEMA))


def csv_pruned_regions(spark, sf):
    """Three columns of the count points' CSV; the others are not parsed."""
    from .sources.readers import read_count_points_csv

    columns = ["region_id", "region_name", "count_point_id"]
    df = read_count_points_csv(spark, landing_for(spark, sf).csv_path("count_points"), columns)
    return df.groupBy("region_id", "region_name").agg(F.count_distinct("count_point_id").alias("points"))


def csv_dates(spark, sf):
    """The hourly counts' CSV with its dates parsed: rows and first and last day of each month."""
    from .sources.readers import read_raw_counts_csv

    df = read_raw_counts_csv(spark, landing_for(spark, sf).csv_path("raw_counts"), ["count_date"])
    return df.groupBy(F.month("count_date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("count_date").alias("first_day"), F.max("count_date").alias("last_day"))


def csv_peek(spark, sf, n=5):
    """The first rows of the direction extract's CSV, as a profile of their columns."""
    from .sources.readers import read_raw_aadf_csv, sample

    head = sample(read_raw_aadf_csv(spark, landing_for(spark, sf).csv_path("raw_aadf")), n)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type")) for c, t in head.dtypes])
    return head.agg(F.count(F.lit(1)).alias("n_rows")).select(F.explode(cells).alias("c"), "n_rows").select("c.*", "n_rows")


def fact_load_dates(spark, sf):
    """Rows of each year, and whether all carry the time of a load that is over."""
    done = F.col("LoadDate").isNotNull() & (F.col("LoadDate") <= F.current_timestamp())
    return warehouse_for(spark, sf).fact.groupBy("DateKey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(done).alias("loaded_before_now"))


def etl_clean_aadf_csv(spark, sf):
    """Clean the extract as delivered: a headed CSV read with an explicit
    schema (measures as text), split across tasks by the reader."""
    from .sources.readers import read_raw_aadf_csv

    raw = read_raw_aadf_csv(spark, landing_for(spark, sf).csv_path("raw_aadf"))
    return decimals_as_double(cleaning.clean_aadf(raw))


def api_regions_records(spark, sf):
    from .sources.sinks import as_json_records

    return as_json_records(reports.regions_list(warehouse_for(spark, sf)))


ETL = {
    "etl_clean_aadf": lambda s, sf: decimals_as_double(cleaning.clean_aadf(_raw(s, sf))),
    "etl_clean_aadf_csv": etl_clean_aadf_csv,
    "api_regions_records": api_regions_records,
    "etl_clean_summary": lambda s, sf: cleaning.clean_summary(_raw(s, sf)),
    "etl_validate_aadf": lambda s, sf: cleaning.validate_aadf(_raw(s, sf)),
    "etl_dim_date": etl_dim_date,
    "etl_dim_region": lambda s, sf: warehouse_for(s, sf).table("DimRegion"),
    "etl_dim_local_authority": lambda s, sf: warehouse_for(s, sf).table("DimLocalAuthority"),
    "etl_dim_count_point": lambda s, sf: decimals_as_double(warehouse_for(s, sf).table("DimCountPoint")),
    "etl_dim_keys_stable": etl_dim_keys_stable,
    "etl_fact_load": etl_fact_load,
    "etl_rejected_rows": etl_rejected_rows,
    "etl_fact_load_stats": etl_fact_load_stats,
    "etl_loaded_years": lambda s, sf: whm.loaded_years(warehouse_for(s, sf)),
    "etl_years_to_load": lambda s, sf: whm.years_to_load(warehouse_for(s, sf), _raw(s, sf)),
    "etl_incremental_load": etl_incremental_load,
    "etl_pages_flatten": etl_pages_flatten,
    "etl_pages_completeness": etl_pages_completeness,
    "etl_page_gaps": etl_page_gaps,
    "stream_pages_ingest": stream_pages_ingest,
    "stream_pages_fact": stream_pages_fact,
    "stream_page_receipts": stream_page_receipts,
    "csv_append_once": csv_append_once,
    "csv_pruned_regions": csv_pruned_regions,
    "csv_dates": csv_dates,
    "csv_peek": csv_peek,
    "fact_load_dates": fact_load_dates,
}

# --------------------------------------------------------------------------
# Batch analyses, serving datasets, dashboard views
# --------------------------------------------------------------------------


def _merge_partials(s, sf):
    """Partial aggregates stored by batch (two ranges of years, and rows without one), then merged."""
    c = _counts(s, sf)
    batches = [an.partial_hourly(c, last_year=2019), an.partial_hourly(c, first_year=2020), an.partial_hourly(c)]
    return an.merge_partial_aggregates([materialise(b, "partial-hourly") for b in batches], ["hour"])


_SERVING: dict = {}
_LOCK = threading.Lock()


def _served(spark, sf, name):
    """A stored serving dataset; the six are written once per session and input."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf))
    with _LOCK:
        if key not in _SERVING:
            out = Snapshots(spark, new_output_dir(spark, "serving"))
            sv.refresh_serving(landing_for(spark, sf).extracts(), out)
            _SERVING[key] = out
    return sv.distinct_points(_SERVING[key], ["region_name", "road_category"]) if name == sv.POINT_SETS else \
        sv.served(_SERVING[key], name)


def _reloaded(spark, sf):
    """An extract delivered whole and served; then 2020 comes again with the odd points only, and the datasets follow.
    Returns the yearly totals with the years that the second refresh computed."""
    raw = _raw(spark, sf)
    source, out = (Snapshots(spark, new_output_dir(spark, n)) for n in ("extracts", "serving"))
    extracts.deliver(source, raw, by_year=True)
    sv.refresh_serving(source, out)
    extracts.deliver(source, raw.where(F.col("count_point_id") % 2 == 1), [2020])
    again = sv.refresh_serving(source, out)
    return sv.served(out, "yearly_totals").withColumn("refreshed", F.col("Year").isin(again))


def _view(view, dataset):
    return lambda s, sf: view(_served(s, sf, dataset))


def _roads_geojson(s, sf):
    wh = warehouse_for(s, sf)
    raw = _typed(s, sf)
    traffic = raw.groupBy(F.col("count_point_id").alias("CountPointID")).agg(
        an.psum("all_motor_vehicles").alias("all_motor_vehicles"))
    return sv.point_features(wh.table("DimCountPoint"), traffic)


def roads_geojson_document(spark, sf):
    """The point features written as one document; its lines, in order."""
    from .sources.sinks import write_geojson_document

    path = new_output_dir(spark, "geojson")
    write_geojson_document(_roads_geojson(spark, sf), path, "CountPointID")
    return spark.read.text(path).select(F.col("value").alias("line"))


ANALYSES = {
    "estimation_method_by_year": lambda s, sf: an.estimation_method_by_year(_typed(s, sf)),
    "estimation_method_detailed": lambda s, sf: an.estimation_method_detailed(_typed(s, sf)),
    "road_category_trends": lambda s, sf: an.road_category_trends(_typed(s, sf)),
    "hgv_axle_trends": lambda s, sf: an.hgv_axle_trends(_typed(s, sf)),
    "vehicle_mode_trends": lambda s, sf: an.vehicle_mode_trends(_typed(s, sf)),
    "count_point_coverage": lambda s, sf: an.count_point_coverage(_points(s, sf)),
    "region_coverage_density": lambda s, sf: an.region_coverage_density(_points(s, sf)),
    "directional_imbalance_pivot": lambda s, sf: an.directional_imbalance_pivot(_typed(s, sf)),
    "road_utilization_top100": lambda s, sf: an.road_utilization_top100(_typed(s, sf)),
    "aadf_key_findings": lambda s, sf: an.aadf_key_findings(_typed(s, sf), _points(s, sf)),
    "peak_hour_pattern": lambda s, sf: an.peak_hour_pattern(_counts(s, sf)),
    "peak_period_share": lambda s, sf: an.peak_period_share(_counts(s, sf)),
    "day_of_week_pattern": lambda s, sf: an.day_of_week_pattern(_counts(s, sf)),
    "weekend_split": lambda s, sf: an.weekend_split(_counts(s, sf)),
    "seasonal_pattern": lambda s, sf: an.seasonal_pattern(_counts(s, sf)),
    "year_hour_heatmap": lambda s, sf: an.year_hour_heatmap(_counts(s, sf)),
    "road_category_hourly": lambda s, sf: an.road_category_hourly(_counts(s, sf)),
    "raw_key_findings": lambda s, sf: an.raw_key_findings(_counts(s, sf)),
    "merge_partial_aggregates": _merge_partials,
    "serve_yearly_totals": lambda s, sf: _served(s, sf, "yearly_totals"),
    "serve_regional_by_year": lambda s, sf: _served(s, sf, "regional_by_year"),
    "serve_top_roads_by_year": lambda s, sf: _served(s, sf, "top_roads_by_year"),
    "serve_geo_hotspots": lambda s, sf: _served(s, sf, "geospatial_hotspots"),
    "serve_vehicle_mix": lambda s, sf: _served(s, sf, "vehicle_mix"),
    "serve_road_category_by_year": lambda s, sf: _served(s, sf, "road_category_by_year"),
    "serve_distinct_points": lambda s, sf: _served(s, sf, sv.POINT_SETS),
    "serve_refresh_changed_year": _reloaded,
    "cloud_kpis": _view(sv.cloud_kpis, "yearly_totals"),
    "cloud_yoy": _view(sv.cloud_yoy, "yearly_totals"),
    "cloud_region_table": _view(sv.cloud_region_table, "regional_by_year"),
    "cloud_hgv_share": _view(sv.cloud_hgv_share, "vehicle_mix"),
    "cloud_vehicle_long": _view(sv.cloud_vehicle_long, "yearly_totals"),
    "cloud_lgv_share": _view(sv.cloud_lgv_share, "yearly_totals"),
    "cloud_bus_share": _view(sv.cloud_bus_share, "yearly_totals"),
    "cloud_road_category": _view(sv.cloud_road_category, "road_category_by_year"),
    "cloud_top_roads": _view(sv.cloud_top_roads, "top_roads_by_year"),
    "cloud_hotspots": _view(sv.cloud_hotspots, "geospatial_hotspots"),
    "chart_feeds": lambda s, sf: sv.chart_feeds(warehouse_for(s, sf)),
    "roads_with_traffic": lambda s, sf: sv.roads_with_traffic(
        landing_for(s, sf).table("road_segments"), _typed(s, sf)),
    "roads_with_traffic_2023": lambda s, sf: sv.roads_with_traffic(
        landing_for(s, sf).table("road_segments"), _typed(s, sf), 2023),
    "roads_geojson": _roads_geojson,
    "roads_geojson_document": roads_geojson_document,
}

# --------------------------------------------------------------------------
# Data quality, reconciliation, profiling, export
# --------------------------------------------------------------------------


def _profile_files(s, sf):
    land = landing_for(s, sf)
    paths = {}
    for name in ["count_points", "raw_aadf", "raw_counts", "full_aadf", "subset_aadf"]:
        land.table(name)
        paths[name] = land.path(name)
    paths["raw_aadf_csv"] = land.csv_path("raw_aadf")
    paths["local_authority_traffic"] = land.path("local_authority_traffic")  # never delivered
    return dq.profile_files(s, paths)


def export_reports(spark, sf, names=None):
    """Write the published exports as CSV and return what the files hold, read back."""
    from .plans import exports

    wh = warehouse_for(spark, sf)
    out = new_output_dir(spark, "reports")
    results = exports.report_results(wh)
    names = names or list(results)
    failed = [r for r in exports.write_results({n: results[n] for n in names}, out) if r[1] != "OK"]
    if failed:
        raise RuntimeError(f"exports failed: {failed}")
    return exports.written_content(spark, out, names)


def _sql(name, **args):
    """A statement of the catalogue, run as SQL text with bound values."""
    return lambda s, sf: Catalogue(warehouse_for(s, sf)).run(name, **args)


def _sql_quoted(spark, sf):
    """A text given by the caller; one of its values holds quotes and SQL."""
    text = """SELECT RegionName, RegionName = :name AS same, :name AS given, sum(AllMotorVehicles) AS total
        FROM FactTrafficFlowDirection f JOIN DimRegion r ON r.RegionKey = f.RegionKey
        WHERE f.DateKey >= :since GROUP BY RegionName"""
    return Catalogue(warehouse_for(spark, sf)).sql(text, {"name": "ASIA' OR '1'='1\" --", "since": 2019})


def _bucketed(name):
    """A report over the bucketed copies of the fact and the count points."""
    def run(spark, sf):
        from .plans.bucketed import bucketed

        key = ("bucketed", spark.sparkContext.applicationId, os.path.abspath(sf))
        with _LOCK:
            if key not in _SERVING:
                _SERVING[key] = bucketed(warehouse_for(spark, sf), 8)
        return getattr(reports, name)(_SERVING[key])

    return run


BUCKETED = {f"bucketed_{name}": _bucketed(name) for name in ("top_busiest_roads", "road_category_distribution")}

SQL_TEXT = {
    **{f"sql_{name}": _sql(name) for name in (
        "table_rows", "regions", "yearly_totals", "traffic_by_region", "vehicle_mix_by_region", "hotspots")},
    "sql_top_roads": _sql("top_roads", year=2022, limit=25),
    "sql_roads_of_region": _sql("roads_of_region", regions=["EUROPE", "O'Neil's \"region\""], first=2019, last=2022),
    "sql_quoted_value": _sql_quoted,
}

QUALITY = {
    "dq_row_counts": lambda s, sf: dq.dq_row_counts(warehouse_for(s, sf)),
    "dq_null_check": lambda s, sf: dq.dq_null_check(warehouse_for(s, sf)),
    "dq_negative_values": lambda s, sf: dq.dq_negative_values(warehouse_for(s, sf)),
    "dq_orphan_facts": lambda s, sf: dq.dq_orphan_facts(warehouse_for(s, sf)),
    "dq_year_coverage": lambda s, sf: dq.dq_year_coverage(warehouse_for(s, sf)),
    "dq_direction_distribution": lambda s, sf: dq.dq_direction_distribution(warehouse_for(s, sf)),
    "dq_report": lambda s, sf: dq.dq_report(warehouse_for(s, sf)),
    "dq_status_totals": lambda s, sf: dq.dq_status_totals(dq.dq_report(warehouse_for(s, sf))),
    "profile_files": _profile_files,
    "profile_extract": lambda s, sf: dq.profile_extract(_raw(s, sf)),
    "profile_direction_counts": lambda s, sf: dq.profile_direction_counts(_raw(s, sf)),
    "compare_datasets": lambda s, sf: dq.compare_datasets(
        _raw(s, sf), pg.flatten_pages(pg.read_pages(s, landing_for(s, sf).pages_path()))),
    "count_points_profile": lambda s, sf: dq.count_points_profile(_points(s, sf)),
    "reconcile_direction_sums": lambda s, sf: dq.reconcile_direction_sums(
        _typed(s, sf), landing_for(s, sf).table("full_aadf")),
    "reconcile_subset": lambda s, sf: dq.reconcile_subset(
        landing_for(s, sf).table("subset_aadf"), landing_for(s, sf).table("full_aadf")),
    "reconcile_id_overlap": lambda s, sf: dq.reconcile_id_overlap(
        landing_for(s, sf).table("subset_aadf"), landing_for(s, sf).table("full_aadf")),
    "export_reports": export_reports,
}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name in WAREHOUSE_REPORTS:
        out[name] = _on_warehouse(name)
    for group in (ETL, ANALYSES, SQL_TEXT, BUCKETED, QUALITY):
        out.update(group)
    return {name: _plain(query) for name, query in out.items()}


def _plain(query: Query) -> Query:
    """Sums are kept as exact decimals up to here."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decimals_as_double(query(spark, sf_dir))

    run.__name__ = getattr(query, "__name__", "run")
    return run


def oracle_sql() -> dict[str, str]:
    from .oracle import analyses_sql, etl_sql, quality_sql, reports_sql

    out = {}
    for mod in (reports_sql, etl_sql, analyses_sql, quality_sql):
        out.update(mod.oracle())
    return out

"""DuckDB oracle SQL for the raw-extract analyses and serving datasets."""

from __future__ import annotations

from .base import exact, with_base
from .reports_sql import SQL as REPORT_SQL


def ps(expr: str) -> str:
    """Sum where nothing sums to 0, as double."""
    return f"coalesce(CAST(SUM({expr}) AS DOUBLE), 0.0)"


def pn(c: str) -> str:
    return ps(exact(c))


def ratio(a: str, b: str, d: int, scale: str = "100.0") -> str:
    return f"round_even(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0) * {scale}, {d})"


LABEL = """CASE road_category WHEN 'TM' THEN 'Trunk Motorway' WHEN 'PM' THEN 'Principal Motorway'
    WHEN 'TA' THEN 'Trunk A-road' WHEN 'PA' THEN 'Principal A-road' WHEN 'M' THEN 'Minor'
    WHEN 'MB' THEN 'B-road' WHEN 'MCU' THEN 'C/Unclassified' END"""

MONTHS = """CASE month WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr' WHEN 5 THEN 'May'
    WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct'
    WHEN 11 THEN 'Nov' WHEN 12 THEN 'Dec' END"""

AXLES = ["HGVs_2_rigid_axle", "HGVs_3_rigid_axle", "HGVs_4_or_more_rigid_axle",
         "HGVs_3_or_4_articulated_axle", "HGVs_5_articulated_axle", "HGVs_6_articulated_axle"]

COUNT_MEASURES = ["pedal_cycles", "two_wheeled_motor_vehicles", "cars_and_taxis", "buses_and_coaches",
                  "LGVs", "all_HGVs", "all_motor_vehicles"]

CAL = """SELECT *, CAST(isodow(count_date) - 1 AS INTEGER) AS day_of_week, dayname(count_date) AS day_name,
    CAST(month(count_date) AS INTEGER) AS month,
    CAST(isodow(count_date) - 1 IN (5, 6) AS INTEGER) AS is_weekend FROM raw_counts"""


def count_sums(keys: str, src: str = "raw_counts", where: str = "") -> str:
    sums = ", ".join(f"CAST(coalesce(SUM({c}), 0) AS BIGINT) AS {c}" for c in COUNT_MEASURES)
    nn = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    w = f"WHERE {nn}" + (f" AND {where}" if where else "")
    return f"SELECT {keys}, {sums} FROM ({src}) s {w} GROUP BY {keys}"


HOUR_LABEL = "lpad(CAST(hour AS VARCHAR), 2, '0') || ':00-' || lpad(CAST(hour + 1 AS VARCHAR), 2, '0') || ':00'"


def hour_matrix(key: str) -> str:
    cols = ", ".join(
        f"CAST(coalesce(SUM(all_motor_vehicles) FILTER (WHERE hour = {h}), 0) AS BIGINT) AS \"{h}\""
        for h in [*range(7, 19), 24])  # the hours of the derived counts
    return f"SELECT {key}, {cols} FROM raw_counts WHERE {key} IS NOT NULL AND hour IS NOT NULL GROUP BY {key}"


def _argmax(finding: str, src: str, label: str, key: str, smallest: bool) -> str:
    direction = "ASC" if smallest else "DESC"
    return (f"SELECT * FROM (SELECT '{finding}' AS finding, CAST({label} AS VARCHAR) AS label, "
            f"CAST(all_motor_vehicles AS DOUBLE) AS value FROM ({src}) x "
            f"ORDER BY all_motor_vehicles {direction}, {key} ASC LIMIT 1) y")


YEARLY = f"""SELECT year AS Year, {pn('all_motor_vehicles')} AS TotalMotor, {pn('all_HGVs')} AS TotalHGV,
    {pn('pedal_cycles')} AS TotalCycles, {pn('cars_and_taxis')} AS TotalCars, {pn('LGVs')} AS TotalLGVs,
    {pn('buses_and_coaches')} AS TotalBuses, {pn('two_wheeled_motor_vehicles')} AS TotalMotorcycles,
    count(DISTINCT count_point_id) AS CountPoints FROM raw_aadf WHERE year IS NOT NULL GROUP BY year"""

REGIONAL = f"""SELECT year AS Year, region_name AS RegionName, {pn('all_motor_vehicles')} AS TotalMotor,
    {pn('all_HGVs')} AS TotalHGV, {pn('cars_and_taxis')} AS TotalCars, {pn('LGVs')} AS TotalLGVs,
    {pn('buses_and_coaches')} AS TotalBuses, {pn('two_wheeled_motor_vehicles')} AS TotalMotorcycles,
    {pn('pedal_cycles')} AS TotalCycles, count(DISTINCT count_point_id) AS CountPoints
    FROM raw_aadf WHERE year IS NOT NULL AND region_name IS NOT NULL GROUP BY year, region_name"""

TOP_ROADS = f"""SELECT Year, RoadName, RoadCategory, TotalTraffic FROM (
    SELECT *, row_number() OVER (PARTITION BY Year ORDER BY TotalTraffic DESC, RoadName, RoadCategory) AS rn
    FROM (SELECT year AS Year, road_name AS RoadName, road_category AS RoadCategory,
                 {pn('all_motor_vehicles')} AS TotalTraffic
          FROM raw_aadf WHERE year IS NOT NULL AND road_name IS NOT NULL AND road_category IS NOT NULL
          GROUP BY year, road_name, road_category) g) t WHERE rn <= 50"""

LATEST = "year = (SELECT max(year) FROM raw_aadf)"

GEO = f"""SELECT * FROM (SELECT count_point_id AS CountPointID, road_name AS RoadName, region_name AS RegionName,
    {pn('all_motor_vehicles')} AS TotalTraffic,
    CAST(arg_min(latitude, latitude * 1000 + longitude) AS DOUBLE) AS Latitude,
    CAST(arg_min(longitude, latitude * 1000 + longitude) AS DOUBLE) AS Longitude
    FROM raw_aadf WHERE {LATEST} AND count_point_id IS NOT NULL AND road_name IS NOT NULL
      AND region_name IS NOT NULL
    GROUP BY count_point_id, road_name, region_name) g WHERE TotalTraffic > 10000"""

MIX = f"""SELECT region_name AS RegionName, {pn('cars_and_taxis')} AS Cars, {pn('LGVs')} AS LGVs,
    {pn('all_HGVs')} AS HGVs, {pn('buses_and_coaches')} AS Buses,
    {pn('two_wheeled_motor_vehicles')} AS Motorcycles, {pn('pedal_cycles')} AS Cycles
    FROM raw_aadf WHERE {LATEST} AND region_name IS NOT NULL GROUP BY region_name"""

ROAD_CAT = f"""SELECT year AS Year, road_category AS RoadCategory, {pn('all_motor_vehicles')} AS TotalTraffic,
    count(DISTINCT count_point_id) AS CountPoints FROM raw_aadf
    WHERE year IS NOT NULL AND road_category IS NOT NULL GROUP BY year, road_category"""


def _feed(chart, series, report, x, y, scale=None):
    yv = f"CAST({y} AS DOUBLE)" + (f" / {scale}" if scale else "")
    return (f"SELECT '{chart}' AS chart, '{series}' AS series, CAST({x} AS VARCHAR) AS x, "
            f"round({yv}, 6) AS y FROM ({REPORT_SQL[report]}) t WHERE {y} IS NOT NULL")


CHART_FEEDS = " UNION ALL ".join([
    _feed("yoy_growth_trend", "traffic_billions", "yoy_growth_trend", "Year", "TotalTraffic", "1e9"),
    _feed("yoy_growth_trend", "growth_pct", "yoy_growth_trend", "Year", "YoY_GrowthPct"),
    _feed("regional_traffic", "motor_millions", "regional_traffic_summary", "RegionName", "TotalMotorVehicles", "1e6"),
    _feed("hgv_passenger_mix", "hgv_pct", "hgv_passenger_mix", "RegionName", "HGV_Pct"),
    *[_feed("covid_impact", f"{c.lower()}_millions", "covid_impact", "Year", c, "1e6")
      for c in ["Cars", "LGVs", "HGVs", "Buses", "Cycles"]],
    _feed("cycling_trends", "cycles_thousands", "cycling_share_export", "Year", "TotalCycles", "1e3"),
    _feed("cycling_trends", "share_pct", "cycling_share_export", "Year", "CycleSharePct"),
    _feed("road_category_pie", "traffic", "road_category_distribution", "RoadCategory", "TotalTraffic"),
    _feed("lgv_ecommerce_trend", "lgv_share_pct", "lgv_growth_trend", "Year", "LGV_Share_Pct"),
])

ROAD_TRAFFIC = f"""SELECT count_point_id, {pn('all_motor_vehicles')} AS all_motor_vehicles FROM raw_aadf
    WHERE count_point_id IS NOT NULL {{where}} GROUP BY count_point_id"""

SQL = {
    "estimation_method_by_year": f"""SELECT year, Counted, Estimated, total,
        {ratio('Counted', 'total', 2)} AS counted_pct FROM (
          SELECT year, count_if(estimation_method = 'Counted') AS Counted,
                 count_if(estimation_method = 'Estimated') AS Estimated, count(*) AS total
          FROM raw_aadf WHERE year IS NOT NULL AND estimation_method IS NOT NULL GROUP BY year) t""",
    "estimation_method_detailed": """SELECT estimation_method_detailed, count(*) AS count FROM raw_aadf
        WHERE estimation_method_detailed IS NOT NULL GROUP BY estimation_method_detailed""",
    "road_category_trends": f"""SELECT *, {ratio('total_hgv', 'total_motor', 2)} AS hgv_pct FROM (
        SELECT year, road_category, road_label, {pn('all_motor_vehicles')} AS total_motor,
          {pn('all_HGVs')} AS total_hgv, {pn('pedal_cycles')} AS total_cycles,
          count(DISTINCT count_point_id) AS count_points, round(CAST(sum({exact('all_motor_vehicles')}) AS DOUBLE)
            / nullif(count({exact('all_motor_vehicles')}), 0), 6) AS avg_flow
        FROM (SELECT *, {LABEL} AS road_label FROM raw_aadf) r
        WHERE year IS NOT NULL AND road_category IS NOT NULL AND road_label IS NOT NULL
        GROUP BY year, road_category, road_label) t""",
    "hgv_axle_trends": "SELECT *, " + ", ".join(
        f"{ratio(c, 'all_HGVs', 2)} AS \"{c.replace('HGVs_', '').replace('_axle', '')}_pct\"" for c in AXLES)
        + " FROM (SELECT year, " + ", ".join(f"{pn(c)} AS {c}" for c in AXLES + ["all_HGVs"])
        + " FROM raw_aadf WHERE year IS NOT NULL GROUP BY year) t",
    "vehicle_mode_trends": f"""SELECT *, {ratio('motorcycles', 'all_motor', 3)} AS motorcycles_pct,
        {ratio('buses', 'all_motor', 3)} AS buses_pct, {ratio('cars', 'all_motor', 3)} AS cars_pct,
        {ratio('lgvs', 'all_motor', 3)} AS lgvs_pct, {ratio('cycles', 'all_motor + cycles', 3)} AS cycles_pct
        FROM (SELECT year, {pn('two_wheeled_motor_vehicles')} AS motorcycles, {pn('buses_and_coaches')} AS buses,
          {pn('cars_and_taxis')} AS cars, {pn('LGVs')} AS lgvs, {pn('pedal_cycles')} AS cycles,
          {pn('all_motor_vehicles')} AS all_motor FROM raw_aadf WHERE year IS NOT NULL GROUP BY year) t""",
    "count_point_coverage": f"""SELECT *, {ratio('num_points', 'total_link_km', 2)} AS points_per_100km FROM (
        SELECT region_name, road_category, count(DISTINCT count_point_id) AS num_points,
          {ps('link_length_km')} AS total_link_km FROM count_points
        WHERE region_name IS NOT NULL AND road_category IS NOT NULL GROUP BY region_name, road_category) t""",
    "region_coverage_density": f"""SELECT *, {ratio('num_points', 'total_link_km', 4, '1.0')} AS density FROM (
        SELECT region_name, count(DISTINCT count_point_id) AS num_points, {ps('link_length_km')} AS total_link_km
        FROM count_points WHERE region_name IS NOT NULL GROUP BY region_name) t""",
    "directional_imbalance_pivot": """SELECT *, round_even(max_dir / CASE WHEN min_dir = 0 THEN 1.0 ELSE min_dir END, 2)
          AS imbalance_ratio FROM (
          SELECT *, greatest(E, N, S, W) AS max_dir, least(E, N, S, W) AS min_dir FROM imb_pivot) t
        ORDER BY imbalance_ratio DESC NULLS LAST, count_point_id, year, road_name LIMIT 50""",
    "road_utilization_top100": f"""SELECT count_point_id, road_name, road_category, region_name,
          CAST(link_length_km AS DOUBLE) AS link_length_km, all_motor_vehicles, flow_per_km FROM (
          SELECT *, round_even(all_motor_vehicles / NULLIF(CAST(link_length_km AS DOUBLE), 0), 0) AS flow_per_km
          FROM (SELECT count_point_id, road_name, road_category, region_name, link_length_km,
                       {pn('all_motor_vehicles')} AS all_motor_vehicles
                FROM raw_aadf WHERE year = 2023 AND count_point_id IS NOT NULL AND road_name IS NOT NULL
                  AND road_category IS NOT NULL AND region_name IS NOT NULL AND link_length_km IS NOT NULL
                GROUP BY count_point_id, road_name, road_category, region_name, link_length_km) g) t
        WHERE flow_per_km IS NOT NULL
        ORDER BY flow_per_km DESC, count_point_id, road_name, road_category, region_name, t.link_length_km
        LIMIT 100""",
    "aadf_key_findings": """SELECT metric, value FROM (
          SELECT round(count_if(estimation_method = 'Counted') * 100.0 / count(*), 6) AS counted_pct,
            CAST(count_if(road_category = 'TM') AS DOUBLE) AS tm_rows,
            CAST(count_if(road_category = 'PM') AS DOUBLE) AS pm_rows,
            CAST(count_if(road_category = 'TA') AS DOUBLE) AS ta_rows,
            CAST(count_if(road_category = 'PA') AS DOUBLE) AS pa_rows,
            CAST(count_if(road_category IN ('M', 'MB', 'MCU')) AS DOUBLE) AS minor_rows
          FROM raw_aadf) a
        UNPIVOT (value FOR metric IN (counted_pct, tm_rows, pm_rows, ta_rows, pa_rows, minor_rows))
        UNION ALL
        SELECT 'estimated_pct', round(100.0 - round(count_if(estimation_method = 'Counted') * 100.0 / count(*), 6), 6)
        FROM raw_aadf
        UNION ALL SELECT 'unique_count_points', CAST(count(DISTINCT count_point_id) AS DOUBLE) FROM count_points
        UNION ALL SELECT 'regions', CAST(count(DISTINCT region_name) AS DOUBLE) FROM count_points""",
    "peak_hour_pattern": f"SELECT *, {HOUR_LABEL} AS hour_label FROM ({count_sums('hour')}) t",
    "peak_period_share": """SELECT
        round(CAST(SUM(CASE WHEN hour IN (7, 8, 9) THEN all_motor_vehicles END) AS DOUBLE) * 100.0
              / CAST(SUM(all_motor_vehicles) AS DOUBLE), 6) AS am_peak_pct,
        round(CAST(SUM(CASE WHEN hour IN (16, 17, 18) THEN all_motor_vehicles END) AS DOUBLE) * 100.0
              / CAST(SUM(all_motor_vehicles) AS DOUBLE), 6) AS pm_peak_pct
        FROM raw_counts WHERE hour IS NOT NULL""",
    "day_of_week_pattern": count_sums("day_of_week, day_name", CAL),
    "weekend_split": count_sums("is_weekend", CAL),
    "seasonal_pattern": f"SELECT *, {MONTHS} AS month_name FROM ({count_sums('month', CAL)}) t",
    "year_hour_heatmap": hour_matrix("year"),
    "road_category_hourly": hour_matrix("road_category"),
    "raw_key_findings": " UNION ALL ".join([
        _argmax("peak_hour", f"SELECT *, {HOUR_LABEL} AS hour_label FROM ({count_sums('hour')}) h",
                "hour_label", "hour", False),
        _argmax("quietest_hour", f"SELECT *, {HOUR_LABEL} AS hour_label FROM ({count_sums('hour')}) h",
                "hour_label", "hour", True),
        _argmax("busiest_day", count_sums("day_of_week, day_name", CAL), "day_name", "day_of_week", False),
        _argmax("quietest_day", count_sums("day_of_week, day_name", CAL), "day_name", "day_of_week", True),
        _argmax("busiest_month", f"SELECT *, {MONTHS} AS month_name FROM ({count_sums('month', CAL)}) m",
                "month_name", "month", False),
    ]),
    "merge_partial_aggregates": count_sums("hour"),
    "serve_yearly_totals": YEARLY,
    "serve_regional_by_year": REGIONAL,
    "serve_top_roads_by_year": TOP_ROADS,
    "serve_geo_hotspots": GEO,
    "serve_vehicle_mix": MIX,
    "serve_road_category_by_year": ROAD_CAT,
    "cloud_kpis": f"""SELECT Year, TotalMotor, TotalHGV, CountPoints, MotorDelta, HGVDelta FROM (
        SELECT Year, TotalMotor, TotalHGV, CountPoints,
          TotalMotor - lag(TotalMotor) OVER (ORDER BY Year) AS MotorDelta,
          TotalHGV - lag(TotalHGV) OVER (ORDER BY Year) AS HGVDelta FROM ({YEARLY}) y) t
        WHERE Year = (SELECT max(year) FROM raw_aadf)""",
    "cloud_yoy": f"""SELECT * FROM (SELECT Year,
          round((TotalMotor / NULLIF(lag(TotalMotor) OVER (ORDER BY Year), 0) - 1) * 100.0, 6) AS YoY_Growth
          FROM ({YEARLY}) y) t WHERE YoY_Growth IS NOT NULL""",
    "cloud_region_table": f"SELECT RegionName, TotalMotor, TotalHGV, CountPoints FROM ({REGIONAL}) r WHERE Year = 2023",
    "cloud_hgv_share": f"""SELECT RegionName, HGVs, {ratio('HGVs', 'Cars + LGVs + HGVs + Buses + Motorcycles', 2)}
        AS HGV_Pct FROM ({MIX}) m""",
    "cloud_vehicle_long": f"""SELECT Year, replace(Vehicle, 'Total', '') AS Vehicle, AADF FROM (
        UNPIVOT (SELECT Year, TotalCars, TotalLGVs, TotalHGV, TotalBuses, TotalCycles FROM ({YEARLY}) y
                 WHERE Year BETWEEN 2017 AND 2023)
        ON TotalCars, TotalLGVs, TotalHGV, TotalBuses, TotalCycles INTO NAME Vehicle VALUE AADF) u""",
    "cloud_lgv_share": f"SELECT Year, {ratio('TotalLGVs', 'TotalMotor', 2)} AS LGV_Share FROM ({YEARLY}) y",
    "cloud_bus_share": f"SELECT Year, {ratio('TotalBuses', 'TotalMotor', 3)} AS Bus_Share FROM ({YEARLY}) y",
    "cloud_road_category": f"SELECT RoadCategory, TotalTraffic FROM ({ROAD_CAT}) r WHERE Year = 2023",
    "cloud_top_roads": f"""SELECT * FROM ({TOP_ROADS}) t WHERE Year = 2023
        ORDER BY TotalTraffic DESC, RoadName, RoadCategory LIMIT 20""",
    "cloud_hotspots": f"SELECT * FROM ({GEO}) g WHERE TotalTraffic >= 50000",
    "chart_feeds": CHART_FEEDS,
    "roads_with_traffic": f"""SELECT s.CP_Number, s.RoadNumber, t.count_point_id, t.all_motor_vehicles
        FROM road_segments s LEFT JOIN ({ROAD_TRAFFIC.format(where='')}) t ON s.CP_Number = t.count_point_id""",
    "roads_with_traffic_2023": f"""SELECT s.CP_Number, s.RoadNumber, t.count_point_id, t.all_motor_vehicles
        FROM road_segments s LEFT JOIN ({ROAD_TRAFFIC.format(where='AND year = 2023')}) t
        ON s.CP_Number = t.count_point_id""",
    "roads_geojson": f"""SELECT cp.CountPointID, to_json(struct_pack(
          type := 'Feature',
          geometry := struct_pack(type := 'Point',
                                  coordinates := [CAST(cp.Longitude AS DOUBLE), CAST(cp.Latitude AS DOUBLE)]),
          properties := struct_pack(CP_Number := cp.CountPointID, RoadNumber := cp.RoadName,
                                    all_motor_vehicles := t.all_motor_vehicles))) AS feature
        FROM DimCountPoint cp LEFT JOIN ({ROAD_TRAFFIC.format(where='')}) t ON cp.CountPointID = t.count_point_id""",
}

EXTRA = {
    "directional_imbalance_pivot": {
        "imb_perdir": f"""SELECT count_point_id, year, road_name, direction_of_travel,
              {pn('all_motor_vehicles')} AS flow FROM raw_aadf
            WHERE count_point_id IS NOT NULL AND year IS NOT NULL AND road_name IS NOT NULL
              AND direction_of_travel IS NOT NULL AND direction_of_travel <> 'C' AND year = 2023
            GROUP BY count_point_id, year, road_name, direction_of_travel""",
        "imb_pivot": """SELECT count_point_id, year, road_name,
              coalesce(SUM(CASE WHEN direction_of_travel = 'E' THEN flow END), 0.0) AS E,
              coalesce(SUM(CASE WHEN direction_of_travel = 'N' THEN flow END), 0.0) AS N,
              coalesce(SUM(CASE WHEN direction_of_travel = 'S' THEN flow END), 0.0) AS S,
              coalesce(SUM(CASE WHEN direction_of_travel = 'W' THEN flow END), 0.0) AS W,
              coalesce(SUM(CASE WHEN direction_of_travel = 'X' THEN flow END), 0.0) AS X
            FROM imb_perdir GROUP BY count_point_id, year, road_name""",
    },
}


SQL |= {
    "serve_distinct_points": """SELECT region_name, road_category, count(DISTINCT count_point_id) AS CountPoints
        FROM raw_aadf WHERE year IS NOT NULL GROUP BY region_name, road_category""",
    "roads_geojson_document": f"""SELECT
        CASE WHEN row_number() OVER (ORDER BY CountPointID) = 1 THEN '{{"type":"FeatureCollection","features":[' ELSE '' END
        || CAST(feature AS VARCHAR)
        || CASE WHEN row_number() OVER (ORDER BY CountPointID DESC) = 1 THEN ']}}' ELSE ',' END AS line
        FROM ({SQL["roads_geojson"]}) g""",
    "serve_refresh_changed_year": "SELECT *, Year = 2020 AS refreshed FROM ("
        + YEARLY.replace("raw_aadf", "(SELECT * FROM raw_aadf WHERE year <> 2020 OR count_point_id % 2 = 1) r") + ") y",
}


def oracle() -> dict[str, str]:
    return {k: with_base(v, EXTRA.get(k)) for k, v in SQL.items()}

"""DuckDB oracle SQL for data quality, reconciliation and profiling."""

from __future__ import annotations

from ..plans.exports import REPORTS, TEXT_COLUMNS
from .base import exact, with_base
from .reports_sql import SQL as REPORT_SQL

MINIMA = {"DimDate": 10, "DimRegion": 5, "DimLocalAuthority": 100, "DimCountPoint": 10000,
          "FactTrafficFlowDirection": 500000}
TABLES = ["DimDate", "DimRegion", "DimLocalAuthority", "DimCountPoint", "FactTrafficFlowDirection"]

ROW_COUNTS = "SELECT TableName, RowCount, MinExpected, CASE WHEN RowCount < MinExpected THEN 'WARN' ELSE 'PASS' END AS Status FROM (" + \
    " UNION ALL ".join(f"SELECT '{t}' AS TableName, count(*) AS RowCount, CAST({MINIMA[t]} AS BIGINT) AS MinExpected FROM {t}"
                       for t in TABLES) + ") c"

NEGATIVE = """SELECT *, CASE WHEN NegMotor > 0 OR NegHGV > 0 OR NegCars > 0 OR NegCycles > 0 THEN 'FAIL' ELSE 'PASS' END
      AS Status FROM (SELECT count_if(AllMotorVehicles < 0) AS NegMotor, count_if(AllHGVs < 0) AS NegHGV,
      count_if(CarsAndTaxis < 0) AS NegCars, count_if(PedalCycles < 0) AS NegCycles, count(*) AS TotalRows
      FROM FactTrafficFlowDirection) t"""

NULLS = {"NullDateKey": "DateKey", "NullCountPointKey": "CountPointKey", "NullRegionKey": "RegionKey",
         "NullLAKey": "LocalAuthorityKey", "NullDirection": "DirectionOfTravel", "NullMotorVehicles": "AllMotorVehicles"}
NULL_CHECK = ("SELECT *, " + ", ".join(f"round({a} * 100.0 / nullif(TotalRows, 0), 2) AS {a}Pct" for a in NULLS)
              + " FROM (SELECT " + ", ".join(f"count_if({c} IS NULL) AS {a}" for a, c in NULLS.items())
              + ", count(*) AS TotalRows FROM FactTrafficFlowDirection) c")

ORPHANS = """SELECT count_if(d.DateKey IS NULL) AS OrphanDate, count_if(cp.CountPointKey IS NULL) AS OrphanCP,
        count_if(r.RegionKey IS NULL) AS OrphanRegion, count_if(la.LocalAuthorityKey IS NULL) AS OrphanLA,
        count(*) AS TotalRows
        FROM FactTrafficFlowDirection f
        LEFT JOIN DimDate d ON f.DateKey = d.DateKey
        LEFT JOIN DimCountPoint cp ON f.CountPointKey = cp.CountPointKey
        LEFT JOIN DimRegion r ON f.RegionKey = r.RegionKey
        LEFT JOIN DimLocalAuthority la ON f.LocalAuthorityKey = la.LocalAuthorityKey"""
YEARS = """SELECT d.Year, count(*) AS FactRows FROM FactTrafficFlowDirection f
        JOIN DimDate d ON f.DateKey = d.DateKey GROUP BY d.Year"""
DIRECTIONS = "SELECT DirectionOfTravel, count(*) AS Cnt FROM FactTrafficFlowDirection GROUP BY DirectionOfTravel"


def _check(name: str, sql: str, first: str, status: str = "'PASS'") -> str:
    """The check's result as JSON records."""
    return (f"SELECT '{name}' AS \"check\", {status} AS status, "
            f"CAST(to_json(list(t ORDER BY {first})) AS VARCHAR) AS detail FROM ({sql}) t")


REPORT = " UNION ALL ".join([
    _check("row_counts", ROW_COUNTS, "TableName"),
    f"""SELECT 'row_count_' || TableName, 'WARN', CAST(RowCount AS VARCHAR) || ' < ' || CAST(MinExpected AS VARCHAR)
      FROM ({ROW_COUNTS}) r WHERE Status = 'WARN'""",
    _check("null_check_fact", NULL_CHECK, "TotalRows"),
    _check("negative_values", NEGATIVE, "TotalRows", "max(Status)"),
    _check("orphan_facts", ORPHANS, "TotalRows"),
    _check("year_coverage", YEARS, "Year"),
    _check("direction_distribution", DIRECTIONS, "DirectionOfTravel"),
])

RAW_COLS = ("count_point_id, year, region_id, region_name, local_authority_id, road_name, road_category, "
            "direction_of_travel, latitude, longitude, link_length_km, estimation_method, "
            "estimation_method_detailed, pedal_cycles, two_wheeled_motor_vehicles, cars_and_taxis, "
            "buses_and_coaches, LGVs, HGVs_2_rigid_axle, HGVs_3_rigid_axle, HGVs_4_or_more_rigid_axle, "
            "HGVs_3_or_4_articulated_axle, HGVs_5_articulated_axle, HGVs_6_articulated_axle, all_HGVs, "
            "all_motor_vehicles")
FILES = {
    "count_points": ("count_point_id, year, region_id, region_name, region_ons_code, local_authority_id, "
                     "local_authority_name, local_authority_code, road_name, road_category, road_type, latitude, "
                     "longitude, link_length_km", True),
    "raw_aadf": (RAW_COLS.replace("year, ", "", 1) + ", year", True),  # year is the partition column
    "raw_counts": ("count_date, year, hour, road_category, pedal_cycles, two_wheeled_motor_vehicles, "
                   "cars_and_taxis, buses_and_coaches, LGVs, all_HGVs, all_motor_vehicles", False),
    "full_aadf": ("count_point_id, year, all_motor_vehicles", True),
    "subset_aadf": ("count_point_id, year, all_motor_vehicles", True),
}


def _profile(name, cols, has_points):
    pts = "count(DISTINCT count_point_id)" if has_points else "CAST(NULL AS BIGINT)"
    return (f"SELECT '{name}' AS file, 'OK' AS status, count(*) AS rows, {len(cols.split(', '))} AS columns, "
            f"'{cols}' AS column_names, CAST(min(year) AS INTEGER) AS min_year, CAST(max(year) AS INTEGER) AS max_year, "
            f"{pts} AS distinct_points FROM {name}")


PROFILE = " UNION ALL ".join([_profile(n, c, p) for n, (c, p) in FILES.items()]) + \
    " UNION ALL " + _profile("raw_aadf", "extract_version, " + ", ".join(reversed(RAW_COLS.split(", "))), True).replace(
        "'raw_aadf' AS file", "'raw_aadf_csv' AS file") + \
    (" UNION ALL SELECT 'local_authority_traffic', 'MISSING', NULL, NULL, NULL, NULL, NULL, NULL")

def _content() -> str:
    """Rows, filled cells and their sum for each column of each export."""
    parts = []
    for name, (report, columns) in REPORTS.items():
        for c in columns:
            value = f"length({c})" if c in TEXT_COLUMNS else f"round(CAST({c} AS DOUBLE), 4)"
            parts.append(f"SELECT '{name}' AS report, '{c}' AS \"column\", count(*) AS rows, count({c}) AS filled, "
                         f"coalesce(CAST(sum(CAST({value} AS DECIMAL(30,4))) AS DOUBLE), 0) AS total "
                         f"FROM ({REPORT_SQL[report]}) t")
    return " UNION ALL ".join(parts)


# The pages deliver the extract in full, a thousand rows each.
EXTRA = {"compare_datasets": {"page_rows": "SELECT * FROM raw_aadf"}}

SQL = {
    "dq_row_counts": ROW_COUNTS,
    "dq_null_check": NULL_CHECK,
    "dq_negative_values": NEGATIVE,
    "dq_orphan_facts": ORPHANS,
    "dq_year_coverage": YEARS,
    "dq_direction_distribution": DIRECTIONS,
    "dq_report": REPORT,
    "dq_status_totals": f"""SELECT count_if(status = 'PASS') AS passed, count_if(status = 'WARN') AS warned,
        count_if(status IN ('FAIL', 'ERROR')) AS failed FROM ({REPORT}) r""",
    "profile_files": PROFILE,
    "profile_extract": """SELECT count(*) AS rows, min(year) AS min_year, max(year) AS max_year,
        coalesce(bool_or(year = 2025), false) AS has_2025 FROM raw_aadf""",
    "profile_direction_counts": """SELECT direction_of_travel, count(*) AS count FROM raw_aadf
        WHERE direction_of_travel IS NOT NULL GROUP BY direction_of_travel""",
    "compare_datasets": """SELECT l.c AS left_columns, r.c AS right_columns, l.names = r.names AS same_columns,
        l.n AS left_rows, r.n AS right_rows, l.n = r.n AS same_rows
        FROM (SELECT count(*) AS n, (SELECT len(json_keys(to_json(x))) FROM raw_aadf x LIMIT 1) AS c,
                     (SELECT json_keys(to_json(x)) FROM raw_aadf x LIMIT 1) AS names FROM raw_aadf) l,
             (SELECT count(*) AS n, (SELECT len(json_keys(to_json(x))) FROM page_rows x LIMIT 1) AS c,
                     (SELECT json_keys(to_json(x)) FROM page_rows x LIMIT 1) AS names FROM page_rows) r""",
    "count_points_profile": """SELECT count(DISTINCT count_point_id) AS unique_count_points, count(*) AS total_rows,
        min(year) AS min_year, max(year) AS max_year FROM count_points""",
    "reconcile_direction_sums": f"""SELECT count_if(s.mv = f.all_motor_vehicles) AS matching_rows, count(*) AS merged_rows,
        (SELECT count(*) FROM full_aadf) AS total_full
        FROM (SELECT count_point_id, year, coalesce(SUM({exact('all_motor_vehicles')}), 0) AS mv FROM raw_aadf
              WHERE count_point_id IS NOT NULL AND year IS NOT NULL GROUP BY count_point_id, year) s
        JOIN full_aadf f ON s.count_point_id = f.count_point_id AND s.year = f.year""",
    "reconcile_subset": """SELECT CASE WHEN f.count_point_id IS NOT NULL THEN 'both' ELSE 'left_only' END AS _merge,
          count(*) AS count
        FROM subset_aadf s LEFT JOIN full_aadf f ON s.count_point_id = f.count_point_id AND s.year = f.year
        GROUP BY 1""",
    "reconcile_id_overlap": """SELECT
        (SELECT count(*) FROM (SELECT DISTINCT count_point_id FROM subset_aadf WHERE count_point_id IS NOT NULL
                               INTERSECT SELECT DISTINCT count_point_id FROM full_aadf) i) AS shared_ids,
        (SELECT count(DISTINCT count_point_id) FROM subset_aadf) AS sample_ids""",
    "export_reports": _content(),
}


def oracle() -> dict[str, str]:
    return {k: with_base(v, EXTRA.get(k)) for k, v in SQL.items()}

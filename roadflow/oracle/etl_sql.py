"""DuckDB oracle SQL for the ETL-stage queries."""

from __future__ import annotations

from .analyses_sql import EXTRA as ANALYSIS_CTES
from .analyses_sql import SQL as ANALYSIS_SQL
from .base import FACT_NAMES, IN_RANGE, MEASURES, parsed, with_base

REQUIRED = ["count_point_id", "year", "region_id", "local_authority_id", "direction_of_travel"] + MEASURES
DIRS = "('N','S','E','W','C')"
CATS = "('TM','PM','TA','PA','M','MB','MCU')"


def _validate() -> str:
    parts = []
    for c in MEASURES:
        parts.append(f"SELECT 'negative_{c}' AS issue, CAST(NULL AS VARCHAR) AS detail, count(*) AS n "
                     f"FROM raw_aadf WHERE {parsed(c)} < 0")
    for c in REQUIRED:
        parts.append(f"SELECT 'null_values' AS issue, '{c}' AS detail, count(*) AS n FROM raw_aadf WHERE {c} IS NULL")
    body = " UNION ALL ".join(parts)
    return f"""SELECT * FROM ({body}) t WHERE n > 0
        UNION ALL
        SELECT 'invalid_directions', direction_of_travel, count(*) FROM raw_aadf
        WHERE direction_of_travel IS NOT NULL AND direction_of_travel NOT IN {DIRS} GROUP BY direction_of_travel
        UNION ALL
        SELECT 'invalid_road_categories', road_category, count(*) FROM raw_aadf
        WHERE road_category IS NOT NULL AND road_category NOT IN {CATS} GROUP BY road_category"""


FACT_SELECT = ("SELECT DateKey, CountPointKey, LocalAuthorityKey, RegionKey, DirectionOfTravel, "
               + ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in FACT_NAMES)
               + " FROM FactTrafficFlowDirection")

PAGE_ROWS = f"""SELECT count_point_id, year, region_id, region_name, local_authority_id, road_name, road_category,
    direction_of_travel, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
    CAST(link_length_km AS DOUBLE) AS link_length_km, estimation_method, estimation_method_detailed,
    {", ".join(MEASURES)} FROM raw_aadf"""

ALL_KEYS = ("DateKey IS NOT NULL AND CountPointKey IS NOT NULL AND LocalAuthorityKey IS NOT NULL "
            "AND RegionKey IS NOT NULL")

SQL = {
    "etl_clean_aadf": f"""SELECT count_point_id, year, region_id, region_name, local_authority_id, road_name,
        road_category, direction_of_travel, CAST(latitude AS DOUBLE) AS latitude,
        CAST(longitude AS DOUBLE) AS longitude, CAST(link_length_km AS DOUBLE) AS link_length_km,
        estimation_method, estimation_method_detailed, {", ".join(MEASURES)} FROM clean_aadf""",
    "api_regions_records": """SELECT to_json(struct_pack(RegionKey := RegionKey, RegionID := RegionID,
        RegionName := RegionName, RegionONSCode := RegionONSCode)) AS record FROM DimRegion""",
    "etl_clean_summary": """SELECT i AS initial_rows, k AS kept_rows, i - k AS dropped_rows
        FROM (SELECT (SELECT count(*) FROM raw_aadf) AS i, (SELECT count(*) FROM clean_aadf) AS k) t""",
    "etl_validate_aadf": _validate(),
    "etl_dim_date": """SELECT d.*, coalesce(n, 0) AS FactRows FROM DimDate d LEFT JOIN (
        SELECT DateKey, count(*) AS n FROM FactTrafficFlowDirection GROUP BY DateKey) f ON d.DateKey = f.DateKey""",
    "etl_dim_keys_stable": """SELECT CountPointID, CAST(row_number() OVER (ORDER BY late, CountPointID) AS INTEGER)
        AS CountPointKey FROM (SELECT CountPointID, CountPointID % 3 = 0 AS late FROM DimCountPoint) p""",
    "etl_rejected_rows": f"""SELECT CASE WHEN {ALL_KEYS} THEN 'over_range' ELSE 'no_key' END AS status,
        k.year AS Year, k.direction_of_travel AS Direction, count(*) AS n_rows,
        max(CAST(CAST(k.all_motor_vehicles AS BIGINT) AS VARCHAR)) AS largest_text
        FROM keyed k WHERE NOT (({ALL_KEYS}) AND {IN_RANGE}) GROUP BY ALL""",
    "etl_dim_region": "SELECT * FROM DimRegion",
    "etl_dim_local_authority": "SELECT * FROM DimLocalAuthority",
    "etl_dim_count_point": """SELECT CountPointKey, CountPointID, RoadName, RoadCategory, RoadType,
        CAST(Latitude AS DOUBLE) AS Latitude, CAST(Longitude AS DOUBLE) AS Longitude,
        CAST(LinkLengthKm AS DOUBLE) AS LinkLengthKm FROM DimCountPoint""",
    "etl_fact_load": FACT_SELECT,
    "etl_fact_load_stats": f"""SELECT count_if({ALL_KEYS} AND {IN_RANGE}) AS loaded_rows,
        count_if(NOT ({ALL_KEYS})) AS dropped_rows, count_if({ALL_KEYS} AND NOT {IN_RANGE}) AS over_range_rows
        FROM keyed""",
    "etl_loaded_years": """SELECT DISTINCT d.Year FROM FactTrafficFlowDirection f
        JOIN DimDate d ON f.DateKey = d.DateKey""",
    "etl_years_to_load": """SELECT DISTINCT year AS Year FROM raw_aadf WHERE year IS NOT NULL
        EXCEPT SELECT DISTINCT d.Year FROM FactTrafficFlowDirection f JOIN DimDate d ON f.DateKey = d.DateKey""",
    "etl_incremental_load": FACT_SELECT,
    "etl_pages_flatten": PAGE_ROWS,
    "stream_pages_ingest": PAGE_ROWS,
    "etl_pages_completeness": """SELECT CAST(ceil(n / 1000.0) AS BIGINT) AS pages_received,
        CAST(ceil(n / 1000.0) AS BIGINT) AS distinct_pages, CAST(ceil(n / 1000.0) AS BIGINT) AS last_page,
        n AS rows_received, n AS total, true AS complete
        FROM (SELECT count(*) AS n FROM raw_aadf) t""",
}


_PAGES = "(SELECT unnest(range(1, CAST(ceil((SELECT count(*) FROM raw_aadf) / 1000.0) AS BIGINT) + 1)) AS page)"
_TYPES = [("count_point_id", "bigint"), ("year", "int"), ("region_id", "int"), ("region_name", "string"),
          ("local_authority_id", "int"), ("road_name", "string"), ("road_category", "string"),
          ("direction_of_travel", "string"), ("latitude", "decimal(10,8)"), ("longitude", "decimal(11,8)"),
          ("link_length_km", "decimal(8,3)"), ("estimation_method", "string"), ("estimation_method_detailed", "string"),
          *[(m, "string") for m in MEASURES]]
SQL |= {
    "etl_page_gaps": f"""SELECT * FROM (WITH held AS (
        SELECT page, CASE WHEN page % 10 IN (3, 4, 6) THEN 0 ELSE 1 END + CASE WHEN page % 5 = 0 THEN 1 ELSE 0 END AS copies
        FROM {_PAGES} p), wrong AS (
        SELECT *, page - row_number() OVER (PARTITION BY copies ORDER BY page) AS run FROM held WHERE copies <> 1)
        SELECT CASE WHEN copies = 0 THEN 'missing' ELSE 'repeated' END AS problem, min(page) AS first_page,
          max(page) AS last_page, count(*) AS pages, copies FROM wrong GROUP BY copies, run) t""",
    "stream_pages_fact": FACT_SELECT,
    "stream_page_receipts": f"""SELECT * FROM (WITH size AS (SELECT page, least(1000, (SELECT count(*) FROM raw_aadf) - (page - 1) * 1000)
        AS n FROM {_PAGES} p)
        SELECT * FROM (
        SELECT 'new' AS status, count(*) AS n_pages, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, 0 AS n_texts FROM size
        UNION ALL SELECT 'repeat', count(*), CAST(sum(n) AS BIGINT), 0 FROM size WHERE page % 6 = 3
        UNION ALL SELECT 'corrupt', count(*), 0, count(*) FROM size WHERE page % 5 = 0) t WHERE n_pages > 0) t""",
    "csv_append_once": ANALYSIS_SQL["seasonal_pattern"],
    "csv_pruned_regions": """SELECT region_id, region_name, count(DISTINCT count_point_id) AS points FROM count_points
        GROUP BY region_id, region_name""",
    "csv_dates": """SELECT CAST(month(count_date) AS INTEGER) AS month, count(*) AS n_rows, min(count_date) AS first_day,
        max(count_date) AS last_day FROM raw_counts GROUP BY ALL""",
    "csv_peek": " UNION ALL ".join(
        f"SELECT '{c}' AS column, '{t}' AS type, (SELECT least(5, count(*)) FROM raw_aadf) AS n_rows" for c, t in _TYPES),
    "fact_load_dates": """SELECT DateKey, count(*) AS n_rows, true AS loaded_before_now FROM FactTrafficFlowDirection
        GROUP BY DateKey""",
}
SQL["etl_clean_aadf_csv"] = SQL["etl_clean_aadf"]


def oracle() -> dict[str, str]:
    return {k: with_base(v, ANALYSIS_CTES.get("seasonal_pattern") if k == "csv_append_once" else None)
            for k, v in SQL.items()}

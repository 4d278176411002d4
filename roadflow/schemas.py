"""Column names, domains and Spark schemas of the traffic warehouse.

Everything in the "fixed values" blocks must stay equal to the source
system's definitions: they decide which rows survive cleaning and how
columns are named in every report.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the source system exactly)
# ---------------------------------------------------------------------------

# Raw AADF vehicle measures, in source order.
VEHICLE_COLS = [
    "pedal_cycles", "two_wheeled_motor_vehicles", "cars_and_taxis",
    "buses_and_coaches", "LGVs", "HGVs_2_rigid_axle", "HGVs_3_rigid_axle",
    "HGVs_4_or_more_rigid_axle", "HGVs_3_or_4_articulated_axle",
    "HGVs_5_articulated_axle", "HGVs_6_articulated_axle",
    "all_HGVs", "all_motor_vehicles",
]

# Columns a raw AADF extract must carry.
REQUIRED_COLS = [
    "count_point_id", "year", "region_id", "local_authority_id",
    "direction_of_travel",
] + VEHICLE_COLS

# Rows missing any of these are dropped by cleaning.
KEY_COLS = ["count_point_id", "year", "region_id", "local_authority_id"]

VALID_DIRECTIONS = ["N", "S", "E", "W", "C"]
VALID_ROAD_CATEGORIES = ["TM", "PM", "TA", "PA", "M", "MB", "MCU"]

# Accepted year range (inclusive) and the DimDate calendar.
YEAR_MIN = 2000
YEAR_MAX = 2025

# Raw measure name -> fact measure name.
FACT_MEASURES = {
    "pedal_cycles": "PedalCycles",
    "two_wheeled_motor_vehicles": "TwoWheeledMotorVehicles",
    "cars_and_taxis": "CarsAndTaxis",
    "buses_and_coaches": "BusesAndCoaches",
    "LGVs": "LGVs",
    "HGVs_2_rigid_axle": "HGVs2RigidAxle",
    "HGVs_3_rigid_axle": "HGVs3RigidAxle",
    "HGVs_4_or_more_rigid_axle": "HGVs4OrMoreRigidAxle",
    "HGVs_3_or_4_articulated_axle": "HGVs3Or4ArticulatedAxle",
    "HGVs_5_articulated_axle": "HGVs5ArticulatedAxle",
    "HGVs_6_articulated_axle": "HGVs6ArticulatedAxle",
    "all_HGVs": "AllHGVs",
    "all_motor_vehicles": "AllMotorVehicles",
}

# Road category code -> label.
ROAD_LABELS = {
    "TM": "Trunk Motorway",
    "PM": "Principal Motorway",
    "TA": "Trunk A-road",
    "PA": "Principal A-road",
    "M": "Minor",
    "MB": "B-road",
    "MCU": "C/Unclassified",
}

MOTORWAY_CATEGORIES = ["TM", "PM"]
A_ROAD_CATEGORIES = ["TA", "PA"]
MINOR_CATEGORIES = ["M", "MB", "MCU"]

# Month number -> short label.
MONTH_NAMES = {
    1: "Jan", 2: "Feb", 3: "Mar", 4: "Apr", 5: "May", 6: "Jun",
    7: "Jul", 8: "Aug", 9: "Sep", 10: "Oct", 11: "Nov", 12: "Dec",
}

# Raw hourly count measures.
RAW_COUNT_MEASURES = [
    "pedal_cycles", "two_wheeled_motor_vehicles", "cars_and_taxis",
    "buses_and_coaches", "LGVs", "all_HGVs", "all_motor_vehicles",
]

# Minimum row counts accepted by the data-quality check.
MIN_EXPECTED_ROWS = {
    "DimDate": 10,
    "DimRegion": 5,
    "DimLocalAuthority": 100,
    "DimCountPoint": 10000,
    "FactTrafficFlowDirection": 500000,
}

AM_PEAK_HOURS = [7, 8, 9]
PM_PEAK_HOURS = [16, 17, 18]

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

MEASURE_TYPE = T.DecimalType(18, 2)
# Measures of the raw analyses: as written, summed exactly.
ANALYSIS_TYPE = T.DecimalType(26, 4)
LATITUDE_TYPE = T.DecimalType(10, 8)
LONGITUDE_TYPE = T.DecimalType(11, 8)
LINK_KM_TYPE = T.DecimalType(8, 3)

# Raw AADF extract as read from CSV: measures stay strings so that the
# coercion rule of the cleaner (bad text -> 0) is ours, not the reader's.
RAW_AADF_SCHEMA = T.StructType(
    [
        T.StructField("count_point_id", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("region_id", T.IntegerType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("local_authority_id", T.IntegerType()),
        T.StructField("road_name", T.StringType()),
        T.StructField("road_category", T.StringType()),
        T.StructField("direction_of_travel", T.StringType()),
        T.StructField("latitude", LATITUDE_TYPE),
        T.StructField("longitude", LONGITUDE_TYPE),
        T.StructField("link_length_km", LINK_KM_TYPE),
        T.StructField("estimation_method", T.StringType()),
        T.StructField("estimation_method_detailed", T.StringType()),
    ]
    + [T.StructField(c, T.StringType()) for c in VEHICLE_COLS]
)

COUNT_POINTS_SCHEMA = T.StructType(
    [
        T.StructField("count_point_id", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("region_id", T.IntegerType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("region_ons_code", T.StringType()),
        T.StructField("local_authority_id", T.IntegerType()),
        T.StructField("local_authority_name", T.StringType()),
        T.StructField("local_authority_code", T.StringType()),
        T.StructField("road_name", T.StringType()),
        T.StructField("road_category", T.StringType()),
        T.StructField("road_type", T.StringType()),
        T.StructField("latitude", LATITUDE_TYPE),
        T.StructField("longitude", LONGITUDE_TYPE),
        T.StructField("link_length_km", LINK_KM_TYPE),
    ]
)

RAW_COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("count_date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("road_category", T.StringType()),
    ]
    + [T.StructField(c, T.LongType()) for c in RAW_COUNT_MEASURES]
)

CORRUPT = "_corrupt"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema with a column that keeps the text of a malformed record."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


# JSON page envelope of the paged extract.
PAGE_ROW_SCHEMA = RAW_AADF_SCHEMA

PAGE_ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("data", T.ArrayType(PAGE_ROW_SCHEMA)),
        T.StructField("total", T.LongType()),
        T.StructField("last_page", T.LongType()),
        T.StructField("per_page", T.IntegerType()),
        T.StructField("current_page", T.LongType()),
    ]
)

ROAD_SEGMENT_SCHEMA = T.StructType(
    [
        T.StructField("CP_Number", T.LongType()),
        T.StructField("RoadNumber", T.StringType()),
    ]
)

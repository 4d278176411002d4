"""SQL text with named parameters over one snapshot of the warehouse.

A :class:`Catalogue` holds the tables of a snapshot as temporary views in a
session of its own, so texts name the tables plainly, two snapshots never mix,
and nothing is left in the caller's session. Values are bound by Spark to
``:name`` markers; they are never pasted into the text, so a value is only data,
whatever quotes it holds. A marker without a value, and a value without a
marker, are errors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..functions.exprs import decimals_as_double
from ..sources.sinks import write_csv
from .warehouse import DIMS, FACT, Warehouse

MARKER = re.compile(r"(?<!:):([A-Za-z_]\w*)")
QUOTED = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", re.S)


def markers(text: str) -> set[str]:
    """Names of the markers in a text, outside quotes and comments."""
    return set(MARKER.findall(QUOTED.sub(" ", text)))


class Catalogue:
    def __init__(self, wh: Warehouse):
        session = wh.spark.newSession()
        for key, value in wh.spark.conf.getAll.items():  # the caller's settings hold here too
            if key.startswith("spark.sql.") and session.conf.isModifiable(key):
                session.conf.set(key, value)
        self.session = session
        self.version = wh.snapshot.version
        tables = Warehouse(session, wh.store.base, wh.snapshot)
        for name in [*DIMS, FACT]:
            tables.table(name).createOrReplaceTempView(name)

    def sql(self, text: str, args: dict | None = None) -> DataFrame:
        """The rows of a text with its markers bound."""
        given, wanted = set(args or {}), markers(text)
        if given != wanted:
            raise ValueError(f"unbound markers {sorted(wanted - given)}, values without a marker {sorted(given - wanted)}")
        return self.session.sql(text, args=args or {})

    def run(self, name: str, **args) -> DataFrame:
        """A named statement; values that are not given are its defaults."""
        statement = STATEMENTS[name]
        unknown = set(args) - set(statement.defaults)
        if unknown:
            raise ValueError(f"{name} takes {sorted(statement.defaults)}, not {sorted(unknown)}")
        values = statement.defaults | args
        for key, most in statement.most.items():
            if not 1 <= values[key] <= most:
                raise ValueError(f"{key} must be between 1 and {most}")
        return self.sql(statement.text, values)

    def export(self, text: str, args: dict | None, path: str) -> None:
        """The rows of a text as CSV with a header."""
        write_csv(decimals_as_double(self.sql(text, args)), path, single_file=True)


@dataclass(frozen=True)
class Statement:
    text: str
    defaults: dict = field(default_factory=dict)
    most: dict = field(default_factory=dict)  # upper bounds


_REGION_JOIN = "FactTrafficFlowDirection f JOIN DimRegion r ON r.RegionKey = f.RegionKey"
_POINT_JOIN = "FactTrafficFlowDirection f JOIN DimCountPoint p ON p.CountPointKey = f.CountPointKey"

#: The year stands in the fact as its partition column, so a bound year prunes the scan.
STATEMENTS = {
    "table_rows": Statement(" UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in [*DIMS, FACT])),
    "regions": Statement("SELECT RegionKey, RegionID, RegionName, RegionONSCode FROM DimRegion ORDER BY RegionName"),
    "yearly_totals": Statement(
        "SELECT DateKey AS Year, sum(AllMotorVehicles) AS TotalMotor, sum(AllHGVs) AS TotalHGV, "
        "sum(PedalCycles) AS TotalCycles FROM FactTrafficFlowDirection GROUP BY DateKey ORDER BY Year"),
    "traffic_by_region": Statement(
        f"SELECT r.RegionName, sum(f.AllMotorVehicles) AS TotalMotor, sum(f.AllHGVs) AS TotalHGV FROM {_REGION_JOIN} "
        "WHERE f.DateKey = :year "
        "GROUP BY r.RegionName ORDER BY TotalMotor DESC, RegionName", {"year": 2023}),
    "top_roads": Statement(
        f"SELECT p.RoadName, p.RoadCategory, sum(f.AllMotorVehicles) AS TotalTraffic FROM {_POINT_JOIN} "
        "WHERE f.DateKey = :year GROUP BY p.RoadName, p.RoadCategory "
        "ORDER BY TotalTraffic DESC, p.RoadName, p.RoadCategory LIMIT :limit",
        {"year": 2023, "limit": 10}, {"limit": 100}),
    "vehicle_mix_by_region": Statement(
        "SELECT r.RegionName, sum(f.CarsAndTaxis) AS Cars, sum(f.LGVs) AS LGVs, sum(f.AllHGVs) AS HGVs, "
        "sum(f.BusesAndCoaches) AS Buses, sum(f.TwoWheeledMotorVehicles) AS Motorcycles, "
        f"sum(f.PedalCycles) AS Cycles FROM {_REGION_JOIN} WHERE f.DateKey = :year "
        "GROUP BY r.RegionName ORDER BY r.RegionName", {"year": 2023}),
    "hotspots": Statement(
        "SELECT p.Latitude, p.Longitude, p.RoadName, r.RegionName, sum(f.AllMotorVehicles) AS TotalTraffic "
        f"FROM {_POINT_JOIN} JOIN DimRegion r ON r.RegionKey = f.RegionKey WHERE f.DateKey = :year "
        "GROUP BY p.Latitude, p.Longitude, p.RoadName, r.RegionName "
        "HAVING sum(f.AllMotorVehicles) > :min_traffic", {"year": 2023, "min_traffic": 50_000}),
    "roads_of_region": Statement(
        "SELECT p.RoadName, count(DISTINCT p.CountPointID) AS CountPoints, sum(f.AllMotorVehicles) AS TotalTraffic "
        f"FROM {_POINT_JOIN} JOIN DimRegion r ON r.RegionKey = f.RegionKey "
        "WHERE array_contains(:regions, r.RegionName) AND f.DateKey BETWEEN :first AND :last GROUP BY p.RoadName",
        {"regions": ["EUROPE"], "first": 2018, "last": 2023}),
}

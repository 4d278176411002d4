"""DuckDB oracle SQL for the warehouse reports (see plans/reports.py)."""

from __future__ import annotations

from .base import with_base


def S(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE)"


def A(x: str) -> str:
    return f"ROUND(AVG(CAST({x} AS DOUBLE)), 6)"


def P(a: str, b: str, d: int = 2) -> str:
    return f"ROUND(CAST({a} AS DOUBLE) * 100.0 / NULLIF(CAST({b} AS DOUBLE), 0), {d})"


def G(c: str, p: str, d: int = 2) -> str:
    return f"ROUND((CAST({c} AS DOUBLE) - CAST({p} AS DOUBLE)) * 100.0 / NULLIF(CAST({p} AS DOUBLE), 0), {d})"


F_D = """FROM FactTrafficFlowDirection f JOIN DimDate d ON f.DateKey = d.DateKey"""
F_R = F_D + " JOIN DimRegion r ON f.RegionKey = r.RegionKey"
F_CP = F_D + " JOIN DimCountPoint cp ON f.CountPointKey = cp.CountPointKey"
F_CPR = F_CP + " JOIN DimRegion r ON f.RegionKey = r.RegionKey"
F_LA = F_D + " JOIN DimLocalAuthority la ON f.LocalAuthorityKey = la.LocalAuthorityKey"


def yearly_sql(cols: dict, where: str = "") -> str:
    sel = ", ".join(f"{S('f.' + c)} AS {a}" for a, c in cols.items())
    return f"SELECT d.Year, {sel} {F_D} {where} GROUP BY d.Year"


MV = "f.AllMotorVehicles"

SQL = {
    "regional_traffic_summary": f"""SELECT r.RegionName, {S(MV)} AS TotalMotorVehicles,
        {S('f.AllHGVs')} AS TotalHGVs, {S(MV + ' + f.PedalCycles')} AS TotalAllVehicles
        {F_R} WHERE d.Year = 2023 GROUP BY r.RegionName""",
    "top_busiest_roads": f"""SELECT cp.RoadName, cp.RoadCategory, {S(MV)} AS TotalTraffic,
        {A(MV)} AS AvgDailyFlow {F_CP} WHERE d.Year >= 2020 GROUP BY cp.RoadName, cp.RoadCategory
        HAVING SUM({MV}) > 1000000
        ORDER BY TotalTraffic DESC, cp.RoadName NULLS FIRST, cp.RoadCategory NULLS FIRST LIMIT 10""",
    "yoy_growth_trend": f"""SELECT Year, TotalTraffic, LAG(TotalTraffic) OVER (ORDER BY Year) AS PrevYear,
        {G('TotalTraffic', 'LAG(TotalTraffic) OVER (ORDER BY Year)')} AS YoY_GrowthPct
        FROM ({yearly_sql({'TotalTraffic': 'AllMotorVehicles'})}) y""",
    "hgv_passenger_mix": f"""SELECT r.RegionName, {S('f.AllHGVs')} AS HGV_Total,
        {S('f.CarsAndTaxis + f.LGVs')} AS Passenger_Total,
        {P(S('f.AllHGVs'), 'SUM(' + MV + ')')} AS HGV_Pct {F_R} GROUP BY r.RegionName""",
    "local_authority_growth": f"""SELECT LocalAuthorityName, Traffic2023, Traffic2018,
        {G('Traffic2023', 'Traffic2018')} AS GrowthPct FROM (
          SELECT la.LocalAuthorityName,
            {S('CASE WHEN d.Year = 2023 THEN ' + MV + ' END')} AS Traffic2023,
            {S('CASE WHEN d.Year = 2018 THEN ' + MV + ' END')} AS Traffic2018
          {F_LA} WHERE d.Year IN (2018, 2023) GROUP BY la.LocalAuthorityName) x
        WHERE Traffic2018 IS NOT NULL""",
    "road_category_distribution": f"""SELECT cp.RoadCategory, COUNT(DISTINCT cp.CountPointID) AS NumCountPoints,
        {S(MV)} AS TotalTraffic, {A(MV)} AS AvgFlowPerPoint {F_CP} GROUP BY cp.RoadCategory""",
    "geospatial_hotspots": f"""SELECT CAST(cp.Latitude AS DOUBLE) AS Latitude, CAST(cp.Longitude AS DOUBLE) AS Longitude,
        cp.RoadName, r.RegionName, la.LocalAuthorityName, {S(MV)} AS TotalTraffic, {A(MV)} AS AvgDailyFlow
        {F_CPR} JOIN DimLocalAuthority la ON f.LocalAuthorityKey = la.LocalAuthorityKey
        WHERE d.Year = 2023
        GROUP BY cp.Latitude, cp.Longitude, cp.RoadName, r.RegionName, la.LocalAuthorityName
        HAVING SUM({MV}) > 50000""",
    "covid_impact": yearly_sql(
        {"Cars": "CarsAndTaxis", "Buses": "BusesAndCoaches", "LGVs": "LGVs", "HGVs": "AllHGVs",
         "Cycles": "PedalCycles", "AllMotor": "AllMotorVehicles"},
        "WHERE d.Year BETWEEN 2019 AND 2023"),
    "covid_recovery_by_region": f"""SELECT RegionName, Traffic_2019, Traffic_2020, Traffic_2023,
        {G('Traffic_2020', 'Traffic_2019')} AS Covid_Drop_Pct,
        {G('Traffic_2023', 'Traffic_2019')} AS Recovery_Pct FROM (
          SELECT r.RegionName,
            {S('CASE WHEN d.Year = 2019 THEN ' + MV + ' END')} AS Traffic_2019,
            {S('CASE WHEN d.Year = 2020 THEN ' + MV + ' END')} AS Traffic_2020,
            {S('CASE WHEN d.Year = 2023 THEN ' + MV + ' END')} AS Traffic_2023
          {F_R} WHERE d.Year IN (2019, 2020, 2023) GROUP BY r.RegionName) x""",
    "cycling_growth": f"""SELECT d.Year, {S('f.PedalCycles')} AS TotalCycles,
        COUNT(DISTINCT f.CountPointKey) AS CountPointsWithCycles,
        {A('CASE WHEN f.PedalCycles > 0 THEN f.PedalCycles END')} AS AvgCyclesWherePresent
        {F_D} GROUP BY d.Year""",
    "cycling_modal_shift": f"""SELECT Year, Cycles, Motor, {P('Cycles', 'Motor + Cycles', 4)} AS Cycle_Share_Pct,
        LAG(Cycles) OVER (ORDER BY Year) AS PrevCycles,
        {G('Cycles', 'LAG(Cycles) OVER (ORDER BY Year)')} AS Cycle_YoY_Pct
        FROM ({yearly_sql({'Cycles': 'PedalCycles', 'Motor': 'AllMotorVehicles'})}) y""",
    "directional_flow": f"""SELECT cp.RoadName, cp.RoadCategory, r.RegionName, f.DirectionOfTravel,
        {S(MV)} AS DirectionalFlow {F_CPR} WHERE d.Year = 2023 AND f.DirectionOfTravel <> 'C'
        GROUP BY cp.RoadName, cp.RoadCategory, r.RegionName, f.DirectionOfTravel
        HAVING SUM({MV}) > 10000""",
    "vehicle_km_by_region": f"""SELECT r.RegionName, d.Year,
        ROUND(CAST(SUM({MV} * cp.LinkLengthKm * 365) AS DOUBLE), 3) AS VehicleKm_Annual,
        ROUND(CAST(SUM(f.AllHGVs * cp.LinkLengthKm * 365) AS DOUBLE), 3) AS HGV_VehicleKm_Annual
        {F_CPR} WHERE d.Year >= 2019 GROUP BY r.RegionName, d.Year""",
    "road_category_performance": f"""SELECT cp.RoadCategory, d.Year, COUNT(DISTINCT cp.CountPointID) AS NumPoints,
        {S(MV)} AS TotalFlow, {A(MV)} AS AvgFlow, {S('f.AllHGVs')} AS TotalHGV,
        {P(S('f.AllHGVs'), S(MV))} AS HGV_Pct
        {F_CP} WHERE d.Year >= 2015 GROUP BY cp.RoadCategory, d.Year""",
    "top_growing_roads": f"""SELECT RoadName, RoadCategory, Traffic_2019, Traffic_2023,
        {G('Traffic_2023', 'Traffic_2019')} AS Change_Pct FROM (
          SELECT cp.RoadName, cp.RoadCategory,
            {S('CASE WHEN d.Year = 2019 THEN ' + MV + ' END')} AS Traffic_2019,
            {S('CASE WHEN d.Year = 2023 THEN ' + MV + ' END')} AS Traffic_2023
          {F_CP} WHERE d.Year IN (2019, 2023) GROUP BY cp.RoadName, cp.RoadCategory) x
        WHERE Traffic_2019 > 100000
        ORDER BY Change_Pct DESC NULLS LAST, RoadName NULLS FIRST, RoadCategory NULLS FIRST LIMIT 20""",
    "lgv_growth_trend": f"""SELECT Year, TotalLGVs, TotalMotor, {P('TotalLGVs', 'TotalMotor')} AS LGV_Share_Pct
        FROM ({yearly_sql({'TotalLGVs': 'LGVs', 'TotalMotor': 'AllMotorVehicles'})}) y""",
    "congestion_proxy": f"""SELECT RoadName, RoadCategory, RegionName, CAST(LinkLengthKm AS DOUBLE) AS LinkLengthKm,
        TotalFlow, ROUND(TotalFlow / NULLIF(CAST(LinkLengthKm AS DOUBLE), 0), 0) AS FlowPerKm FROM (
          SELECT cp.RoadName, cp.RoadCategory, r.RegionName, cp.LinkLengthKm, {S(MV)} AS TotalFlow
          {F_CPR} WHERE d.Year = 2023 AND cp.LinkLengthKm > 0
          GROUP BY cp.RoadName, cp.RoadCategory, r.RegionName, cp.LinkLengthKm
          HAVING SUM({MV}) > 10000) x
        ORDER BY FlowPerKm DESC NULLS LAST, RoadName NULLS FIRST, RoadCategory NULLS FIRST,
                 RegionName NULLS FIRST, x.LinkLengthKm NULLS FIRST LIMIT 20""",
    "motorway_vs_aroad": f"""SELECT Year,
        coalesce(sum(flow) FILTER (kind = 'M'), 0) AS Motorway_Flow, coalesce(sum(flow) FILTER (kind = 'A'), 0) AS ARoad_Flow,
        coalesce(sum(flow) FILTER (kind = 'minor'), 0) AS Minor_Flow,
        coalesce(sum(points) FILTER (kind = 'M'), 0)::BIGINT AS Motorway_Points,
        coalesce(sum(points) FILTER (kind = 'A'), 0)::BIGINT AS ARoad_Points
        FROM (SELECT d.Year, CASE right(cp.RoadCategory, 1) WHEN 'M' THEN 'M' WHEN 'A' THEN 'A' ELSE 'minor' END AS kind,
                CAST(sum({MV}) AS DOUBLE) AS flow, count(DISTINCT cp.CountPointID) AS points
              {F_CP} WHERE cp.RoadCategory IN ('TM', 'PM', 'TA', 'PA', 'M', 'MB', 'MCU')
              GROUP BY d.Year, kind) g
        GROUP BY Year""",
    "hgv_axle_breakdown": f"""SELECT *, {P('Artic5 + Artic6', 'TotalHGV')} AS LargeArtic_Pct FROM (
        {yearly_sql({'Rigid2': 'HGVs2RigidAxle', 'Rigid3': 'HGVs3RigidAxle', 'Rigid4Plus': 'HGVs4OrMoreRigidAxle',
                     'Artic3_4': 'HGVs3Or4ArticulatedAxle', 'Artic5': 'HGVs5ArticulatedAxle',
                     'Artic6': 'HGVs6ArticulatedAxle', 'TotalHGV': 'AllHGVs'})}) y""",
    "bus_coach_decline": f"""SELECT Year, TotalBuses, TotalMotor, {P('TotalBuses', 'TotalMotor', 3)} AS Bus_SharePct
        FROM ({yearly_sql({'TotalBuses': 'BusesAndCoaches', 'TotalMotor': 'AllMotorVehicles'})}) y""",
    "motorcycle_trends": f"""SELECT Year, TotalMotorcycles, TotalMotor,
        {P('TotalMotorcycles', 'TotalMotor', 3)} AS Motorcycle_SharePct
        FROM ({yearly_sql({'TotalMotorcycles': 'TwoWheeledMotorVehicles', 'TotalMotor': 'AllMotorVehicles'})}) y""",
    "coverage_by_region_category": f"""SELECT r.RegionName, cp.RoadCategory,
        COUNT(DISTINCT cp.CountPointID) AS NumPoints, CAST(SUM(cp.LinkLengthKm) AS DOUBLE) AS TotalLinkKm,
        ROUND(CAST(COUNT(DISTINCT cp.CountPointID) AS DOUBLE) / NULLIF(CAST(SUM(cp.LinkLengthKm) AS DOUBLE), 0) * 100.0, 2)
          AS PointsPer100km
        {F_CPR} WHERE d.Year = 2023 GROUP BY r.RegionName, cp.RoadCategory""",
    "directional_imbalance_sql": f"""SELECT RoadName, RoadCategory, RegionName, list_max(flows) AS MaxDirFlow,
        list_min(flows) AS MinDirFlow, round(list_max(flows) / nullif(list_min(flows), 0), 2) AS ImbalanceRatio
        FROM (SELECT RoadName, RoadCategory, RegionName, list(flow) AS flows FROM (
                SELECT DISTINCT cp.RoadName, cp.RoadCategory, r.RegionName, f.DirectionOfTravel,
                  CAST(sum({MV}) OVER (PARTITION BY cp.RoadName, cp.RoadCategory, r.RegionName, f.DirectionOfTravel)
                    AS DOUBLE) AS flow
                {F_CPR} WHERE d.Year = 2023 AND f.DirectionOfTravel IN ('N', 'S', 'E', 'W')) one
              GROUP BY ALL) g
        WHERE len(flows) > 1 AND list_min(flows) > 1000
        ORDER BY ImbalanceRatio DESC NULLS LAST, RoadName NULLS FIRST, RoadCategory NULLS FIRST,
                 RegionName NULLS FIRST LIMIT 30""",
    "cycling_share_export": f"""SELECT Year, TotalCycles, TotalMotor,
        {P('TotalCycles', 'TotalMotor + TotalCycles', 4)} AS CycleSharePct
        FROM ({yearly_sql({'TotalCycles': 'PedalCycles', 'TotalMotor': 'AllMotorVehicles'})}) y""",
    # ---- serving queries
    "table_row_counts": """SELECT 'DimDate' AS name, COUNT(*) AS rows FROM DimDate
        UNION ALL SELECT 'DimRegion', COUNT(*) FROM DimRegion
        UNION ALL SELECT 'DimLocalAuthority', COUNT(*) FROM DimLocalAuthority
        UNION ALL SELECT 'DimCountPoint', COUNT(*) FROM DimCountPoint
        UNION ALL SELECT 'FactTrafficFlowDirection', COUNT(*) FROM FactTrafficFlowDirection""",
    "regions_list": "SELECT RegionKey, RegionID, RegionName, RegionONSCode FROM DimRegion",
    "yearly_totals_api": yearly_sql(
        {"TotalMotor": "AllMotorVehicles", "TotalHGV": "AllHGVs", "TotalCycles": "PedalCycles"}),
    "traffic_by_region": f"""SELECT r.RegionName, {S(MV)} AS TotalMotor, {S('f.AllHGVs')} AS TotalHGV
        {F_R} WHERE d.Year = 2023 GROUP BY r.RegionName""",
    "top_roads": f"""SELECT cp.RoadName, cp.RoadCategory, {S(MV)} AS TotalTraffic {F_CP} WHERE d.Year = 2023
        GROUP BY cp.RoadName, cp.RoadCategory
        ORDER BY TotalTraffic DESC, cp.RoadName NULLS FIRST, cp.RoadCategory NULLS FIRST LIMIT 10""",
    "vehicle_mix_by_region": f"""SELECT r.RegionName, {S('f.CarsAndTaxis')} AS Cars, {S('f.LGVs')} AS LGVs,
        {S('f.AllHGVs')} AS HGVs, {S('f.BusesAndCoaches')} AS Buses, {S('f.PedalCycles')} AS Cycles,
        {S('f.TwoWheeledMotorVehicles')} AS Motorcycles {F_R} WHERE d.Year = 2023 GROUP BY r.RegionName""",
    "hotspots": f"""SELECT CAST(cp.Latitude AS DOUBLE) AS Latitude, CAST(cp.Longitude AS DOUBLE) AS Longitude,
        cp.RoadName, r.RegionName, {S(MV)} AS TotalTraffic {F_CPR} WHERE d.Year = 2023
        GROUP BY cp.Latitude, cp.Longitude, cp.RoadName, r.RegionName HAVING SUM({MV}) > 50000""",
    "available_years": f"SELECT DISTINCT d.Year {F_D}",
    "yearly_overview": f"""SELECT d.Year, {S(MV)} AS TotalMotor, {S('f.AllHGVs')} AS TotalHGV,
        {S('f.PedalCycles')} AS TotalCycles, COUNT(DISTINCT f.CountPointKey) AS CountPoints {F_D} GROUP BY d.Year""",
    "regional_overview": f"""SELECT r.RegionName, {S(MV)} AS TotalMotor, {S('f.AllHGVs')} AS TotalHGV,
        COUNT(DISTINCT f.CountPointKey) AS CountPoints {F_R} WHERE d.Year = 2023 GROUP BY r.RegionName""",
    "national_vehicle_mix": f"""UNPIVOT (SELECT {S('f.CarsAndTaxis')} AS Cars, {S('f.LGVs')} AS LGVs,
          {S('f.AllHGVs')} AS HGVs, {S('f.BusesAndCoaches')} AS Buses, {S('f.PedalCycles')} AS Cycles,
          {S('f.TwoWheeledMotorVehicles')} AS Motorcycles {F_D} WHERE d.Year = 2023)
        ON Cars, LGVs, HGVs, Buses, Cycles, Motorcycles INTO NAME Vehicle VALUE Total""",
    "vehicle_mix_long": f"""UNPIVOT (SELECT r.RegionName, {S('f.CarsAndTaxis')} AS Cars, {S('f.LGVs')} AS LGVs,
          {S('f.AllHGVs')} AS HGVs, {S('f.BusesAndCoaches')} AS Buses {F_R} WHERE d.Year = 2023
          GROUP BY r.RegionName)
        ON Cars, LGVs, HGVs, Buses INTO NAME variable VALUE value""",
    "vehicle_trend_long": f"""UNPIVOT ({yearly_sql({'Cars': 'CarsAndTaxis', 'LGVs': 'LGVs', 'HGVs': 'AllHGVs',
                                                    'Buses': 'BusesAndCoaches', 'Cycles': 'PedalCycles'},
                                                   'WHERE d.Year BETWEEN 2017 AND 2023')})
        ON Cars, LGVs, HGVs, Buses, Cycles INTO NAME Vehicle VALUE AADF""",
    "cycling_trend": f"""SELECT Year, TotalCycles, {P('TotalCycles', 'm + TotalCycles', 4)} AS CycleShare
        FROM ({yearly_sql({'TotalCycles': 'PedalCycles', 'm': 'AllMotorVehicles'})}) y""",
    "lgv_share_trend": f"""SELECT Year, TotalLGVs, {P('TotalLGVs', 'm', 2)} AS LGV_Share
        FROM ({yearly_sql({'TotalLGVs': 'LGVs', 'm': 'AllMotorVehicles'})}) y""",
    "bus_share_trend": f"""SELECT Year, TotalBuses, {P('TotalBuses', 'm', 3)} AS BusShare
        FROM ({yearly_sql({'TotalBuses': 'BusesAndCoaches', 'm': 'AllMotorVehicles'})}) y""",
    "measure_total_motor": f"SELECT d.Year, {S(MV)} AS TotalMotorVehicles {F_D} GROUP BY d.Year",
    "measure_hgv_pct": f"""SELECT r.RegionName,
        ROUND(coalesce(CAST(SUM(f.AllHGVs) AS DOUBLE) / NULLIF(CAST(SUM({MV}) AS DOUBLE), 0), 0.0), 6)
          AS HGVPercentage {F_R} GROUP BY r.RegionName""",
    "measure_yoy_calendar": f"""SELECT y.Year, y.CurrentYear, p.CurrentYear AS PrevYear,
        ROUND(coalesce((y.CurrentYear - p.CurrentYear) / NULLIF(p.CurrentYear, 0), 0.0), 6) AS YoYGrowth
        FROM ({yearly_sql({'CurrentYear': 'AllMotorVehicles'})}) y
        LEFT JOIN ({yearly_sql({'CurrentYear': 'AllMotorVehicles'})}) p ON p.Year + 1 = y.Year""",
}


# The same reports over bucketed copies.
SQL |= {f"bucketed_{name}": SQL[name] for name in ("top_busiest_roads", "road_category_distribution")}
# The same reports asked as SQL text with bound values.
SQL |= {f"sql_{name}": SQL[of] for name, of in {
    "table_rows": "table_row_counts", "regions": "regions_list", "yearly_totals": "yearly_totals_api",
    "traffic_by_region": "traffic_by_region", "vehicle_mix_by_region": "vehicle_mix_by_region", "hotspots": "hotspots",
}.items()}
SQL |= {
    "sql_top_roads": SQL["top_roads"].replace("2023", "2022").replace("LIMIT 10", "LIMIT 25"),
    "sql_roads_of_region": f"""SELECT cp.RoadName, COUNT(DISTINCT cp.CountPointID) AS CountPoints,
        {S(MV)} AS TotalTraffic {F_CPR} WHERE r.RegionName = 'EUROPE' AND d.Year BETWEEN 2019 AND 2022
        GROUP BY cp.RoadName""",
    "sql_quoted_value": f"""SELECT r.RegionName, false AS same, 'ASIA'' OR ''1''=''1" --' AS given,
        {S(MV)} AS total {F_R} WHERE d.Year >= 2019 GROUP BY r.RegionName""",
}


def oracle() -> dict[str, str]:
    return {k: with_base(v) for k, v in SQL.items()}

"""Analytical reports over the star schema (SQL family).

Every report is a function of a :class:`~roadflow.plans.warehouse.Warehouse`
plus parameters (years, thresholds, N) whose defaults are the published
report settings.  Conventions shared by all of them:

* the year is the fact's partition column (``DateKey = Year``), so year
  predicates prune partitions instead of joining DimDate;
* eager aggregation: fact rows are first combined per surrogate key (an
  integer-keyed partial aggregate, see :func:`partials`), then dimension
  attributes are joined onto one row per key (size-checked broadcasts) and
  the final grouping runs on that small input.  Where the final groups are
  far fewer than the count points and the point dimension can be broadcast,
  the join comes first and the final aggregate combines in the map task;
* sums are exact decimal sums exposed as double, means are over fact rows
  (rounded to 6 places), ratios are NULL on a zero denominator;
* top-N lists break ties on their key columns, ascending.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import avg_d, divide_or_zero, growth_pct, pct, safe_div, sum_d, year_filter
from ..schemas import A_ROAD_CATEGORIES, MINOR_CATEGORIES, MOTORWAY_CATEGORIES
from .warehouse import FACT, Warehouse

MV = "AllMotorVehicles"


# --------------------------------------------------------------------------
# Building blocks
# --------------------------------------------------------------------------

def fact(wh: Warehouse, *cols: str, **years) -> DataFrame:
    """Fact rows (only ``cols``) with an optional year predicate on the
    partition column; ``Year`` is exposed as a column."""
    f = wh.fact
    if years:
        f = f.where(year_filter(F.col("DateKey"), **years))
    return f.select(F.col("DateKey").alias("Year"), *cols)


def partials(wh: Warehouse, keys: list[str], sums: dict, count: bool = False, coarse: bool = False,
             **years) -> DataFrame:
    """Eager aggregation: fact rows combined per surrogate key (and year)
    *before* any dimension join.  The hot path is an integer-keyed partial
    aggregate; dimension attributes are joined onto one row per key and
    the final grouping runs on that much smaller input.  ``sums`` maps
    alias -> fact column / expression; ``count`` adds the row count ``_n``
    (for means over fact rows).

    ``coarse`` says that the final groups are far fewer than the count
    points.  If the point dimension is small enough to broadcast, the rows
    are then passed on as they are: the join runs in the scan's task and the
    final aggregate's map side combines them, so only final groups are
    shuffled instead of one row per point."""
    f = wh.fact
    if years:
        f = f.where(year_filter(F.col("DateKey"), **years))
    f = f.withColumnRenamed("DateKey", "Year")
    aggs = [F.sum(F.col(e) if isinstance(e, str) else e).alias(a) for a, e in sums.items()]
    if coarse and wh.broadcastable("DimCountPoint"):
        rows = [(F.col(e) if isinstance(e, str) else e).alias(a) for a, e in sums.items()]
        return f.select(*keys, *rows, *([F.lit(1).alias("_n")] if count else []))
    if count:
        aggs.append(F.count(F.lit(1)).alias("_n"))
    return f.groupBy(*keys).agg(*aggs)


def mean_of(total: str = "s", rows: str = "_n", digits: int = 6) -> F.Column:
    """Mean over fact rows from partial sums and counts."""
    return F.round(F.try_divide(F.sum(total).cast("double"), F.sum(rows).cast("double")), digits)


def with_region(f: DataFrame, wh: Warehouse, *cols: str) -> DataFrame:
    d = wh.dim("DimRegion").select("RegionKey", *(cols or ("RegionName",)))
    return f.join(d, "RegionKey")


def with_point(f: DataFrame, wh: Warehouse, *cols: str) -> DataFrame:
    d = wh.dim("DimCountPoint").select("CountPointKey", *cols)
    return f.join(d, "CountPointKey")


def with_la(f: DataFrame, wh: Warehouse, *cols: str) -> DataFrame:
    d = wh.dim("DimLocalAuthority").select("LocalAuthorityKey", *(cols or ("LocalAuthorityName",)))
    return f.join(d, "LocalAuthorityKey")


def top_n(df: DataFrame, n: int, order: list) -> DataFrame:
    """Global top-N (per-partition top-N, then a single merge of N rows)."""
    return df.orderBy(*order).limit(n)


def prev_row(df: DataFrame, col: str, order: str = "Year") -> F.Column:
    """Previous row's value; only applied to year-grain results (at most
    one row per calendar year), so the unpartitioned window is tiny."""
    return F.lag(col).over(Window.orderBy(order))


def yearly(wh: Warehouse, aggs: dict, **years) -> DataFrame:
    """Fact summed per year: {alias: fact column}."""
    cols = sorted(set(aggs.values()))
    f = fact(wh, *cols, **years)
    return f.groupBy("Year").agg(*[sum_d(c).alias(a) for a, c in aggs.items()])


# --------------------------------------------------------------------------
# Core business reports
# --------------------------------------------------------------------------

def regional_traffic_summary(wh: Warehouse, year: int = 2023) -> DataFrame:
    p = partials(wh, ["RegionKey"], {"mv": MV, "hgv": "AllHGVs", "allv": F.col(MV) + F.col("PedalCycles")},
                 year=year)
    return (
        with_region(p, wh).groupBy("RegionName")
        .agg(
            sum_d("mv").alias("TotalMotorVehicles"),
            sum_d("hgv").alias("TotalHGVs"),
            sum_d("allv").alias("TotalAllVehicles"),
        )
        .orderBy(F.desc("TotalAllVehicles"), "RegionName")
    )


def top_busiest_roads(wh: Warehouse, since: int = 2020, min_total: float = 1_000_000, n: int = 10) -> DataFrame:
    p = with_point(partials(wh, ["CountPointKey"], {"s": MV}, count=True, coarse=True, since=since), wh,
                   "RoadName", "RoadCategory")
    g = p.groupBy("RoadName", "RoadCategory").agg(
        sum_d("s").alias("TotalTraffic"), mean_of().alias("AvgDailyFlow")
    ).where(F.col("TotalTraffic") > min_total)
    return top_n(g, n, [F.desc("TotalTraffic"), F.asc_nulls_first("RoadName"), F.asc_nulls_first("RoadCategory")])


def yoy_growth_trend(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {"TotalTraffic": MV})
    prev = prev_row(y, "TotalTraffic")
    return (
        y.withColumn("PrevYear", prev)
        .withColumn("YoY_GrowthPct", growth_pct("TotalTraffic", "PrevYear"))
        .orderBy("Year")
    )


def hgv_passenger_mix(wh: Warehouse) -> DataFrame:
    p = partials(wh, ["RegionKey"], {"hgv": "AllHGVs", "pas": F.col("CarsAndTaxis") + F.col("LGVs"), "mv": MV})
    g = with_region(p, wh).groupBy("RegionName").agg(
        sum_d("hgv").alias("HGV_Total"),
        sum_d("pas").alias("Passenger_Total"),
        F.sum("mv").alias("_mv"),
    )
    return g.select(
        "RegionName", "HGV_Total", "Passenger_Total", pct("HGV_Total", "_mv").alias("HGV_Pct")
    ).orderBy(F.desc_nulls_last("HGV_Pct"), "RegionName")


def local_authority_growth(wh: Warehouse, base_year: int = 2018, target_year: int = 2023) -> DataFrame:
    """Traffic per local authority in two years and the growth between them;
    authorities without traffic in the base year are left out."""
    p = with_la(partials(wh, ["Year", "LocalAuthorityKey"], {"s": MV}, years=[base_year, target_year]), wh)
    t, b = f"Traffic{target_year}", f"Traffic{base_year}"
    g = p.groupBy("LocalAuthorityName").agg(
        sum_d(F.when(F.col("Year") == target_year, F.col("s"))).alias(t),
        sum_d(F.when(F.col("Year") == base_year, F.col("s"))).alias(b),
    )
    return (
        g.where(F.col(b).isNotNull())
        .withColumn("GrowthPct", growth_pct(t, b))
        .orderBy(F.desc_nulls_last("GrowthPct"), "LocalAuthorityName")
    )


def road_category_distribution(wh: Warehouse) -> DataFrame:
    p = with_point(partials(wh, ["CountPointKey"], {"s": MV}, count=True), wh, "RoadCategory", "CountPointID")
    return p.groupBy("RoadCategory").agg(
        F.count_distinct("CountPointID").alias("NumCountPoints"),
        sum_d("s").alias("TotalTraffic"),
        mean_of().alias("AvgFlowPerPoint"),
    ).orderBy(F.desc("TotalTraffic"), "RoadCategory")


def geospatial_hotspots(wh: Warehouse, year: int = 2023, min_total: float = 50_000) -> DataFrame:
    p = partials(wh, ["CountPointKey", "RegionKey", "LocalAuthorityKey"], {"s": MV}, count=True, year=year)
    p = with_la(with_region(with_point(p, wh, "Latitude", "Longitude", "RoadName"), wh), wh)
    keys = ["Latitude", "Longitude", "RoadName", "RegionName", "LocalAuthorityName"]
    g = p.groupBy(*keys).agg(sum_d("s").alias("TotalTraffic"), mean_of().alias("AvgDailyFlow"))
    return (
        g.where(F.col("TotalTraffic") > min_total)
        .withColumn("Latitude", F.col("Latitude").cast("double"))
        .withColumn("Longitude", F.col("Longitude").cast("double"))
        .orderBy(F.desc("TotalTraffic"), *keys)
    )


# --------------------------------------------------------------------------
# Advanced reports
# --------------------------------------------------------------------------

def covid_impact(wh: Warehouse, start: int = 2019, end: int = 2023) -> DataFrame:
    return yearly(
        wh,
        {"Cars": "CarsAndTaxis", "Buses": "BusesAndCoaches", "LGVs": "LGVs",
         "HGVs": "AllHGVs", "Cycles": "PedalCycles", "AllMotor": MV},
        between=(start, end),
    ).orderBy("Year")


def covid_recovery_by_region(wh: Warehouse, base: int = 2019, covid: int = 2020, recovery: int = 2023) -> DataFrame:
    p = with_region(partials(wh, ["Year", "RegionKey"], {"s": MV}, years=[base, covid, recovery]), wh)
    cols = {y: f"Traffic_{y}" for y in (base, covid, recovery)}
    g = p.groupBy("RegionName").agg(
        *[sum_d(F.when(F.col("Year") == y, F.col("s"))).alias(a) for y, a in cols.items()]
    )
    return (
        g.withColumn("Covid_Drop_Pct", growth_pct(cols[covid], cols[base]))
        .withColumn("Recovery_Pct", growth_pct(cols[recovery], cols[base]))
        .orderBy(F.asc_nulls_first("Covid_Drop_Pct"), "RegionName")
    )


def cycling_growth(wh: Warehouse) -> DataFrame:
    f = fact(wh, "CountPointKey", "PedalCycles")
    return f.groupBy("Year").agg(
        sum_d("PedalCycles").alias("TotalCycles"),
        F.count_distinct("CountPointKey").alias("CountPointsWithCycles"),
        avg_d(F.when(F.col("PedalCycles") > 0, F.col("PedalCycles"))).alias("AvgCyclesWherePresent"),
    ).orderBy("Year")


def cycling_modal_shift(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {"Cycles": "PedalCycles", "Motor": MV})
    return (
        y.withColumn("Cycle_Share_Pct", pct("Cycles", F.col("Motor") + F.col("Cycles"), 4))
        .withColumn("PrevCycles", prev_row(y, "Cycles"))
        .withColumn("Cycle_YoY_Pct", growth_pct("Cycles", "PrevCycles"))
        .orderBy("Year")
    )


def directional_flow(wh: Warehouse, year: int = 2023, min_flow: float = 10_000) -> DataFrame:
    p = partials(wh.where_fact(F.col("DirectionOfTravel") != "C"),
                 ["CountPointKey", "RegionKey", "DirectionOfTravel"], {"s": MV}, coarse=True, year=year)
    p = with_region(with_point(p, wh, "RoadName", "RoadCategory"), wh)
    keys = ["RoadName", "RoadCategory", "RegionName", "DirectionOfTravel"]
    return (
        p.groupBy(*keys).agg(sum_d("s").alias("DirectionalFlow"))
        .where(F.col("DirectionalFlow") > min_flow)
        .orderBy("RoadName", "DirectionOfTravel", "RoadCategory", "RegionName")
    )


def vehicle_km_by_region(wh: Warehouse, since: int = 2019) -> DataFrame:
    """Annual vehicle-km: flow x link length x 365, summed exactly."""
    # link length is constant per point, so sum(flow * km) = km * sum(flow): exact in decimals
    p = partials(wh, ["Year", "CountPointKey", "RegionKey"], {"mv": MV, "hgv": "AllHGVs"}, coarse=True, since=since)
    p = with_region(with_point(p, wh, "LinkLengthKm"), wh)
    km = F.col("LinkLengthKm")
    return p.groupBy("RegionName", "Year").agg(
        F.round(F.sum(F.col("mv") * km * F.lit(365)).cast("double"), 3).alias("VehicleKm_Annual"),
        F.round(F.sum(F.col("hgv") * km * F.lit(365)).cast("double"), 3).alias("HGV_VehicleKm_Annual"),
    ).orderBy("RegionName", "Year")


def road_category_performance(wh: Warehouse, since: int = 2015) -> DataFrame:
    p = partials(wh, ["Year", "CountPointKey"], {"s": MV, "hgv": "AllHGVs"}, count=True, since=since)
    p = with_point(p, wh, "RoadCategory", "CountPointID")
    g = p.groupBy("RoadCategory", "Year").agg(
        F.count_distinct("CountPointID").alias("NumPoints"),
        sum_d("s").alias("TotalFlow"),
        mean_of().alias("AvgFlow"),
        sum_d("hgv").alias("TotalHGV"),
    )
    return g.withColumn("HGV_Pct", pct("TotalHGV", "TotalFlow")).orderBy("RoadCategory", "Year")


def top_growing_roads(wh: Warehouse, base: int = 2019, target: int = 2023,
                      min_base: float = 100_000, n: int = 20) -> DataFrame:
    p = with_point(partials(wh, ["Year", "CountPointKey"], {"s": MV}, coarse=True, years=[base, target]), wh,
                   "RoadName", "RoadCategory")
    b, t = f"Traffic_{base}", f"Traffic_{target}"
    g = p.groupBy("RoadName", "RoadCategory").agg(
        sum_d(F.when(F.col("Year") == base, F.col("s"))).alias(b),
        sum_d(F.when(F.col("Year") == target, F.col("s"))).alias(t),
    ).where(F.col(b) > min_base)
    g = g.withColumn("Change_Pct", growth_pct(t, b))
    return top_n(g, n, [F.desc_nulls_last("Change_Pct"), F.asc_nulls_first("RoadName"),
                        F.asc_nulls_first("RoadCategory")])


def lgv_growth_trend(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {"TotalLGVs": "LGVs", "TotalMotor": MV})
    return y.withColumn("LGV_Share_Pct", pct("TotalLGVs", "TotalMotor")).orderBy("Year")


def congestion_proxy(wh: Warehouse, year: int = 2023, min_flow: float = 10_000, n: int = 20) -> DataFrame:
    p = partials(wh, ["CountPointKey", "RegionKey"], {"s": MV}, coarse=True, year=year)
    p = with_region(with_point(p, wh, "RoadName", "RoadCategory", "LinkLengthKm"), wh).where(
        F.col("LinkLengthKm") > 0
    )
    keys = ["RoadName", "RoadCategory", "RegionName", "LinkLengthKm"]
    g = p.groupBy(*keys).agg(sum_d("s").alias("TotalFlow")).where(F.col("TotalFlow") > min_flow)
    g = g.withColumn("FlowPerKm", F.round(safe_div("TotalFlow", "LinkLengthKm"), 0)).withColumn(
        "LinkLengthKm", F.col("LinkLengthKm").cast("double")
    )
    return top_n(g, n, [F.desc_nulls_last("FlowPerKm")] + [F.asc_nulls_first(k) for k in keys])


def motorway_vs_aroad(wh: Warehouse) -> DataFrame:
    f = with_point(partials(wh, ["Year", "CountPointKey"], {"s": MV}), wh, "RoadCategory", "CountPointID")
    cat = F.col("RoadCategory")

    def flow(cats):
        return sum_d(F.when(cat.isin(cats), F.col("s")).otherwise(F.lit(0)))

    def points(cats):
        return F.count_distinct(F.when(cat.isin(cats), F.col("CountPointID")))

    return f.groupBy("Year").agg(
        flow(MOTORWAY_CATEGORIES).alias("Motorway_Flow"),
        flow(A_ROAD_CATEGORIES).alias("ARoad_Flow"),
        flow(MINOR_CATEGORIES).alias("Minor_Flow"),
        points(MOTORWAY_CATEGORIES).alias("Motorway_Points"),
        points(A_ROAD_CATEGORIES).alias("ARoad_Points"),
    ).orderBy("Year")


AXLES = {
    "Rigid2": "HGVs2RigidAxle", "Rigid3": "HGVs3RigidAxle", "Rigid4Plus": "HGVs4OrMoreRigidAxle",
    "Artic3_4": "HGVs3Or4ArticulatedAxle", "Artic5": "HGVs5ArticulatedAxle", "Artic6": "HGVs6ArticulatedAxle",
}


def hgv_axle_breakdown(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {**AXLES, "TotalHGV": "AllHGVs"})
    return y.withColumn(
        "LargeArtic_Pct", pct(F.col("Artic5") + F.col("Artic6"), "TotalHGV")
    ).orderBy("Year")


def bus_coach_decline(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {"TotalBuses": "BusesAndCoaches", "TotalMotor": MV})
    return y.withColumn("Bus_SharePct", pct("TotalBuses", "TotalMotor", 3)).orderBy("Year")


def motorcycle_trends(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {"TotalMotorcycles": "TwoWheeledMotorVehicles", "TotalMotor": MV})
    return y.withColumn("Motorcycle_SharePct", pct("TotalMotorcycles", "TotalMotor", 3)).orderBy("Year")


def coverage_by_region_category(wh: Warehouse, year: int = 2023) -> DataFrame:
    """Points and link length per region and category.  Link length is summed
    over fact rows (once per direction row), as the published report does."""
    p = partials(wh, ["CountPointKey", "RegionKey"], {}, count=True, year=year)
    p = with_region(with_point(p, wh, "RoadCategory", "CountPointID", "LinkLengthKm"), wh)
    g = p.groupBy("RegionName", "RoadCategory").agg(
        F.count_distinct("CountPointID").alias("NumPoints"),
        F.sum(F.col("LinkLengthKm") * F.col("_n")).alias("_km"),
    )
    return g.select(
        "RegionName", "RoadCategory", "NumPoints",
        F.col("_km").cast("double").alias("TotalLinkKm"),
        F.round(safe_div("NumPoints", "_km") * F.lit(100.0), 2).alias("PointsPer100km"),
    ).orderBy("RegionName", "RoadCategory")


def directional_imbalance_sql(wh: Warehouse, year: int = 2023, min_flow: float = 1000, n: int = 30) -> DataFrame:
    p = partials(wh.where_fact(F.col("DirectionOfTravel") != "C"),
                 ["CountPointKey", "RegionKey", "DirectionOfTravel"], {"s": MV}, coarse=True, year=year)
    p = with_region(with_point(p, wh, "RoadName", "RoadCategory"), wh)
    keys = ["RoadName", "RoadCategory", "RegionName"]
    per_dir = p.groupBy(*keys, "DirectionOfTravel").agg(F.sum("s").alias("Flow"))
    piv = per_dir.groupBy(*keys).agg(
        F.max("Flow").cast("double").alias("MaxDirFlow"),
        F.min("Flow").cast("double").alias("MinDirFlow"),
        F.count(F.lit(1)).alias("_n"),
    ).where((F.col("_n") >= 2) & (F.col("MinDirFlow") > min_flow)).drop("_n")
    piv = piv.withColumn("ImbalanceRatio", F.round(safe_div("MaxDirFlow", "MinDirFlow"), 2))
    return top_n(piv, n, [F.desc_nulls_last("ImbalanceRatio")] + [F.asc_nulls_first(k) for k in keys])


def cycling_share_export(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {"TotalCycles": "PedalCycles", "TotalMotor": MV})
    return y.withColumn(
        "CycleSharePct", pct("TotalCycles", F.col("TotalMotor") + F.col("TotalCycles"), 4)
    ).orderBy("Year")


# --------------------------------------------------------------------------
# Parameterised serving queries
# --------------------------------------------------------------------------

MAX_API_LIMIT = 100


def table_row_counts(wh: Warehouse) -> DataFrame:
    parts = [
        wh.table(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name in ["DimDate", "DimRegion", "DimLocalAuthority", "DimCountPoint", FACT]
    ]
    return reduce(DataFrame.unionByName, parts)


def regions_list(wh: Warehouse) -> DataFrame:
    return wh.table("DimRegion").select("RegionKey", "RegionID", "RegionName", "RegionONSCode").orderBy(
        "RegionName", "RegionKey")


def yearly_totals_api(wh: Warehouse) -> DataFrame:
    return yearly(wh, {"TotalMotor": MV, "TotalHGV": "AllHGVs", "TotalCycles": "PedalCycles"}).orderBy("Year")


def traffic_by_region(wh: Warehouse, year: int = 2023) -> DataFrame:
    p = with_region(partials(wh, ["RegionKey"], {"mv": MV, "hgv": "AllHGVs"}, year=year), wh)
    return p.groupBy("RegionName").agg(
        sum_d("mv").alias("TotalMotor"), sum_d("hgv").alias("TotalHGV")
    ).orderBy(F.desc("TotalMotor"), "RegionName")


def top_roads(wh: Warehouse, year: int = 2023, limit: int = 10) -> DataFrame:
    if not 1 <= int(limit) <= MAX_API_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_API_LIMIT}")
    p = with_point(partials(wh, ["CountPointKey"], {"s": MV}, coarse=True, year=year), wh, "RoadName", "RoadCategory")
    g = p.groupBy("RoadName", "RoadCategory").agg(sum_d("s").alias("TotalTraffic"))
    return top_n(g, int(limit), [F.desc("TotalTraffic"), F.asc_nulls_first("RoadName"),
                                 F.asc_nulls_first("RoadCategory")])


MIX = {"Cars": "CarsAndTaxis", "LGVs": "LGVs", "HGVs": "AllHGVs", "Buses": "BusesAndCoaches",
       "Cycles": "PedalCycles", "Motorcycles": "TwoWheeledMotorVehicles"}


def vehicle_mix_by_region(wh: Warehouse, year: int = 2023) -> DataFrame:
    p = with_region(partials(wh, ["RegionKey"], {a: c for a, c in MIX.items()}, year=year), wh)
    return p.groupBy("RegionName").agg(*[sum_d(a).alias(a) for a in MIX]).orderBy("RegionName")


def hotspots(wh: Warehouse, year: int = 2023, min_traffic: float = 50_000) -> DataFrame:
    p = partials(wh, ["CountPointKey", "RegionKey"], {"s": MV}, year=year)
    p = with_region(with_point(p, wh, "Latitude", "Longitude", "RoadName"), wh)
    keys = ["Latitude", "Longitude", "RoadName", "RegionName"]
    g = p.groupBy(*keys).agg(sum_d("s").alias("TotalTraffic")).where(F.col("TotalTraffic") > min_traffic)
    return (
        g.withColumn("Latitude", F.col("Latitude").cast("double"))
        .withColumn("Longitude", F.col("Longitude").cast("double"))
        .orderBy(F.desc("TotalTraffic"), *keys)
    )


def available_years(wh: Warehouse) -> DataFrame:
    """From the fact's partition folders; no fact file is read."""
    years = wh.fact_years()
    if years is None:
        return wh.fact.select(F.col("DateKey").alias("Year")).distinct().orderBy("Year")
    return wh.spark.createDataFrame([(y,) for y in years], "Year int")


def yearly_overview(wh: Warehouse) -> DataFrame:
    f = fact(wh, "CountPointKey", MV, "AllHGVs", "PedalCycles")
    return f.groupBy("Year").agg(
        sum_d(MV).alias("TotalMotor"), sum_d("AllHGVs").alias("TotalHGV"),
        sum_d("PedalCycles").alias("TotalCycles"), F.count_distinct("CountPointKey").alias("CountPoints"),
    ).orderBy("Year")


def regional_overview(wh: Warehouse, year: int = 2023) -> DataFrame:
    p = with_region(partials(wh, ["RegionKey", "CountPointKey"], {"mv": MV, "hgv": "AllHGVs"}, year=year), wh)
    return p.groupBy("RegionName").agg(
        sum_d("mv").alias("TotalMotor"), sum_d("hgv").alias("TotalHGV"),
        F.count_distinct("CountPointKey").alias("CountPoints"),
    ).orderBy(F.desc("TotalMotor"), "RegionName")


def national_vehicle_mix(wh: Warehouse, year: int = 2023) -> DataFrame:
    """Column totals of the regional vehicle mix, in long form."""
    f = fact(wh, *MIX.values(), year=year)
    wide = f.agg(*[sum_d(c).alias(a) for a, c in MIX.items()])
    return wide.unpivot([], list(MIX), "Vehicle", "Total")


def vehicle_mix_long(wh: Warehouse, year: int = 2023) -> DataFrame:
    mix = vehicle_mix_by_region(wh, year)
    return mix.unpivot(["RegionName"], ["Cars", "LGVs", "HGVs", "Buses"], "variable", "value")


def vehicle_trend_long(wh: Warehouse, start: int = 2017, end: int = 2023) -> DataFrame:
    cols = {"Cars": "CarsAndTaxis", "LGVs": "LGVs", "HGVs": "AllHGVs", "Buses": "BusesAndCoaches",
            "Cycles": "PedalCycles"}
    y = yearly(wh, cols, between=(start, end))
    return y.unpivot(["Year"], list(cols), "Vehicle", "AADF")


def cycling_trend(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {"TotalCycles": "PedalCycles", "_motor": MV})
    return y.select("Year", "TotalCycles",
                    pct("TotalCycles", F.col("_motor") + F.col("TotalCycles"), 4).alias("CycleShare")).orderBy("Year")


def lgv_share_trend(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {"TotalLGVs": "LGVs", "_motor": MV})
    return y.select("Year", "TotalLGVs", pct("TotalLGVs", "_motor", 2).alias("LGV_Share")).orderBy("Year")


def bus_share_trend(wh: Warehouse) -> DataFrame:
    y = yearly(wh, {"TotalBuses": "BusesAndCoaches", "_motor": MV})
    return y.select("Year", "TotalBuses", pct("TotalBuses", "_motor", 3).alias("BusShare")).orderBy("Year")


def _by(wh: Warehouse, by: str, *cols: str) -> DataFrame:
    if by == "Year":
        return fact(wh, *cols)
    if by == "RegionName":
        return with_region(fact(wh, "RegionKey", *cols), wh)
    if by == "LocalAuthorityName":
        return with_la(fact(wh, "LocalAuthorityKey", *cols), wh)
    if by in ("RoadCategory", "RoadName", "RoadType"):
        return with_point(fact(wh, "CountPointKey", *cols), wh, by)
    if by == "DirectionOfTravel":
        return fact(wh, "DirectionOfTravel", *cols)
    raise ValueError(f"unsupported grouping {by!r}")


def measure_total_motor(wh: Warehouse, by: str = "Year") -> DataFrame:
    """BI measure: total motor vehicles, sliced by any dimension attribute."""
    return _by(wh, by, MV).groupBy(by).agg(sum_d(MV).alias("TotalMotorVehicles")).orderBy(by)


def measure_hgv_pct(wh: Warehouse, by: str = "RegionName") -> DataFrame:
    """BI measure: HGV share as a fraction, 0 when there is no traffic."""
    g = _by(wh, by, MV, "AllHGVs").groupBy(by).agg(F.sum("AllHGVs").alias("_h"), F.sum(MV).alias("_m"))
    return g.select(by, F.round(divide_or_zero("_h", "_m"), 6).alias("HGVPercentage")).orderBy(by)


def measure_yoy_calendar(wh: Warehouse) -> DataFrame:
    """BI measure: growth against the same slice one calendar year earlier
    (self-join on Year - 1); a year without a predecessor yields 0."""
    y = yearly(wh, {"CurrentYear": MV})
    prev = y.select((F.col("Year") + 1).alias("Year"), F.col("CurrentYear").alias("PrevYear"))
    j = y.join(prev, "Year", "left")
    return j.select(
        "Year", "CurrentYear", "PrevYear",
        F.round(divide_or_zero(F.col("CurrentYear") - F.col("PrevYear"), "PrevYear"), 6).alias("YoYGrowth"),
    ).orderBy("Year")

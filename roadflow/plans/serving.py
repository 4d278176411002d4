"""Pre-aggregated serving datasets and the views built on them.

The serving datasets are computed from the raw AADF extract (data-frame
semantics, see :mod:`roadflow.plans.analyses`) and are small: one row per
year, per (year, region), per (year, road) for the top 50, etc.  They are
stored and kept up by change (:func:`refresh_serving`), and the dashboard views
(``cloud_*``) read the stored files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import dbl, growth_pct, pct
from ..operators.distinct import count_keys, key_bitmaps
from . import extracts
from .analyses import as_numbers, keys_present, psum, ratio
from ..schemas import LATITUDE_TYPE, LONGITUDE_TYPE
from .snapshots import Snapshots

YEARLY_COLS = {
    "TotalMotor": "all_motor_vehicles", "TotalHGV": "all_HGVs", "TotalCycles": "pedal_cycles",
    "TotalCars": "cars_and_taxis", "TotalLGVs": "LGVs", "TotalBuses": "buses_and_coaches",
    "TotalMotorcycles": "two_wheeled_motor_vehicles",
}
REGIONAL_COLS = {
    "TotalMotor": "all_motor_vehicles", "TotalHGV": "all_HGVs", "TotalCars": "cars_and_taxis",
    "TotalLGVs": "LGVs", "TotalBuses": "buses_and_coaches",
    "TotalMotorcycles": "two_wheeled_motor_vehicles", "TotalCycles": "pedal_cycles",
}
MIX_COLS = {
    "Cars": "cars_and_taxis", "LGVs": "LGVs", "HGVs": "all_HGVs", "Buses": "buses_and_coaches",
    "Motorcycles": "two_wheeled_motor_vehicles", "Cycles": "pedal_cycles",
}


def _nums(raw: DataFrame) -> DataFrame:
    return as_numbers(raw)


def latest_year_rows(df: DataFrame, year_col: str = "year") -> DataFrame:
    """Rows of the newest year: a one-row aggregate semi-joined back (a
    broadcast hash join on the year, no cartesian product).  Used on
    derived (year-grain) data, where a separate scalar job would recompute
    the input."""
    latest = df.agg(F.max(year_col).alias("_latest"))
    return df.join(F.broadcast(latest), F.col(year_col) == F.col("_latest"), "left_semi")


def latest_year_partition(df: DataFrame, year_col: str = "year") -> DataFrame:
    """Rows of the newest year of a year-partitioned source: the newest year
    is fetched as one scalar (a scan of the partition column only) and then
    used as a literal predicate, so only that year's files are read."""
    latest = df.agg(F.max(year_col)).first()[0]
    if latest is None:
        return df.limit(0)
    return df.where(F.col(year_col) == F.lit(latest))


PLACE = "_at"


def smallest_position(df: DataFrame) -> F.Column:
    """Aggregate ``_at``: the smallest whole position, by latitude, then longitude.

    As two decimals of the extract it is one number, which a hash aggregate can
    keep; the minimum of a struct would have all rows sorted by their keys."""
    whole = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    if not _packs(df):
        return F.min(F.when(whole, F.struct("latitude", "longitude"))).alias(PLACE)
    # Longitudes are under a thousand, so a step of latitude (1e-8, here 1e4) outweighs any of them.
    packed = F.expr("CAST(latitude * 1000000000000BD + longitude AS DECIMAL(25,8))")
    return F.min(F.when(whole, packed)).alias(PLACE)


def _packs(df: DataFrame) -> bool:
    types = dict(df.dtypes)
    return (types["latitude"], types["longitude"]) == (LATITUDE_TYPE.simpleString(), LONGITUDE_TYPE.simpleString())


def position(df: DataFrame) -> tuple[F.Column, F.Column]:
    """Latitude and longitude of ``_at``, in the types that they have in ``df``, of which it was aggregated."""
    if not _packs(df):
        return F.col(f"{PLACE}.latitude").alias("latitude"), F.col(f"{PLACE}.longitude").alias("longitude")
    latitude = f"CAST(round({PLACE} / 10000BD, 0) / 100000000BD AS {LATITUDE_TYPE.simpleString()})"
    longitude = f"CAST({PLACE} - {latitude} * 1000000000000BD AS {LONGITUDE_TYPE.simpleString()})"
    return F.expr(latitude).alias("latitude"), F.expr(longitude).alias("longitude")


def serve_yearly_totals(raw: DataFrame) -> DataFrame:
    df = keys_present(_nums(raw), ["year"])
    return df.groupBy(F.col("year").alias("Year")).agg(
        *[psum(c).alias(a) for a, c in YEARLY_COLS.items()],
        F.count_distinct("count_point_id").alias("CountPoints"),
    ).orderBy("Year")


def serve_regional_by_year(raw: DataFrame) -> DataFrame:
    df = keys_present(_nums(raw), ["year", "region_name"])
    return df.groupBy(F.col("year").alias("Year"), F.col("region_name").alias("RegionName")).agg(
        *[psum(c).alias(a) for a, c in REGIONAL_COLS.items()],
        F.count_distinct("count_point_id").alias("CountPoints"),
    ).orderBy("Year", "RegionName")


def serve_top_roads_by_year(raw: DataFrame, n: int = 50) -> DataFrame:
    """Top ``n`` roads per year.  ``row_number() <= n`` over a year window
    is planned as a group limit: each task keeps only its local top ``n``
    per year before the shuffle, so a large year never lands whole in
    one task."""
    df = keys_present(_nums(raw), ["year", "road_name", "road_category"])
    g = df.groupBy(F.col("year").alias("Year"), F.col("road_name").alias("RoadName"),
                   F.col("road_category").alias("RoadCategory")).agg(
        psum("all_motor_vehicles").alias("TotalTraffic"))
    w = Window.partitionBy("Year").orderBy(F.desc("TotalTraffic"), "RoadName", "RoadCategory")
    return g.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def serve_geo_hotspots(raw: DataFrame, min_total: float = 10_000) -> DataFrame:
    """Latest year, per point: total traffic and its position.  Rows carry no
    order, so of several positions the smallest whole one is taken: latitude
    and longitude always come from the same row."""
    df = keys_present(latest_year_partition(_nums(raw)), ["count_point_id", "road_name", "region_name"])
    g = df.groupBy(F.col("count_point_id").alias("CountPointID"), F.col("road_name").alias("RoadName"),
                   F.col("region_name").alias("RegionName")).agg(
        psum("all_motor_vehicles").alias("TotalTraffic"),
        smallest_position(df),
    ).where(F.col("TotalTraffic") > min_total)
    latitude, longitude = position(df)
    return g.select("CountPointID", "RoadName", "RegionName", "TotalTraffic",
                    dbl(latitude).alias("Latitude"), dbl(longitude).alias("Longitude"))


def serve_vehicle_mix(raw: DataFrame) -> DataFrame:
    df = keys_present(latest_year_partition(_nums(raw)), ["region_name"])
    return df.groupBy(F.col("region_name").alias("RegionName")).agg(
        *[psum(c).alias(a) for a, c in MIX_COLS.items()]).orderBy("RegionName")


def serve_road_category_by_year(raw: DataFrame) -> DataFrame:
    df = keys_present(_nums(raw), ["year", "road_category"])
    return df.groupBy(F.col("year").alias("Year"), F.col("road_category").alias("RoadCategory")).agg(
        psum("all_motor_vehicles").alias("TotalTraffic"),
        F.count_distinct("count_point_id").alias("CountPoints"),
    ).orderBy("Year", "RoadCategory")


# --------------------------------------------------------------------------
# Dashboard views on the serving datasets (all inputs are year-grain or
# region-grain, i.e. tiny; windows below run on at most a few dozen rows)
# --------------------------------------------------------------------------

def cloud_kpis(yearly: DataFrame) -> DataFrame:
    """Latest year's totals and the change against the previous row."""
    w = Window.orderBy("Year")
    y = yearly.select("Year", "TotalMotor", "TotalHGV", "CountPoints").withColumns({
        "PrevMotor": F.lag("TotalMotor").over(w), "PrevHGV": F.lag("TotalHGV").over(w)})
    latest = latest_year_rows(y, "Year")
    return latest.select(
        "Year", "TotalMotor", "TotalHGV", "CountPoints",
        (F.col("TotalMotor") - F.col("PrevMotor")).alias("MotorDelta"),
        (F.col("TotalHGV") - F.col("PrevHGV")).alias("HGVDelta"),
    )


def cloud_yoy(yearly: DataFrame) -> DataFrame:
    w = Window.orderBy("Year")
    prev = F.lag("TotalMotor").over(w)
    y = yearly.select("Year", F.round((F.try_divide(dbl("TotalMotor"), F.nullif(dbl(prev), F.lit(0.0))) - 1)
                                      * F.lit(100.0), 6).alias("YoY_Growth"))
    return y.where(F.col("YoY_Growth").isNotNull()).orderBy("Year")


def cloud_region_table(regional: DataFrame, year: int = 2023) -> DataFrame:
    return regional.where(F.col("Year") == year).select(
        "RegionName", "TotalMotor", "TotalHGV", "CountPoints").orderBy(F.desc("TotalMotor"), "RegionName")


def cloud_hgv_share(mix: DataFrame) -> DataFrame:
    den = F.col("Cars") + F.col("LGVs") + F.col("HGVs") + F.col("Buses") + F.col("Motorcycles")
    return mix.select("RegionName", "HGVs", ratio("HGVs", den, 2).alias("HGV_Pct")).orderBy(
        F.asc_nulls_last("HGV_Pct"), "RegionName")


def cloud_vehicle_long(yearly: DataFrame, start: int = 2017, end: int = 2023) -> DataFrame:
    cols = ["TotalCars", "TotalLGVs", "TotalHGV", "TotalBuses", "TotalCycles"]
    long = yearly.where(F.col("Year").between(start, end)).unpivot(["Year"], cols, "Vehicle", "AADF")
    return long.withColumn("Vehicle", F.replace(F.col("Vehicle"), F.lit("Total"), F.lit("")))


def cloud_lgv_share(yearly: DataFrame) -> DataFrame:
    return yearly.select("Year", ratio("TotalLGVs", "TotalMotor", 2).alias("LGV_Share")).orderBy("Year")


def cloud_bus_share(yearly: DataFrame) -> DataFrame:
    return yearly.select("Year", ratio("TotalBuses", "TotalMotor", 3).alias("Bus_Share")).orderBy("Year")


def cloud_road_category(road_cat: DataFrame, year: int = 2023) -> DataFrame:
    return road_cat.where(F.col("Year") == year).select("RoadCategory", "TotalTraffic")


def cloud_top_roads(top_roads: DataFrame, year: int = 2023, n: int = 20) -> DataFrame:
    return top_roads.where(F.col("Year") == year).orderBy(
        F.desc("TotalTraffic"), "RoadName", "RoadCategory").limit(n)


def cloud_hotspots(geo: DataFrame, min_traffic: float = 50_000) -> DataFrame:
    return geo.where(F.col("TotalTraffic") >= min_traffic)


# --------------------------------------------------------------------------
# Chart feeds (scaled, sorted inputs of the static charts)
# --------------------------------------------------------------------------

def chart_feeds(wh, summary_year: int = 2023, covid: tuple[int, int] = (2019, 2023)) -> DataFrame:
    """``(chart, series, x, y)`` rows for the seven static charts.

    All year-grain charts share one yearly aggregate of the fact, the two
    regional charts one regional aggregate; each is unpivoted into its series,
    so the fact is scanned three times for thirteen series."""
    from . import reports

    def unpivoted(df: DataFrame, x: str, series: list[tuple]) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(chart).alias("chart"), F.lit(name).alias("series"),
                                  F.round(dbl(y) / F.lit(scale), 6).alias("y")) for chart, name, y, scale in series])
        out = df.select(F.col(x).cast("string").alias("x"), F.explode(rows).alias("r")).select(
            "r.chart", "r.series", "x", "r.y")
        return out.where(F.col("y").isNotNull())

    modes = {"Cars": "CarsAndTaxis", "LGVs": "LGVs", "HGVs": "AllHGVs", "Buses": "BusesAndCoaches",
             "Cycles": "PedalCycles"}
    y = reports.yearly(wh, {"Motor": reports.MV, **modes})
    y = y.withColumn("Growth", growth_pct("Motor", reports.prev_row(y, "Motor")))
    in_covid = F.col("Year").between(*covid)
    by_year = unpivoted(y, "Year", [
        ("yoy_growth_trend", "traffic_billions", F.col("Motor"), 1e9),
        ("yoy_growth_trend", "growth_pct", F.col("Growth"), 1.0),
        *[("covid_impact", f"{m.lower()}_millions", F.when(in_covid, F.col(m)), 1e6) for m in modes],
        ("cycling_trends", "cycles_thousands", F.col("Cycles"), 1e3),
        ("cycling_trends", "share_pct", pct("Cycles", F.col("Motor") + F.col("Cycles"), 4), 1.0),
        ("lgv_ecommerce_trend", "lgv_share_pct", pct("LGVs", "Motor"), 1.0),
    ])
    p = reports.with_region(reports.partials(
        wh, ["Year", "RegionKey"], {"mv": reports.MV, "hgv": "AllHGVs"}), wh)
    regions = p.groupBy("RegionName").agg(
        F.sum(F.when(F.col("Year") == summary_year, F.col("mv"))).alias("Latest"),
        F.sum("mv").alias("Motor"), F.sum("hgv").alias("HGV"))
    by_region = unpivoted(regions, "RegionName", [
        ("regional_traffic", "motor_millions", F.col("Latest"), 1e6),
        ("hgv_passenger_mix", "hgv_pct", pct("HGV", "Motor"), 1.0),
    ])
    c = reports.with_point(reports.partials(wh, ["CountPointKey"], {"mv": reports.MV}, coarse=True), wh, "RoadCategory")
    by_category = unpivoted(c.groupBy("RoadCategory").agg(F.sum("mv").alias("Motor")), "RoadCategory", [
        ("road_category_pie", "traffic", F.col("Motor"), 1.0)])
    return by_year.unionByName(by_region).unionByName(by_category)


# --------------------------------------------------------------------------
# Stored datasets, kept up by change
# --------------------------------------------------------------------------

#: Stored name -> the dataset, and whether it has rows for each year (else of the newest year only).
DATASETS = {
    "yearly_totals": (serve_yearly_totals, True),
    "regional_by_year": (serve_regional_by_year, True),
    "top_roads_by_year": (serve_top_roads_by_year, True),
    "geospatial_hotspots": (serve_geo_hotspots, False),
    "vehicle_mix": (serve_vehicle_mix, False),
    "road_category_by_year": (serve_road_category_by_year, True),
}
STATE, POINT_SETS = "state", "point_sets"
STATE_KEYS = ["year", "region_name", "road_name", "road_category", "count_point_id"]
POINT_GROUPS = ["year", "region_name", "road_category"]


def serving_state(raw: DataFrame) -> DataFrame:
    """What all six datasets need of the extract, one row per year, point and its attributes.

    It has the extract's columns, with measures summed and of several positions
    the smallest whole one, so the datasets are the same functions of it."""
    sums = sorted(set(YEARLY_COLS.values()) | set(REGIONAL_COLS.values()) | set(MIX_COLS.values()))
    rows = keys_present(_nums(raw), ["year"])
    return rows.groupBy(*STATE_KEYS).agg(*[F.sum(c).alias(c) for c in sums], smallest_position(rows)).select(
        *STATE_KEYS, *sums, *position(rows))


def refresh_serving(source: Snapshots, out: Snapshots, parallel: int = 4) -> list[int]:
    """Brings the stored datasets up to the extract's newest snapshot; the years that were computed anew.

    The state and the datasets stand by year with the source folders they come
    from. Only years whose folders have changed are scanned, once, into the
    state; their rows of the datasets come from the state. Years that are gone
    go. All is committed at once."""
    from concurrent.futures import ThreadPoolExecutor

    taken, before = source.snapshot(), out.snapshot()
    now, then = extracts.year_versions(taken), before.notes.get("source", {})
    now.pop("None", None)  # rows without a year are in no dataset
    stale = {y for y in now.keys() | then.keys() if now.get(y) != then.get(y)}
    if before.version and not stale:
        return []
    fresh = sorted(int(y) for y in stale & now.keys())
    state = serving_state(extracts.typed(source, fresh, taken))
    parts = {STATE: extracts.year_parts(before.of(STATE), "year", stale, False) + out.write(STATE, state, ("year",))}
    schemas = {STATE: state.schema.json()}
    changed = out.read(STATE, extracts.year_parts(parts[STATE], "year", {str(y) for y in fresh}, True), state.schema)
    newest = str(max(map(int, now), default=0))
    latest = out.read(STATE, extracts.year_parts(parts[STATE], "year", {newest}, True), state.schema)

    def store(name: str) -> None:
        make, by_year = DATASETS.get(name) or (None, True)
        if name == POINT_SETS:
            rows = key_bitmaps(changed, POINT_GROUPS, "count_point_id").withColumnRenamed("year", "Year")
        else:
            rows = make(changed if by_year else latest)
        written = out.write(name, rows, ("Year",) if by_year else ())
        kept = extracts.year_parts(before.of(name), "Year", stale, False) if by_year else []
        parts[name], schemas[name] = kept + written, rows.schema.json()

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(store, [*DATASETS, POINT_SETS]))
    out.commit(before, parts, {"source": now, "schemas": schemas})
    return fresh


def served(out: Snapshots, name: str) -> DataFrame:
    """A stored dataset."""
    snapshot = out.snapshot()
    schema = T.StructType.fromJson(json.loads(snapshot.notes["schemas"][name]))
    return out.read(name, snapshot.of(name), schema)


def distinct_points(out: Snapshots, groups: list[str]) -> DataFrame:
    """Distinct count points of any of year, region and road category, over all years, from the stored bitmaps: the
    years' sets are merged, no row is read again."""
    return count_keys(served(out, POINT_SETS), groups, "CountPoints")


# --------------------------------------------------------------------------
# Road segments joined to traffic; point features
# --------------------------------------------------------------------------

def roads_with_traffic(segments: DataFrame, raw: DataFrame, year: int | None = None) -> DataFrame:
    """Every road segment with the traffic summed over all directions at its
    count point (left join: segments without a count stay, with NULL)."""
    df = keys_present(as_numbers(raw, ["all_motor_vehicles"]), ["count_point_id"])
    if year is not None:
        df = df.where(F.col("year") == year)
    traffic = df.groupBy("count_point_id").agg(psum("all_motor_vehicles").alias("all_motor_vehicles"))
    return segments.join(traffic, segments.CP_Number == traffic.count_point_id, "left").select(
        "CP_Number", "RoadNumber", "count_point_id", "all_motor_vehicles")


def point_features(points_dim: DataFrame, traffic: DataFrame) -> DataFrame:
    """GeoJSON point features (one JSON text per count point)."""
    j = points_dim.join(traffic, "CountPointID", "left")
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"),
                 F.array(dbl("Longitude"), dbl("Latitude")).alias("coordinates")).alias("geometry"),
        F.struct(F.col("CountPointID").alias("CP_Number"), F.col("RoadName").alias("RoadNumber"),
                 dbl("all_motor_vehicles").alias("all_motor_vehicles")).alias("properties"),
    )
    return j.select("CountPointID", F.to_json(feature).alias("feature"))

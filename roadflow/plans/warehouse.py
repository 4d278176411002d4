"""Star-schema warehouse: dimensions, fact load, incremental load.

Layout (Parquet under the shared folder, see :mod:`roadflow.plans.snapshots`):

* ``DimDate`` - 26 calendar years, ``DateKey = Year``
* ``DimRegion``, ``DimLocalAuthority``, ``DimCountPoint`` - dense 1..n keys
  in natural-id order on the first refresh; later refreshes keep the keys of
  known members (:func:`roadflow.operators.keys.with_stable_key`), whose
  registry is stored as ``Keys<dimension>``
* ``FactTrafficFlowDirection`` - one write per load, partitioned by ``status``
  and ``DateKey`` (the year), so every year predicate becomes partition
  pruning. Status ``loaded`` is the fact; rows without all their keys
  (``no_key``) or with a measure out of range (``over_range``) are set apart as
  they came and read as ``RejectedRows``. Written with ``REBALANCE`` so adaptive
  execution splits an oversized year over many writers, and sorted by count
  point inside each file.

Everything that a refresh or a load writes becomes visible by one commit, with
the row counts of its parts; joins broadcast a dimension only when its recorded
size is under the bound.
"""

from __future__ import annotations

import os
import threading
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import any_over_range, clean_aadf
from ..operators.joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, bounded_broadcast, row_bytes
from ..operators.keys import with_stable_key
from ..schemas import FACT_MEASURES, MEASURE_TYPE, YEAR_MAX, YEAR_MIN
from ..session import materialise, new_output_dir
from .snapshots import Part, Snapshot, Snapshots

FACT = "FactTrafficFlowDirection"
REJECTED = "RejectedRows"
OVER_RANGE, AS_CAME, STATUS = "_over_range", "_as_came", "status"
LOADED, NO_KEY, TOO_LARGE = "loaded", "no_key", "over_range"
DIMS = ["DimDate", "DimRegion", "DimLocalAuthority", "DimCountPoint"]
FACT_KEYS = ["DateKey", "CountPointKey", "LocalAuthorityKey", "RegionKey"]
FACT_SCHEMA = T.StructType(
    [T.StructField(k, T.IntegerType()) for k in FACT_KEYS if k != "DateKey"]
    + [T.StructField("DirectionOfTravel", T.StringType())]
    + [T.StructField(m, MEASURE_TYPE) for m in FACT_MEASURES.values()]
    + [T.StructField("LoadDate", T.TimestampType()), T.StructField("DateKey", T.IntegerType())])  # DateKey: the partition
FACT_COLUMNS = FACT_KEYS + ["DirectionOfTravel"] + list(FACT_MEASURES.values())


# --------------------------------------------------------------------------
# Dimensions
# --------------------------------------------------------------------------

def dim_date(spark: SparkSession) -> DataFrame:
    """One row per year 2000-2025; attributes describe 1 January (weekend
    flag and quarter/month/day are fixed as in the source loader)."""
    d = F.make_date(F.col("Year"), F.lit(1), F.lit(1))
    return (
        spark.range(YEAR_MIN, YEAR_MAX + 1)
        .select(F.col("id").cast("int").alias("Year"))
        .select(
            F.col("Year").alias("DateKey"),
            d.alias("FullDate"),
            "Year",
            F.lit(1).alias("Quarter"),
            F.lit(1).alias("Month"),
            F.lit("January").alias("MonthName"),
            F.lit(1).alias("Day"),
            (F.weekday(d) + 1).alias("DayOfWeek"),
            F.date_format(d, "EEEE").alias("DayName"),
            F.lit(False).alias("IsWeekend"),
            F.col("Year").alias("FiscalYear"),
        )
    )


REGION_IDS = ["RegionID", "RegionName", "RegionONSCode"]
AUTHORITY_IDS = ["LocalAuthorityID", "RegionKey", "LocalAuthorityName", "LocalAuthorityCode"]


def dim_region(count_points: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(the dimension, its key registry); so for the other dimensions with surrogate keys."""
    regions = count_points.select(
        F.col("region_id").alias("RegionID"),
        F.col("region_name").alias("RegionName"),
        F.col("region_ons_code").alias("RegionONSCode"),
    ).distinct()
    keyed, registry = with_stable_key(regions, known, "RegionKey", REGION_IDS)
    return keyed.select("RegionKey", *REGION_IDS), registry


def dim_local_authority(count_points: DataFrame, regions: DataFrame,
                        known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    las = count_points.select(
        F.col("local_authority_id").alias("LocalAuthorityID"),
        F.col("local_authority_name").alias("LocalAuthorityName"),
        F.col("local_authority_code").alias("LocalAuthorityCode"),
        F.col("region_id").alias("RegionID"),
    ).distinct()
    region_keys = bounded_broadcast(regions.select("RegionID", "RegionKey"))
    las = las.join(region_keys, "RegionID", "left")
    keyed, registry = with_stable_key(las, known, "LocalAuthorityKey", AUTHORITY_IDS)
    return keyed.select("LocalAuthorityKey", *AUTHORITY_IDS), registry


CP_ATTRS = ["road_name", "road_category", "road_type", "latitude", "longitude", "link_length_km"]


def dim_count_point(count_points: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One row per count point: the earliest-year row wins, ties broken on
    the attributes (an explicit order, never an arbitrary ``dropDuplicates``).

    Written as a ``min_by`` aggregate rather than a window so it combines
    partially before the shuffle: a point with very many rows never lands
    whole in one task."""
    order = F.struct(F.col("year").isNull(), F.col("year"), *[F.col(c) for c in CP_ATTRS])
    first = count_points.groupBy("count_point_id").agg(
        F.min_by(F.struct(*[F.col(c) for c in CP_ATTRS]), order).alias("a")
    ).select(
        F.col("count_point_id").alias("CountPointID"),
        F.col("a.road_name").alias("RoadName"),
        F.col("a.road_category").alias("RoadCategory"),
        F.col("a.road_type").alias("RoadType"),
        F.col("a.latitude").alias("Latitude"),
        F.col("a.longitude").alias("Longitude"),
        F.col("a.link_length_km").alias("LinkLengthKm"),
    )
    keyed, registry = with_stable_key(first, known, "CountPointKey", ["CountPointID"])
    return keyed.select("CountPointKey", "CountPointID", "RoadName", "RoadCategory", "RoadType",
                        "Latitude", "Longitude", "LinkLengthKm"), registry


# --------------------------------------------------------------------------
# Fact
# --------------------------------------------------------------------------

def lookups(dates: DataFrame, regions: DataFrame, las: DataFrame, points: DataFrame, sizes: dict | None = None):
    """Natural id -> surrogate key maps.  A duplicated natural id maps to
    its highest key (the later row wins), so lookups never fan out."""
    sizes = sizes or {}

    def b(df, name):
        return bounded_broadcast(df, BROADCAST_MAX_ROWS, sizes.get(name))

    return {
        "date": b(dates.select(F.col("Year").alias("_y"), "DateKey"), "DimDate"),
        "region": b(regions.groupBy(F.col("RegionID").alias("_r")).agg(F.max("RegionKey").alias("RegionKey")), "DimRegion"),
        "la": b(las.groupBy(F.col("LocalAuthorityID").alias("_l")).agg(
            F.max("LocalAuthorityKey").alias("LocalAuthorityKey")), "DimLocalAuthority"),
        # Count points can be large: size-checked, else a shuffled join.
        "cp": b(points.groupBy(F.col("CountPointID").alias("_c")).agg(
            F.max("CountPointKey").alias("CountPointKey")), "DimCountPoint"),
    }


def attach_keys(clean: DataFrame, maps: dict) -> DataFrame:
    """Cleaned rows with their four surrogate keys (NULL when not found)."""
    return attach_points(attach_names(clean, maps), maps)


def attach_names(clean: DataFrame, maps: dict) -> DataFrame:
    """The keys of the year, region and local authority."""
    j = clean.join(maps["date"], clean.year == F.col("_y"), "left").drop("_y")
    j = j.join(maps["region"], j.region_id == F.col("_r"), "left").drop("_r")
    return j.join(maps["la"], j.local_authority_id == F.col("_l"), "left").drop("_l")


def names_found():
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in FACT_KEYS if k != "CountPointKey"])


def attach_points(keyed: DataFrame, maps: dict) -> DataFrame:
    return keyed.join(maps["cp"], keyed.count_point_id == F.col("_c"), "left").drop("_c")


def all_keys_present():
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in FACT_KEYS])


def unknown_points(raw: DataFrame, points: DataFrame) -> DataFrame:
    """The ids in ``raw`` that the point map lacks, as ``_u``."""
    ids = raw.select(F.col("count_point_id").alias("_u")).where(F.col("_u").isNotNull()).distinct()
    found = materialise(ids.join(points, F.col("_u") == F.col("_c"), "left_anti"), "unknown-points")
    return bounded_broadcast(found, known_rows=found.count())


def keyed_rows(raw: DataFrame, maps: dict, unknown: DataFrame | None = None) -> DataFrame:
    """Cleaned rows with their keys, their status, and the row as it came for those that are set apart.

    Where the point map is too large to broadcast, ``unknown`` (the ids that it
    lacks) tells beforehand which rows are set apart: only these carry their
    raw row through the shuffle of the join by point."""
    kind = MEASURE_TYPE.simpleString()
    came = raw.withColumns({OVER_RANGE: any_over_range(raw, kind), AS_CAME: F.struct(*raw.columns)})
    if unknown is not None:
        came = came.join(unknown, came.count_point_id == F.col("_u"), "left")
    clean = attach_names(clean_aadf(came, kind), maps)
    if unknown is not None:
        apart = ~names_found() | F.col("_u").isNotNull() | F.col(OVER_RANGE)
        clean = clean.withColumn(AS_CAME, F.when(apart, F.col(AS_CAME))).drop("_u")
    keyed = attach_points(clean, maps)
    status = F.when(~all_keys_present(), NO_KEY).when(F.col(OVER_RANGE), TOO_LARGE).otherwise(LOADED)
    return keyed.withColumn(STATUS, status).drop(OVER_RANGE)


def fact_rows(keyed: DataFrame) -> DataFrame:
    """What the fact stores: keys and measures of loaded rows, the whole row as it came of the others."""
    loaded = F.col(STATUS) == LOADED
    cols = [F.col(k).cast("int").alias(k) for k in FACT_KEYS if k != "DateKey"]
    cols.append(F.col("direction_of_travel").alias("DirectionOfTravel"))
    cols += [F.when(loaded, F.col(src).cast(MEASURE_TYPE)).alias(dst) for src, dst in FACT_MEASURES.items()]
    cols += [F.current_timestamp().alias("LoadDate"), F.when(~loaded, F.col(AS_CAME)).alias(AS_CAME), F.col(STATUS),
             F.coalesce("DateKey", "year").cast("int").alias("DateKey")]
    return keyed.select(*cols)


def spread(fact: DataFrame) -> DataFrame:
    """Fact rows as they are written: few large files per year.

    ``REBALANCE`` clusters each year into few tasks, and adaptive execution
    splits any year that is bigger than the advisory partition size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) into several tasks
    from the actual shuffle sizes: a year, or a single count point, holding a
    third of all rows is written by many tasks.  No sampling pass is needed
    (unlike a range partitioning), so the clean + key lookup upstream runs
    once.  Inside each file rows are sorted by count point, so row-group
    min/max statistics prune point lookups."""
    return fact.hint("rebalance", STATUS, "DateKey").sortWithinPartitions(STATUS, "DateKey", "CountPointKey")


# --------------------------------------------------------------------------
# Warehouse object
# --------------------------------------------------------------------------

class Warehouse:
    """One snapshot of the tables under a base folder."""

    def __init__(self, spark: SparkSession, base: str, snapshot: Snapshot | None = None):
        self.spark = spark
        self.store = Snapshots(spark, base)
        self.snapshot = snapshot or Snapshot()
        self._fact_filter = None
        self._schemas: dict[str, T.StructType] = {}

    @property
    def manifest(self) -> dict[str, int]:
        """Rows of each table."""
        out = {name: self.snapshot.rows(name) for name in self.snapshot.parts if name != FACT}
        return out | {FACT: self.snapshot.rows(FACT, status=LOADED)}

    def table(self, name: str) -> DataFrame:
        """A table of this snapshot; the fact by its declared schema, which also reads one without any rows."""
        if name == FACT:
            return self.store.read(FACT, self.snapshot.of(FACT, status=LOADED), FACT_SCHEMA)
        if name == REJECTED:
            return self.rejected()
        return self.store.read(name, self.snapshot.of(name), self._schema(name))

    def _schema(self, name: str) -> T.StructType:
        if name not in self._schemas:
            first = self.store.path(self.snapshot.of(name)[0].folder)
            self._schemas[name] = self.spark.read.parquet(first).schema
        return self._schemas[name]

    def rejected(self) -> DataFrame:
        """The rows that were set apart, as they came, with the reason (``status``) and the year."""
        parts = [p for p in self.snapshot.of(FACT) if p.values[STATUS] != LOADED]
        if not parts:
            return self.spark.createDataFrame([], "status string, DateKey int")
        whole = self.spark.read.parquet(self.store.path(parts[0].folder)).schema
        kept = T.StructType([whole[AS_CAME], T.StructField(STATUS, T.StringType()), T.StructField("DateKey", T.IntegerType())])
        return self.store.read(FACT, parts, kept).select(STATUS, "DateKey", f"{AS_CAME}.*")

    def with_new_fact(self, base: str) -> "Warehouse":
        """Same dimensions, but an empty fact, in a warehouse of its own under ``base``."""
        parts = {name: [Part(self.store.path(p.folder), p.rows, p.values) for p in ps]
                 for name, ps in self.snapshot.parts.items() if name != FACT}
        view = Warehouse(self.spark, base)
        view.commit(parts, {"attempted": []})
        return view

    def has(self, name: str) -> bool:
        return name in self.snapshot.parts

    def broadcastable(self, name: str) -> bool:
        """Whether the manifest proves the dimension small enough to broadcast."""
        rows = self.manifest.get(name)
        return rows is not None and rows <= BROADCAST_MAX_ROWS and \
            rows * row_bytes(self.table(name)) <= BROADCAST_MAX_BYTES

    def fact_years(self) -> list[int] | None:
        """Years of the fact, from the snapshot; None for a filtered view, which must be read."""
        if self._fact_filter is not None:
            return None
        return sorted({p.values["DateKey"] for p in self.snapshot.of(FACT, status=LOADED) if p.rows})

    def attempted_years(self) -> set[int]:
        """Years that a load has taken on, whether or not any of their rows could be loaded."""
        return set(self.snapshot.notes.get("attempted", []))

    @property
    def fact(self) -> DataFrame:
        f = self.table(FACT)
        return f.where(self._fact_filter) if self._fact_filter is not None else f

    def where_fact(self, condition) -> "Warehouse":
        """A view of this warehouse whose fact is filtered by ``condition``."""
        view = Warehouse(self.spark, self.store.base, self.snapshot)
        view._fact_filter = condition if self._fact_filter is None else (self._fact_filter & condition)
        return view

    def dim(self, name: str, broadcast: bool = True) -> DataFrame:
        df = self.table(name)
        if not broadcast:
            return df
        return bounded_broadcast(df, BROADCAST_MAX_ROWS, self.manifest.get(name))

    def lookups(self):
        return lookups(self.table("DimDate"), self.table("DimRegion"), self.table("DimLocalAuthority"),
                       self.table("DimCountPoint"), self.manifest)

    def commit(self, parts: dict[str, list[Part]], notes: dict) -> None:
        """Makes these parts the tables' contents, from this warehouse's snapshot on; this warehouse then shows them."""
        self.snapshot = self.store.commit(self.snapshot, parts, notes)
        self._schemas = {}


def open_warehouse(spark: SparkSession, base: str, version: int | None = None) -> Warehouse | None:
    """The newest snapshot under ``base``, or an earlier one; None before the first commit."""
    snapshot = Snapshots(spark, base).snapshot(version)
    return Warehouse(spark, base, snapshot) if snapshot.version else None


def write_dimensions(wh: Warehouse, count_points: DataFrame) -> dict[str, list[Part]]:
    """Write the four dimensions and their key registries; the parts to commit.

    Keys that the warehouse's snapshot knows stay.  The independent dimensions
    are separate Spark jobs submitted concurrently (the local authority waits
    for regions)."""
    from concurrent.futures import ThreadPoolExecutor

    out: dict[str, list[Part]] = {}

    def known(name: str) -> DataFrame | None:
        return wh.table(f"Keys{name}") if wh.has(f"Keys{name}") else None

    def store(name: str, keyed: tuple[DataFrame, DataFrame]) -> DataFrame:
        dim, registry = keyed
        out[name] = wh.store.write(name, dim)
        out[f"Keys{name}"] = wh.store.write(f"Keys{name}", registry)
        return wh.store.read(name, out[name], dim.schema)

    def dates():
        out["DimDate"] = wh.store.write("DimDate", dim_date(wh.spark))

    def regions_then_authorities():
        regions = store("DimRegion", dim_region(count_points, known("DimRegion")))
        store("DimLocalAuthority", dim_local_authority(count_points, regions, known("DimLocalAuthority")))

    def points():
        store("DimCountPoint", dim_count_point(count_points, known("DimCountPoint")))

    with ThreadPoolExecutor(max_workers=3) as pool:
        for f in [pool.submit(job) for job in (dates, regions_then_authorities, points)]:
            f.result()
    return out


def build_dimensions(spark: SparkSession, count_points: DataFrame, base: str) -> Warehouse:
    """A refresh of the dimensions with an empty fact, committed."""
    wh = open_warehouse(spark, base) or Warehouse(spark, base)
    wh.commit(write_dimensions(wh, count_points) | {FACT: []}, {"attempted": []})
    return wh


def write_load(wh: Warehouse, raw: DataFrame, maps: dict | None = None, load: str | None = None) -> list[Part]:
    """Clean, attach keys, write loaded and rejected rows in one pass; the fact's parts to commit."""
    maps = maps or wh.lookups()
    unknown = None if wh.broadcastable("DimCountPoint") else unknown_points(raw, maps["cp"])
    keyed = keyed_rows(raw, maps, unknown)
    return wh.store.write(FACT, spread(fact_rows(keyed)), (STATUS, "DateKey"), load)


def load_stats(wh: Warehouse) -> DataFrame:
    """Rows loaded, dropped for a missing key, and rejected for a measure out of range, as the stored files hold them
    (a read of the partition columns and the files' footers)."""
    status = T.StructType([T.StructField(STATUS, T.StringType()), T.StructField("DateKey", T.IntegerType())])
    rows = wh.store.read(FACT, wh.snapshot.of(FACT), status)
    return rows.agg(*[F.count_if(F.col(STATUS) == s).alias(name) for s, name in (
        (LOADED, "loaded_rows"), (NO_KEY, "dropped_rows"), (TOO_LARGE, "over_range_rows"))])


def calendar_years(raw: DataFrame) -> list[int]:
    """The calendar years that a source holds (the partition list of a source partitioned by year)."""
    inside = raw.select(F.col("year").cast("int").alias("y")).where(F.col("y").between(YEAR_MIN, YEAR_MAX))
    return sorted(r[0] for r in inside.distinct().collect())


def build_warehouse(spark: SparkSession, raw: DataFrame, count_points: DataFrame, base: str) -> Warehouse:
    """Full refresh: dimensions, then the fact (clean -> keys -> write), committed together.

    A refresh that fails leaves the old snapshot in use; of two refreshes at
    once one commits and the other raises ``Conflict``."""
    wh = open_warehouse(spark, base) or Warehouse(spark, base)
    dims = write_dimensions(wh, count_points)
    fresh = Warehouse(spark, base, Snapshot(wh.snapshot.version, dims))
    fact = write_load(fresh, raw)
    wh.commit(dims | {FACT: fact}, {"attempted": calendar_years(raw)})
    return wh


# --------------------------------------------------------------------------
# Incremental load (year grain)
# --------------------------------------------------------------------------

def loaded_years(wh: Warehouse) -> DataFrame:
    """Distinct years present in the fact, from the snapshot."""
    years = wh.fact_years()
    if years is None:
        years = [r[0] for r in wh.fact.select("DateKey").distinct().collect()]  # calendar years
    years = wh.spark.createDataFrame([(y,) for y in years], "DateKey int")
    return years.join(wh.dim("DimDate").select("DateKey", "Year"), "DateKey").select("Year")


def years_to_load(wh: Warehouse, raw: DataFrame, target_years=None) -> DataFrame:
    """Requested (or all source) years minus the years already loaded."""
    if target_years:
        wanted = wh.spark.createDataFrame([(int(y),) for y in sorted(target_years)], "Year int")
    else:
        wanted = raw.select(F.col("year").cast("int").alias("Year")).where(F.col("Year").isNotNull()).distinct()
    done = loaded_years(wh)
    return wanted.join(done, "Year", "left_anti")


def incremental_load(wh: Warehouse, raw: DataFrame, target_years=None) -> DataFrame:
    """Load the years not yet taken on; a second run adds nothing.

    Returns the years that were taken on.  Only years of the calendar can ever
    load; a year whose rows were all rejected counts as taken on.  The years go
    into the scan as literals and prune an extract that is partitioned by year."""
    found = calendar_years(raw) if target_years is None else \
        sorted(int(y) for y in target_years if YEAR_MIN <= int(y) <= YEAR_MAX)
    years = [y for y in found if y not in wh.attempted_years()]
    if years:
        parts = write_load(wh, raw.where(F.col("year").isin(years)))
        wh.commit({FACT: wh.snapshot.of(FACT) + parts}, {"attempted": sorted(wh.attempted_years() | set(years))})
    return wh.spark.createDataFrame([(y,) for y in years], "Year int")


def reload_years(wh: Warehouse, raw: DataFrame, years) -> None:
    """Re-load the given years from the extract, replacing exactly those years'
    loaded and rejected rows; other years are untouched.  A year with no valid
    rows becomes empty."""
    wanted = sorted({int(y) for y in years})
    parts = write_load(wh, raw.where(F.col("year").isin(wanted)))
    others = [p for p in wh.snapshot.of(FACT) if p.values["DateKey"] not in wanted]
    wh.commit({FACT: others + parts}, {"attempted": sorted(wh.attempted_years() | set(wanted))})


def compact_years(wh: Warehouse, most: int = 4) -> list[int]:
    """Rewrites the years whose loaded rows stand in more than ``most`` loads (many small appends) as one load each."""
    loads: dict[int, int] = {}
    for p in wh.snapshot.of(FACT, status=LOADED):
        loads[p.values["DateKey"]] = loads.get(p.values["DateKey"], 0) + 1
    years = sorted(y for y, n in loads.items() if n > most)
    if years:
        rows = wh.table(FACT).where(F.col("DateKey").isin(years)).withColumn(STATUS, F.lit(LOADED))
        parts = wh.store.write(FACT, spread(rows), (STATUS, "DateKey"))
        kept = [p for p in wh.snapshot.of(FACT) if p.values[STATUS] != LOADED or p.values["DateKey"] not in years]
        wh.commit({FACT: kept + parts}, {})
    return years


_LOCK = threading.RLock()
_CACHE: dict = {}


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The session's warehouse for ``sf_dir``, built on first use."""
    from ..sources.landing import landing_for

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _LOCK:
        if key not in _CACHE:
            land = landing_for(spark, sf_dir)
            land.prepare(["raw_aadf", "count_points"])
            _CACHE[key] = build_warehouse(
                spark, land.table("raw_aadf"), land.table("count_points"), new_output_dir(spark, "warehouse")
            )
        return _CACHE[key]

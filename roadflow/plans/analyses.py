"""Batch analyses over the raw (uncleaned) extracts.

These follow data-frame-library semantics, not SQL semantics:

* group keys that are NULL drop the row (no NULL group);
* sums are exact decimal sums; sums over no values are 0, not NULL;
* ratios round half to even (``bround``); a zero denominator gives NULL;
* measures are read as numbers exactly as they appear in the extract
  (no clamping, unparsable text is NULL);
* arg-max / top-N ties resolve to the smallest key.

All are single-scan aggregations (partial aggregation before the shuffle).
Pivots work on the aggregated long form, whose few rows also give the column
list: whatever values occur become columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import dbl, hour_label, month_name, parse_exact, road_label
from ..schemas import AM_PEAK_HOURS, ANALYSIS_TYPE, MINOR_CATEGORIES, PM_PEAK_HOURS, RAW_COUNT_MEASURES, VEHICLE_COLS


# --------------------------------------------------------------------------
# helpers
# --------------------------------------------------------------------------

def as_numbers(df: DataFrame, cols=VEHICLE_COLS) -> DataFrame:
    """Measures as exact decimals, as written; text that is not a number, and a number too large for the type, is NULL
    (:mod:`roadflow.plans.extracts` keeps the rows of such numbers).  Decimals stay as they are."""
    types, target = dict(df.dtypes), ANALYSIS_TYPE.simpleString()
    return df.withColumns({c: parse_exact(c, types[c], target) for c in cols
                           if c in types and not types[c].startswith("decimal")})


def keys_present(df: DataFrame, keys) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def psum(c) -> Column:
    """Sum where an empty / all-missing group sums to 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(c), F.lit(0).cast("decimal(1,0)"))


def ratio(num, den, digits: int, scale: float = 100.0) -> Column:
    """``round_half_even(num / den * scale, digits)``, NULL when den is 0."""
    q = F.try_divide(dbl(num), F.nullif(dbl(den), F.lit(0.0)))
    return F.bround(q * F.lit(scale), digits)


def pivot_sums(long: DataFrame, keys: list[str], col: str, value: str) -> tuple[DataFrame, list[str]]:
    """Aggregated ``long`` rows (keys, col, value) with a column per value of
    ``col`` (missing combinations are 0), and the names of these columns.

    ``long`` is written to the shared folder first, so its source is scanned
    once: for the column list and for the pivot."""
    from ..session import materialise

    long = materialise(long, "pivot")
    found = sorted(r[0] for r in long.select(col).distinct().collect())  # the columns of the result
    names = [str(v) for v in found]
    wide = long.groupBy(*keys).pivot(col, found).agg(F.sum(value)) if found else long.select(*keys).distinct()
    return wide.na.fill(0, names) if names else wide, names


# --------------------------------------------------------------------------
# AADF analyses
# --------------------------------------------------------------------------

def estimation_method_by_year(raw: DataFrame) -> DataFrame:
    """Year x estimation-method row counts, total and counted share."""
    base = keys_present(raw, ["year", "estimation_method"])
    long = base.groupBy("year", "estimation_method").agg(F.count(F.lit(1)).alias("n"))
    g, methods = pivot_sums(long, ["year"], "estimation_method", "n")
    g = g.withColumn("total", reduce(lambda a, b: a + b, [F.col(f"`{m}`") for m in methods],
                                     F.lit(0).cast("bigint")))
    if "Counted" in methods:
        g = g.withColumn("counted_pct", ratio("Counted", "total", 2))
    return g.orderBy("year")


def estimation_method_detailed(raw: DataFrame) -> DataFrame:
    return (
        keys_present(raw, ["estimation_method_detailed"])
        .groupBy("estimation_method_detailed").agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "estimation_method_detailed")
    )


def road_category_trends(raw: DataFrame) -> DataFrame:
    df = as_numbers(raw).withColumn("road_label", road_label("road_category"))
    df = keys_present(df, ["year", "road_category", "road_label"])
    g = df.groupBy("year", "road_category", "road_label").agg(
        psum("all_motor_vehicles").alias("total_motor"),
        psum("all_HGVs").alias("total_hgv"),
        psum("pedal_cycles").alias("total_cycles"),
        F.count_distinct("count_point_id").alias("count_points"),
        F.round(F.try_divide(F.sum("all_motor_vehicles").cast("double"),
                             F.count("all_motor_vehicles").cast("double")), 6).alias("avg_flow"),
    )
    return g.withColumn("hgv_pct", ratio("total_hgv", "total_motor", 2)).orderBy("year", "road_category")


HGV_AXLE_COLS = [
    "HGVs_2_rigid_axle", "HGVs_3_rigid_axle", "HGVs_4_or_more_rigid_axle",
    "HGVs_3_or_4_articulated_axle", "HGVs_5_articulated_axle", "HGVs_6_articulated_axle",
]


def axle_short_name(col: str) -> str:
    return col.replace("HGVs_", "").replace("_axle", "")


def hgv_axle_trends(raw: DataFrame) -> DataFrame:
    df = keys_present(as_numbers(raw), ["year"])
    g = df.groupBy("year").agg(*[psum(c).alias(c) for c in HGV_AXLE_COLS + ["all_HGVs"]])
    return g.withColumns(
        {f"{axle_short_name(c)}_pct": ratio(c, "all_HGVs", 2) for c in HGV_AXLE_COLS}
    ).orderBy("year")


def vehicle_mode_trends(raw: DataFrame) -> DataFrame:
    df = keys_present(as_numbers(raw), ["year"])
    g = df.groupBy("year").agg(
        psum("two_wheeled_motor_vehicles").alias("motorcycles"),
        psum("buses_and_coaches").alias("buses"),
        psum("cars_and_taxis").alias("cars"),
        psum("LGVs").alias("lgvs"),
        psum("pedal_cycles").alias("cycles"),
        psum("all_motor_vehicles").alias("all_motor"),
    )
    pcts = {f"{c}_pct": ratio(c, "all_motor", 3) for c in ["motorcycles", "buses", "cars", "lgvs"]}
    pcts["cycles_pct"] = ratio("cycles", F.col("all_motor") + F.col("cycles"), 3)
    return g.withColumns(pcts).orderBy("year")


def count_point_coverage(points: DataFrame) -> DataFrame:
    g = keys_present(points, ["region_name", "road_category"]).groupBy("region_name", "road_category").agg(
        F.count_distinct("count_point_id").alias("num_points"),
        psum("link_length_km").alias("total_link_km"),
    )
    return g.withColumn("points_per_100km", ratio("num_points", "total_link_km", 2)).orderBy(
        F.asc_nulls_last("points_per_100km"), "region_name", "road_category")


def region_coverage_density(points: DataFrame) -> DataFrame:
    g = keys_present(points, ["region_name"]).groupBy("region_name").agg(
        F.count_distinct("count_point_id").alias("num_points"),
        psum("link_length_km").alias("total_link_km"),
    )
    return g.withColumn("density", ratio("num_points", "total_link_km", 4, scale=1.0)).orderBy(
        F.asc_nulls_last("density"), "region_name")


DIRS = ["E", "N", "S", "W"]


def directional_imbalance_pivot(raw: DataFrame, year: int = 2023, n: int = 50) -> DataFrame:
    """Per point, year and road: flow per direction (missing = 0), max, min
    and max / (min, or 1 when min is 0); top ``n`` of ``year``.

    Every non-'C' direction value of any year becomes a column (invalid
    values such as 'X' included, as in the source pivot), and N, S, E and W
    always do; max and min run over those of N/S/E/W that occur in the
    extract.  The distinct directions come from one combined aggregate."""
    keys = ["count_point_id", "year", "road_name"]
    directed = keys_present(as_numbers(raw, ["all_motor_vehicles"]), keys + ["direction_of_travel"]).where(
        F.col("direction_of_travel") != "C")
    found = {r[0] for r in directed.select("direction_of_travel").distinct().collect()}  # the columns of the result
    columns = sorted(found | set(DIRS))
    present = [d for d in DIRS if d in found]
    if len(present) < 2:
        present = DIRS
    flow = F.col("all_motor_vehicles")
    piv = directed.where(F.col("year") == year).groupBy(*keys).agg(
        *[psum(F.when(F.col("direction_of_travel") == d, flow)).alias(d) for d in columns])
    piv = piv.withColumns({"max_dir": F.greatest(*map(F.col, present)), "min_dir": F.least(*map(F.col, present))})
    piv = piv.withColumn("imbalance_ratio", F.bround(
        dbl("max_dir") / F.when(F.col("min_dir") == 0, F.lit(1.0)).otherwise(dbl("min_dir")), 2))
    # One direction alone has no imbalance: same columns, no rows.
    return piv.orderBy(F.desc_nulls_last("imbalance_ratio"), *keys).limit(n if len(found & set(DIRS)) > 1 else 0)


def road_utilization_top100(raw: DataFrame, year: int = 2023, n: int = 100) -> DataFrame:
    keys = ["count_point_id", "road_name", "road_category", "region_name", "link_length_km"]
    df = keys_present(as_numbers(raw, ["all_motor_vehicles"]).where(F.col("year") == year), keys)
    g = df.groupBy(*keys).agg(psum("all_motor_vehicles").alias("all_motor_vehicles"))
    g = g.withColumn(
        "flow_per_km",
        F.bround(F.try_divide(dbl("all_motor_vehicles"), F.nullif(dbl("link_length_km"), F.lit(0.0))), 0),
    ).where(F.col("flow_per_km").isNotNull())
    g = g.withColumn("link_length_km", dbl("link_length_km"))
    return g.orderBy(F.desc("flow_per_km"), *keys).limit(n)


def aadf_key_findings(raw: DataFrame, points: DataFrame) -> DataFrame:
    """Headline numbers as (metric, value) rows."""
    cat = F.col("road_category")
    a = raw.agg(
        F.round(F.try_divide(F.count_if(F.col("estimation_method") == "Counted") * F.lit(100.0),
                             F.count(F.lit(1)).cast("double")), 6).alias("counted_pct"),
        F.count_if(cat == "TM").cast("double").alias("tm_rows"),
        F.count_if(cat == "PM").cast("double").alias("pm_rows"),
        F.count_if(cat == "TA").cast("double").alias("ta_rows"),
        F.count_if(cat == "PA").cast("double").alias("pa_rows"),
        F.count_if(cat.isin(MINOR_CATEGORIES)).cast("double").alias("minor_rows"),
    ).withColumn("estimated_pct", F.round(F.lit(100.0) - F.col("counted_pct"), 6))
    b = points.agg(
        F.count_distinct("count_point_id").cast("double").alias("unique_count_points"),
        F.count_distinct("region_name").cast("double").alias("regions"),
    )
    la = a.unpivot([], a.columns, "metric", "value")
    lb = b.unpivot([], b.columns, "metric", "value")
    return la.unionByName(lb)


# --------------------------------------------------------------------------
# Raw hourly counts
# --------------------------------------------------------------------------

def _sums(df: DataFrame, keys, cols=RAW_COUNT_MEASURES) -> DataFrame:
    return keys_present(df, keys).groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in cols])


def peak_hour_pattern(counts: DataFrame) -> DataFrame:
    return _sums(counts, ["hour"]).withColumn("hour_label", hour_label("hour")).orderBy("hour")


def peak_period_share(counts: DataFrame) -> DataFrame:
    mv, h = F.col("all_motor_vehicles"), F.col("hour")
    total = F.sum(mv).cast("double")

    def share(hours):
        return F.round(F.try_divide(F.sum(F.when(h.isin(hours), mv)).cast("double") * F.lit(100.0), total), 6)

    return keys_present(counts, ["hour"]).agg(
        share(AM_PEAK_HOURS).alias("am_peak_pct"), share(PM_PEAK_HOURS).alias("pm_peak_pct"))


def with_calendar(counts: DataFrame) -> DataFrame:
    d = F.col("count_date")
    return counts.withColumns({
        "day_of_week": F.weekday(d),
        "day_name": F.date_format(d, "EEEE"),
        "month": F.month(d),
        "is_weekend": F.weekday(d).isin(5, 6).cast("int"),
    })


def day_of_week_pattern(counts: DataFrame) -> DataFrame:
    return _sums(with_calendar(counts), ["day_of_week", "day_name"]).orderBy("day_of_week")


def weekend_split(counts: DataFrame) -> DataFrame:
    return _sums(with_calendar(counts), ["is_weekend"]).orderBy("is_weekend")


def seasonal_pattern(counts: DataFrame) -> DataFrame:
    return _sums(with_calendar(counts), ["month"]).withColumn("month_name", month_name("month")).orderBy("month")


def _hour_matrix(counts: DataFrame, row_key: str) -> DataFrame:
    """A row per ``row_key``, a column per hour that occurs, whatever its number."""
    long = keys_present(counts, [row_key, "hour"]).groupBy(row_key, "hour").agg(
        F.sum("all_motor_vehicles").cast("bigint").alias("n"))
    return pivot_sums(long, [row_key], "hour", "n")[0].orderBy(row_key)


def year_hour_heatmap(counts: DataFrame) -> DataFrame:
    return _hour_matrix(counts, "year")


def road_category_hourly(counts: DataFrame) -> DataFrame:
    return _hour_matrix(counts, "road_category")


def raw_key_findings(counts: DataFrame) -> DataFrame:
    """Busiest and quietest hour, day and month: one scan with grouping sets,
    then picks from its few rows (ties resolve to the smallest key)."""
    days = with_calendar(counts)
    sums = days.groupingSets(
        [["hour"], ["day_of_week", "day_name"], ["month"]], "hour", "day_of_week", "day_name", "month").agg(
        F.coalesce(F.sum("all_motor_vehicles"), F.lit(0)).cast("bigint").alias("n"),
        F.grouping("hour").alias("g_hour"), F.grouping("day_of_week").alias("g_day"), F.grouping("month").alias("g_month"))
    kinds = {"hour": ("g_hour", hour_label("hour")), "day_of_week": ("g_day", F.col("day_name")),
             "month": ("g_month", month_name("month"))}

    def pick(finding: str, key: str, smallest: bool) -> Column:
        flag, label = kinds[key]
        # A key that is NULL although it is grouped belongs to no group here.
        own = (F.col(flag) == 0) & F.col(key).isNotNull()
        place = F.struct(F.col("n") if smallest else -F.col("n"), F.col(key))
        best = F.min_by(F.struct(label.alias("label"), F.col("n").cast("double").alias("value")), F.when(own, place))
        return F.struct(F.lit(finding).alias("finding"), best.alias("best"))

    found = sums.agg(F.array(
        pick("peak_hour", "hour", False), pick("quietest_hour", "hour", True),
        pick("busiest_day", "day_of_week", False), pick("quietest_day", "day_of_week", True),
        pick("busiest_month", "month", False)).alias("all"))
    return found.select(F.explode("all").alias("f")).select("f.finding", "f.best.label", "f.best.value")


def merge_partial_aggregates(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Combine stored partial aggregates by key (a missing key counts 0)."""
    allc = reduce(DataFrame.unionByName, [p for p in parts])
    vals = [c for c in parts[0].columns if c not in keys]
    return allc.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in vals])


def partial_hourly(counts: DataFrame, first_year: int | None = None, last_year: int | None = None) -> DataFrame:
    """Hourly sums of a range of years; without bounds, of the rows without a year."""
    year = F.col("year")
    if first_year is None and last_year is None:
        return _sums(counts.where(year.isNull()), ["hour"])
    df = counts if first_year is None else counts.where(year >= first_year)
    return _sums(df if last_year is None else df.where(year <= last_year), ["hour"])

"""Data-quality checks, reconciliation and profiling.

Each check is one distributed aggregate whose result is a handful of rows;
the report collects only those tiny results.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import pct
from ..schemas import MIN_EXPECTED_ROWS
from .analyses import as_numbers, keys_present, psum
from ..sources.files import folder_names
from .warehouse import DIMS, FACT, Warehouse


def dq_row_counts(wh: Warehouse) -> DataFrame:
    """Rows per table against the accepted minimum; low tables WARN."""
    spark = wh.spark
    parts = [wh.table(t).agg(F.count(F.lit(1)).alias("RowCount")).select(F.lit(t).alias("TableName"), "RowCount")
             for t in DIMS + [FACT]]
    counts = reduce(DataFrame.unionByName, parts)
    mins = spark.createDataFrame(list(MIN_EXPECTED_ROWS.items()), "TableName string, MinExpected bigint")
    return counts.join(F.broadcast(mins), "TableName", "left").withColumn(
        "Status", F.when(F.col("RowCount") < F.coalesce(F.col("MinExpected"), F.lit(0)), "WARN").otherwise("PASS"))


def dq_null_check(wh: Warehouse) -> DataFrame:
    """Nulls per column, and as a percentage of all rows."""
    f = wh.fact
    nulls = {
        "NullDateKey": "DateKey", "NullCountPointKey": "CountPointKey", "NullRegionKey": "RegionKey",
        "NullLAKey": "LocalAuthorityKey", "NullDirection": "DirectionOfTravel",
        "NullMotorVehicles": "AllMotorVehicles",
    }
    counts = f.agg(*[F.count_if(F.col(c).isNull()).alias(a) for a, c in nulls.items()],
                   F.count(F.lit(1)).alias("TotalRows"))
    return counts.withColumns({f"{a}Pct": pct(a, "TotalRows") for a in nulls})


def dq_negative_values(wh: Warehouse) -> DataFrame:
    f = wh.fact
    neg = {"NegMotor": "AllMotorVehicles", "NegHGV": "AllHGVs", "NegCars": "CarsAndTaxis",
           "NegCycles": "PedalCycles"}
    out = f.agg(*[F.count_if(F.col(c) < 0).alias(a) for a, c in neg.items()], F.count(F.lit(1)).alias("TotalRows"))
    any_neg = reduce(lambda a, b: a | b, [F.col(a) > 0 for a in neg])
    return out.withColumn("Status", F.when(any_neg, "FAIL").otherwise("PASS"))


def dq_orphan_facts(wh: Warehouse) -> DataFrame:
    """Fact rows whose key has no dimension row (left joins + null probes).
    The local-authority key is checked as well.  With broadcastable
    dimensions the probes run in the scan's tasks and one row per task is
    shuffled; otherwise fact rows are first counted per key combination, so
    the shuffled probes run once per combination."""
    keys = ["DateKey", "CountPointKey", "RegionKey", "LocalAuthorityKey"]
    if all(wh.broadcastable(d) for d in DIMS):
        f = wh.fact.select(*keys, F.lit(1).cast("bigint").alias("_n"))
    else:
        f = wh.fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    probes = [("DateKey", "DimDate", "OrphanDate"), ("CountPointKey", "DimCountPoint", "OrphanCP"),
              ("RegionKey", "DimRegion", "OrphanRegion"), ("LocalAuthorityKey", "DimLocalAuthority", "OrphanLA")]
    for key, dim, flag in probes:
        d = wh.dim(dim).select(key).distinct().withColumn(flag, F.lit(False))
        f = f.join(d, key, "left")
    n = F.col("_n")
    return f.agg(*[F.coalesce(F.sum(F.when(F.col(flag).isNull(), n)), F.lit(0)).alias(flag)
                   for _, _, flag in probes],
                 F.coalesce(F.sum(n), F.lit(0)).alias("TotalRows"))


def dq_year_coverage(wh: Warehouse) -> DataFrame:
    f = wh.fact.select("DateKey").join(wh.dim("DimDate").select("DateKey", "Year"), "DateKey")
    return f.groupBy("Year").agg(F.count(F.lit(1)).alias("FactRows")).orderBy("Year")


def dq_direction_distribution(wh: Warehouse) -> DataFrame:
    return wh.fact.groupBy("DirectionOfTravel").agg(F.count(F.lit(1)).alias("Cnt")).orderBy(
        F.desc("Cnt"), "DirectionOfTravel")


CHECKS = {
    "row_counts": dq_row_counts,
    "null_check_fact": dq_null_check,
    "negative_values": dq_negative_values,
    "orphan_facts": dq_orphan_facts,
    "year_coverage": dq_year_coverage,
    "direction_distribution": dq_direction_distribution,
}


def dq_report(wh: Warehouse, checks: dict | None = None) -> DataFrame:
    """``(check, status, detail)`` for every check, plus a WARN row per
    table under its minimum.  Only low row counts WARN and only negative
    values FAIL; a check that raises is reported as ERROR and the others
    still run.  ``detail`` is the check's result as JSON records (in the
    order of their first column), the whole error text, or
    ``"<rows> < <minimum>"`` for a WARN row.

    The checks are independent Spark jobs and are submitted concurrently;
    each returns a handful of rows."""
    from concurrent.futures import ThreadPoolExecutor

    checks = checks or CHECKS

    def run(item):
        name, fn = item
        try:
            return name, fn(wh).collect(), None
        except Exception as e:  # noqa: BLE001
            return name, None, f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(max_workers=max(1, len(checks))) as pool:
        results = list(pool.map(run, checks.items()))

    rows = []
    for name, result, error in results:
        if error is not None:
            rows.append((name, "ERROR", error))
            continue
        status = "PASS"
        if name == "negative_values" and result and result[0]["Status"] == "FAIL":
            status = "FAIL"
        records = sorted((r.asDict() for r in result), key=lambda r: str(next(iter(r.values()))))
        rows.append((name, status, json.dumps(records, separators=(",", ":"))))
        if name == "row_counts":
            for r in result:
                if r["Status"] == "WARN":
                    rows.append((f"row_count_{r['TableName']}", "WARN", f"{r['RowCount']} < {r['MinExpected']}"))
    return wh.spark.createDataFrame(rows, "check string, status string, detail string")


def dq_status_totals(report: DataFrame) -> DataFrame:
    """PASS / WARN / FAIL counts (ERROR counts as FAIL)."""
    s = F.col("status")
    return report.agg(
        F.count_if(s == "PASS").alias("passed"), F.count_if(s == "WARN").alias("warned"),
        F.count_if(s.isin("FAIL", "ERROR")).alias("failed"))


# --------------------------------------------------------------------------
# Reconciliation between datasets
# --------------------------------------------------------------------------

def reconcile_direction_sums(direction_rows: DataFrame, full: DataFrame) -> DataFrame:
    """Do the direction rows, summed per (point, year), equal the
    all-directions dataset?  Inner join on the composite key."""
    d = as_numbers(direction_rows, ["all_motor_vehicles"])
    summed = keys_present(d, ["count_point_id", "year"]).groupBy("count_point_id", "year").agg(
        psum("all_motor_vehicles").alias("mv_summed"))  # decimals: equality is exact
    f = as_numbers(full, ["all_motor_vehicles"]).select(
        "count_point_id", "year", F.col("all_motor_vehicles").alias("mv_full"))
    merged = summed.join(f, ["count_point_id", "year"], "inner")
    m = merged.agg(F.count_if(F.col("mv_summed") == F.col("mv_full")).alias("matching_rows"),
                   F.count(F.lit(1)).alias("merged_rows"))
    total = full.agg(F.count(F.lit(1)).alias("total_full"))
    # two one-row aggregates combined without a cartesian product
    return m.unionByName(total, allowMissingColumns=True).agg(
        F.max("matching_rows").alias("matching_rows"), F.max("merged_rows").alias("merged_rows"),
        F.max("total_full").alias("total_full"))


def reconcile_subset(sample: DataFrame, full: DataFrame) -> DataFrame:
    """Is every (point, year) of the sample in the full set?  Value counts
    of a left-join match indicator.  A sample row matching k full rows
    counts k times (left-join semantics), computed from per-key counts of
    the full set, so no row pairs are ever materialised."""
    keys = ["count_point_id", "year"]
    right = full.groupBy(*keys).agg(F.count(F.lit(1)).alias("_k"))
    j = sample.select(*keys).join(right, keys, "left")
    rows = F.coalesce(F.col("_k"), F.lit(1))
    return j.groupBy(F.when(F.col("_k").isNotNull(), "both").otherwise("left_only").alias("_merge")).agg(
        F.sum(rows).cast("bigint").alias("count")).orderBy(F.desc("count"))


def reconcile_id_overlap(sample: DataFrame, full: DataFrame) -> DataFrame:
    a = sample.select("count_point_id").where(F.col("count_point_id").isNotNull()).distinct()
    b = full.select("count_point_id").where(F.col("count_point_id").isNotNull()).distinct()
    shared = a.intersect(b).agg(F.count(F.lit(1)).alias("shared_ids"))
    total = a.agg(F.count(F.lit(1)).alias("sample_ids"))
    return shared.unionByName(total, allowMissingColumns=True).agg(
        F.max("shared_ids").alias("shared_ids"), F.max("sample_ids").alias("sample_ids"))


# --------------------------------------------------------------------------
# Profiling
# --------------------------------------------------------------------------

def profile_table(df: DataFrame, name: str) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs.append(F.min("year").cast("int").alias("min_year") if "year" in df.columns else F.lit(None).cast("int").alias("min_year"))
    aggs.append(F.max("year").cast("int").alias("max_year") if "year" in df.columns else F.lit(None).cast("int").alias("max_year"))
    aggs.append(F.count_distinct("count_point_id").alias("distinct_points") if "count_point_id" in df.columns
                else F.lit(None).cast("bigint").alias("distinct_points"))
    return df.agg(*aggs).select(
        F.lit(name).alias("file"), F.lit("OK").alias("status"), "rows",
        F.lit(len(df.columns)).alias("columns"), F.lit(", ".join(df.columns)).alias("column_names"),
        "min_year", "max_year", "distinct_points")


def profile_files(spark: SparkSession, paths: dict) -> DataFrame:
    """One profile row per input (CSV with a header if its name ends in
    ``csv``, else Parquet): rows, columns, names, year range, distinct points.
    Absent inputs are MISSING.  Each input's one-row aggregate runs on its own
    (concurrently), so an unreadable one is an ERROR row with the whole error
    text and the others are still profiled."""
    from concurrent.futures import ThreadPoolExecutor

    schema = ("file string, status string, rows bigint, columns int, column_names string, "
              "min_year int, max_year int, distinct_points bigint")

    def profile(item):
        name, path = item
        if folder_names(spark, path) is None:
            return (name, "MISSING", None, None, None, None, None, None)
        try:
            if path.rstrip("/").endswith("csv"):
                df = spark.read.option("header", True).csv(path)
                df = df.withColumns({c: F.col(c).try_cast("double").cast("int") for c in ["year"] if c in df.columns})
            else:
                df = spark.read.parquet(path)
            return tuple(profile_table(df, name).first())
        except Exception as e:  # noqa: BLE001
            return (name, "ERROR", None, None, str(e), None, None, None)

    with ThreadPoolExecutor(max_workers=max(1, len(paths))) as pool:
        return spark.createDataFrame(list(pool.map(profile, paths.items())), schema)


def profile_extract(raw: DataFrame, year: int = 2025) -> DataFrame:
    return raw.agg(
        F.count(F.lit(1)).alias("rows"), F.min("year").alias("min_year"), F.max("year").alias("max_year"),
        F.coalesce(F.bool_or(F.col("year") == year), F.lit(False)).alias(f"has_{year}"))


def profile_direction_counts(raw: DataFrame) -> DataFrame:
    return keys_present(raw, ["direction_of_travel"]).groupBy("direction_of_travel").agg(
        F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "direction_of_travel")


def compare_datasets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Same column list?  Same row count?"""
    lc = left.agg(F.count(F.lit(1)).alias("left_rows"))
    rc = right.agg(F.count(F.lit(1)).alias("right_rows"))
    both = lc.unionByName(rc, allowMissingColumns=True).agg(
        F.max("left_rows").alias("left_rows"), F.max("right_rows").alias("right_rows"))
    return both.select(
        F.lit(len(left.columns)).alias("left_columns"), F.lit(len(right.columns)).alias("right_columns"),
        F.lit(list(left.columns) == list(right.columns)).alias("same_columns"),
        "left_rows", "right_rows", (F.col("left_rows") == F.col("right_rows")).alias("same_rows"))


def count_points_profile(points: DataFrame) -> DataFrame:
    return points.agg(
        F.count_distinct("count_point_id").alias("unique_count_points"), F.count(F.lit(1)).alias("total_rows"),
        F.min("year").alias("min_year"), F.max("year").alias("max_year"))

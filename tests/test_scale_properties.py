"""Plan-level guarantees the scale design relies on."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from roadflow.plans import warehouse as whm
from roadflow.plans.snapshots import Snapshots
from roadflow.registry import queries
from roadflow.session import new_output_dir

from .conftest import SMALL_SF

SKIP = {"etl_incremental_load", "etl_dim_keys_stable", "stream_pages_ingest", "export_reports", "dq_report", "dq_status_totals",
        "profile_files"}
QUERIES = queries()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_pairwise_or_python_operators(spark, name):
    plan = QUERIES[name](spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString()
    for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert op not in plan, f"{name}: {op}"


def test_hot_year_is_spread_over_writers(spark):
    # every row in one year: the year must still be split over many writers
    rows = spark.range(0, 200000).select(
        F.lit("loaded").alias("status"), F.lit(2023).alias("DateKey"), (F.col("id") % 7).cast("int").alias("CountPointKey"),
        (F.col("id") % 5).cast("decimal(18,2)").alias("AllMotorVehicles"))
    store = Snapshots(spark, new_output_dir(spark, "hot-year"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "16k")  # stands in for "one year is far larger than a task"
    try:
        parts = store.write("fact", whm.spread(rows), ("status", "DateKey"))
    finally:
        spark.conf.set(key, old)
    assert [(p.rows, p.values) for p in parts] == [(200000, {"status": "loaded", "DateKey": 2023})]
    files = glob.glob(os.path.join(store.path(parts[0].folder).replace("file:", ""), "*.parquet"))
    assert len(files) >= 4


def test_dense_keys_never_use_a_global_window(spark):
    from roadflow.operators.keys import with_dense_key

    df = spark.range(0, 1000).withColumnRenamed("id", "v")
    plan = with_dense_key(df, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    # rows come from the checkpointed, range-partitioned copy; the only
    # unpartitioned window runs over the per-partition count table
    assert "ExistingRDD" in plan
    window_inputs = [line for line in plan.splitlines() if "Window [" in line]
    assert all("_kn" in line for line in window_inputs)


def test_results_with_a_row_per_point_are_not_written_by_one_task(spark, monkeypatch, tmp_path):
    from roadflow.plans import exports

    single = {}
    monkeypatch.setattr(exports, "write_csv", lambda df, path, single_file: single.update({path: single_file}))
    names = ["geospatial_hotspots", "serving/geospatial_hotspots", "serving/yearly_totals"]
    exports.write_results({n: lambda: spark.range(1) for n in names}, str(tmp_path))
    assert [single[f"{tmp_path}/{n}"] for n in names] == [False, False, True]


def _tables(spark, root):
    """A few lineitems, on points of all kinds: left out, minor, without a length, unknown, and one that stands twice."""
    from decimal import Decimal

    parts = [(1, "STANDARD X", 7), (2, "SMALL X", 7), (3, "MEDIUM X", 10), (210, "PROMO X", 5), (5, None, 3),
             (6, "ECONOMY X", None), (7, "PROMO X", 4), (7, "PROMO X", 4)]
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_size int").write.parquet(f"{root}/part.parquet")
    nations = [(i, f"NATION {i}", i % 5) for i in range(25)]
    spark.createDataFrame(nations, "n_nationkey long, n_name string, n_regionkey long").write.parquet(
        f"{root}/nation.parquet")
    spark.createDataFrame([(i, f"REGION {i}") for i in range(5)], "r_regionkey long, r_name string").write.parquet(
        f"{root}/region.parquet")
    lines = [(key, part, 1, Decimal(key), "R", "F", "1996-01-02")
             for key in (1, 139, 278) for part in (1, 2, 3, 4, 5, 6, 7, 210)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity decimal(15,2), l_returnflag string, "
        "l_linestatus string, l_shipdate string").selectExpr(
        "* except (l_shipdate)", "cast(l_shipdate as date) l_shipdate").write.parquet(f"{root}/lineitem.parquet")
    return str(root)


def test_extract_rows_are_dealt_out_narrow_and_state_their_points(spark, tmp_path):
    from roadflow.sources import standin

    sf = _tables(spark, tmp_path)
    moved = standin.aadf_rows(spark, sf).columns
    assert not {"road_name", "latitude", "longitude", "link_length_km", "n_name"} & set(moved)
    points = {r["count_point_id"]: r for r in standin.point_attributes(spark, sf).collect()}
    seen = standin.raw_aadf(spark, sf, by="year").collect()
    assert len(seen) == 27  # a point that stands twice doubles its rows
    for r in seen:
        p = points.get(r["count_point_id"])
        half = 0.5 if int(r["cars_and_taxis"]) >= 400 * 139 else 0
        if p is None:
            assert (r["road_name"], r["road_category"], r["latitude"], r["longitude"], r["link_length_km"]) == (None,) * 5
            continue
        assert (r["road_name"], r["road_category"], r["link_length_km"]) == (
            p["road_name"], p["road_category"], p["link_length_km"])
        assert float(r["latitude"]) == float(p["latitude"]) + half
        assert float(r["longitude"]) == float(p["longitude"]) - half


def test_part_join_does_not_sort_the_line_items(spark, tmp_path):
    from roadflow.sources import standin

    sf = _tables(spark, tmp_path)
    for df in (standin.aadf_rows(spark, sf), standin.raw_counts(spark, sf)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_landed_rows_of_a_part_stand_together(spark, tmp_path):
    from roadflow.sources import standin

    sf = _tables(spark, tmp_path)
    seen = [r[0] for r in standin.raw_aadf(spark, sf, by="year").coalesce(1).select("count_point_id").collect()]
    assert len(seen) == 27 and seen == sorted(seen)


def test_traits_are_one_column_and_come_back_whole(spark, tmp_path):
    from roadflow.sources import standin

    rows = standin.aadf_rows(spark, _tables(spark, tmp_path))
    assert "_traits" in rows.columns and not {"road_category", "_counted", "_nation"} & set(rows.columns)
    cases = [(n, c, k) for n in (1, 25, 10_000) for c in (None, *standin.CATEGORIES) for k in (True, False, None)]
    df = spark.createDataFrame(cases, "n int, c string, k boolean").withColumn(
        "t", standin._traits(F.col("n"), F.col("c"), F.col("k")))
    t = F.col("t")
    for r in df.select("n", "c", "k", standin._nation_of(t).alias("n2"), standin._category_of(t).alias("c2"),
                       standin._counted(t).alias("k2")).collect():
        assert (r["n2"], r["c2"], r["k2"]) == (r["n"], r["c"], r["k"] is True)


def test_over_range_test_is_parsed_once_for_all_measures(spark):
    from roadflow.functions.exprs import over_range
    from roadflow.operators.clean import any_over_range
    from roadflow.schemas import VEHICLE_COLS

    kind = "decimal(18,2)"
    texts = ["1", "12345678901234567890", "-12345678901234567890", "1e20", "1E3", " 99999999999999999999 ", "", None,
             "abcdefghijklmnopqrst", "nan", "1e400", "9999999999999999.999", "123456789012345.5", "Infinity"]
    first, last = VEHICLE_COLS[0], VEHICLE_COLS[-1]
    rows = [(t, "7") for t in texts] + [(None, t) for t in texts]
    df = spark.createDataFrame(rows, f"{first} string, {last} string")
    each = F.lit(False)
    for c in (first, last):
        each = each | over_range(c, "string", kind)
    got = df.select(any_over_range(df, kind).alias("any"), each.alias("each")).collect()
    assert [r["any"] for r in got] == [r["each"] for r in got] and sum(r["any"] for r in got) == 10
    wide = spark.createDataFrame([], ", ".join(f"{c} string" for c in VEHICLE_COLS))
    plan = wide.select(any_over_range(wide, kind).alias("any"))._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count(kind) <= 2

"""Batch ETL over delivered CSV extracts."""

from roadflow.plans.etl import run_etl
from roadflow.plans.warehouse import open_warehouse, warehouse_for
from roadflow.session import new_output_dir
from roadflow.sources.landing import landing_for

from .conftest import SMALL_SF


def test_full_then_incremental_from_csv(spark):
    land = landing_for(spark, SMALL_SF)
    aadf, points = land.csv_path("raw_aadf"), land.csv_path("count_points")
    root = new_output_dir(spark, "etl")
    out = new_output_dir(spark, "etl-reports")
    steps = {r.step: r for r in run_etl(spark, aadf, points, root, reports_dir=out).collect()}
    assert steps["load"].status == "OK"
    assert steps["dq:negative_values"].status == "PASS"
    assert all(s.status == "OK" for k, s in steps.items() if k.startswith("export:"))
    fact_rows = open_warehouse(spark, root).fact.count()
    assert fact_rows == warehouse_for(spark, SMALL_SF).fact.count()

    # a second, incremental run finds every year loaded and appends nothing
    steps = {r.step: r for r in run_etl(spark, aadf, points, root, incremental=True).collect()}
    assert steps["load"].detail.endswith("[]")  # 1990 is no calendar year and is never attempted
    assert open_warehouse(spark, root).fact.count() == fact_rows


def test_full_refresh_from_pages(spark):
    land = landing_for(spark, SMALL_SF)
    root = new_output_dir(spark, "etl-pages")
    steps = {r.step: r for r in run_etl(spark, land.pages_path(), land.csv_path("count_points"), root).collect()}
    assert steps["extract:aadf"].status == "OK"
    assert open_warehouse(spark, root).fact.count() == warehouse_for(spark, SMALL_SF).fact.count()


def test_failed_refresh_leaves_the_old_version_in_use(spark, monkeypatch):
    from roadflow.plans import reports
    from roadflow.plans import warehouse as whm

    land = landing_for(spark, SMALL_SF)
    raw, points = land.table("raw_aadf"), land.table("count_points")
    base = new_output_dir(spark, "refresh")
    assert open_warehouse(spark, base) is None
    whm.build_warehouse(spark, raw, points, base)
    before = sorted(map(tuple, reports.top_roads(open_warehouse(spark, base), 2023, 50).collect()))

    def fail(*args, **kwargs):
        raise RuntimeError("load failed")

    monkeypatch.setattr(whm, "write_load", fail)
    changed = points.where("count_point_id % 2 = 0")  # other points, so other surrogate keys
    try:
        whm.build_warehouse(spark, raw, changed, base)
        raise AssertionError("the refresh must fail")
    except RuntimeError:
        pass
    assert whm.open_warehouse(spark, base).snapshot.version == 1
    assert sorted(map(tuple, reports.top_roads(open_warehouse(spark, base), 2023, 50).collect())) == before
    monkeypatch.undo()
    whm.build_warehouse(spark, raw, changed, base)
    assert open_warehouse(spark, base).snapshot.version == 2
    assert open_warehouse(spark, base).manifest["DimCountPoint"] < warehouse_for(spark, SMALL_SF).manifest["DimCountPoint"]
    assert sorted(map(tuple, reports.top_roads(open_warehouse(spark, base, 1), 2023, 50).collect())) == before


def test_over_range_rows_are_set_apart(spark):
    from roadflow.plans import warehouse as whm

    raw = landing_for(spark, SMALL_SF).table("raw_aadf")
    wh = warehouse_for(spark, SMALL_SF).with_new_fact(new_output_dir(spark, "reject"))
    some = raw.where("year between 2015 and 2019").limit(20)
    from pyspark.sql import functions as F

    big = some.withColumn("LGVs", F.lit("99999999999999999999"))
    taken = [r.Year for r in whm.incremental_load(wh, big).collect()]
    rejected = wh.rejected()
    assert wh.fact.count() == 0 and rejected.count() > 0
    assert {r["LGVs"] for r in rejected.where("status = 'over_range'").collect()} == {"99999999999999999999"}
    # the years count as taken on: a second run adds no rejected rows
    assert taken and whm.incremental_load(wh, big).count() == 0
    assert wh.rejected().count() == rejected.count()
    # and reloading a year replaces its rejected rows
    whm.reload_years(wh, big, taken)
    assert wh.rejected().count() == rejected.count()


def test_reload_replaces_only_given_years(spark):
    from pyspark.sql import functions as F

    from roadflow.plans import warehouse as whm

    land = landing_for(spark, SMALL_SF)
    raw = land.table("raw_aadf")
    wh = warehouse_for(spark, SMALL_SF).with_new_fact(new_output_dir(spark, "reload"))
    whm.incremental_load(wh, raw)
    before = {r.DateKey: r["count"] for r in wh.fact.groupBy("DateKey").count().collect()}
    # reload 2023 from an extract holding only half of that year's rows
    half = raw.where((F.col("year") != 2023) | (F.col("count_point_id") % 2 == 0))
    whm.reload_years(wh, half, [2023])
    after = {r.DateKey: r["count"] for r in wh.fact.groupBy("DateKey").count().collect()}
    assert {k: v for k, v in after.items() if k != 2023} == {k: v for k, v in before.items() if k != 2023}
    assert 0 < after[2023] < before[2023]

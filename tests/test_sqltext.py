"""SQL text with bound values over one snapshot."""

import pytest
from pyspark.sql import functions as F

from roadflow.plans import reports
from roadflow.plans import warehouse as whm
from roadflow.plans.sqltext import STATEMENTS, Catalogue, markers
from roadflow.session import new_output_dir
from roadflow.sources.landing import landing_for

from .conftest import SMALL_SF


@pytest.fixture(scope="module")
def catalogue(spark):
    return Catalogue(whm.warehouse_for(spark, SMALL_SF))


def rows(df):
    return sorted(map(tuple, df.select(*[F.col(c).cast("string") for c in sorted(df.columns)]).collect()))


def test_markers_are_found_outside_quotes_and_comments():
    text = "SELECT ':a', \":b\", `:c`, x::int, 'it''s :d' -- :e\n /* :f */ FROM t WHERE y = :year AND n IN (:n1, :n_2)"
    assert markers(text) == {"year", "n1", "n_2"}


def test_statements_equal_the_reports(spark, catalogue):
    wh = whm.warehouse_for(spark, SMALL_SF)
    for name, args in (("traffic_by_region", {"year": 2022}), ("hotspots", {"year": 2022, "min_traffic": 1000}),
                       ("top_roads", {"year": 2021, "limit": 7}), ("vehicle_mix_by_region", {"year": 2020})):
        want = getattr(reports, name)(wh, **args)
        got = catalogue.run(name, **args).select(*[F.col(c).cast(t) for c, t in want.dtypes])
        assert rows(got) == rows(want) and got.count() > 0


@pytest.mark.parametrize("value", ["' OR '1'='1", "x'; DROP VIEW DimRegion; --", "\\", '"', "a:year", "é\n"])
def test_a_value_is_only_data(catalogue, value):
    text = "SELECT RegionName, :v AS v FROM DimRegion WHERE RegionName <> :v"
    found = catalogue.sql(text, {"v": value}).collect()
    assert len(found) == 5 and {r["v"] for r in found} == {value}
    assert catalogue.sql("SELECT * FROM DimRegion WHERE RegionName = :v", {"v": value}).count() == 0


def test_unbound_and_unknown_values_are_errors(catalogue):
    for text, args in (("SELECT :a", {}), ("SELECT 1", {"a": 1}), ("SELECT ':a'", {"a": 1})):
        with pytest.raises(ValueError, match="marker"):
            catalogue.sql(text, args)
    with pytest.raises(ValueError, match="limit"):
        catalogue.run("top_roads", limit=101)
    with pytest.raises(ValueError, match="takes"):
        catalogue.run("top_roads", yaer=2020)
    assert all(set(s.defaults) == markers(s.text) for s in STATEMENTS.values())


def test_a_bound_year_prunes_the_scan(catalogue):
    plan = catalogue.run("traffic_by_region", year=2019)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DateKey" in plan and "2019" in plan


def test_catalogues_hold_one_snapshot_each_and_leave_nothing_behind(spark):
    land = landing_for(spark, SMALL_SF)
    raw, points = land.table("raw_aadf"), land.table("count_points")
    base = new_output_dir(spark, "sql-versions")
    wh = whm.build_dimensions(spark, points, base)
    empty = Catalogue(whm.open_warehouse(spark, base))
    whm.incremental_load(wh, raw, {2020})
    full = Catalogue(whm.open_warehouse(spark, base))
    count = "SELECT count(*) AS n FROM FactTrafficFlowDirection WHERE DateKey = :y"
    assert empty.sql(count, {"y": 2020}).first()["n"] == 0 < full.sql(count, {"y": 2020}).first()["n"]
    assert (empty.version, full.version) == (1, 2)
    assert not spark.catalog.tableExists("DimRegion")


def test_a_text_is_exported_with_its_values(spark, catalogue):
    path = f"{new_output_dir(spark, 'sql-export')}/out"
    catalogue.export("SELECT RegionName, :note AS note FROM DimRegion", {"note": 'a "b", c'}, path)
    got = spark.read.option("header", True).option("escape", '"').csv(path)
    assert got.columns == ["RegionName", "note"] and got.count() == 5

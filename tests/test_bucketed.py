"""Reports over bucketed copies: no exchange of the fact, same results."""

import contextlib
import re

import pytest

from roadflow.plans import reports
from roadflow.plans import warehouse as whm
from roadflow.plans.bucketed import bucketed

from .conftest import SMALL_SF

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


@contextlib.contextmanager
def broadcasts_off(spark):
    old = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "-1")
    try:
        yield
    finally:
        spark.conf.set(BROADCAST, old)


REPORTS = ["top_busiest_roads", "road_category_distribution", "coverage_by_region_category", "top_growing_roads",
           "geospatial_hotspots"]


@pytest.fixture(scope="module")
def copy(spark):
    wh = bucketed(whm.warehouse_for(spark, SMALL_SF), buckets=4)
    yield wh
    wh.drop()


def below_join(plan: str) -> str:
    """The part of a plan between the join with the points and the fact's scan."""
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "CountPointKey" in line)
    scan = next(i for i, line in enumerate(lines) if i > join and "FileScan" in line)
    return "\n".join(lines[join:scan + 1])


@pytest.mark.parametrize("name", REPORTS)
def test_reports_equal_those_of_the_plain_warehouse(spark, copy, name):
    with broadcasts_off(spark):
        got = sorted(map(str, getattr(reports, name)(copy).collect()))
    assert got == sorted(map(str, getattr(reports, name)(whm.warehouse_for(spark, SMALL_SF)).collect()))
    assert got or name == "top_busiest_roads"  # no road reaches a million there


def test_no_exchange_of_the_fact_by_point(spark, copy):
    with broadcasts_off(spark):
        df = reports.top_busiest_roads(copy)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plain = reports.with_point(reports.partials(whm.warehouse_for(spark, SMALL_SF), ["CountPointKey"], {
            "s": reports.MV}), whm.warehouse_for(spark, SMALL_SF), "RoadName")
    part = below_join(plan)
    assert "Exchange" not in part and re.search(r"Bucketed: true", part)
    assert "PartitionFilters: [isnotnull(DateKey" in part  # years still prune
    assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()

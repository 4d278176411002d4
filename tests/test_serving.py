"""Serving datasets kept up by change, mergeable distinct counts, and cells of any size."""

from pyspark.sql import functions as F

from roadflow.operators.distinct import count_keys, key_bitmaps, merge_bitmaps
from roadflow.plans import analyses as an
from roadflow.plans import extracts
from roadflow.plans import serving as sv
from roadflow.plans.snapshots import Snapshots
from roadflow.session import new_output_dir
from roadflow.sources.landing import landing_for

from .conftest import SMALL_SF


def stores(spark):
    return [Snapshots(spark, new_output_dir(spark, n)) for n in ("test-extract", "test-serving")]


def content(out):
    return {name: sorted(map(str, sv.served(out, name).collect())) for name in sv.DATASETS} | {
        "points": sorted(map(str, sv.distinct_points(out, ["Year", "region_name", "road_category"]).collect()))}


def rebuilt(spark, raw):
    source, out = stores(spark)
    extracts.deliver(source, raw)
    sv.refresh_serving(source, out)
    return content(out)


def by_year(out):
    return {(name, str(p.values.get("Year") or p.values.get("year"))): p.folder
            for name, parts in out.snapshot().parts.items() for p in parts}


def test_datasets_of_the_state_equal_those_of_the_extract(spark):
    typed = landing_for(spark, SMALL_SF).table("raw_aadf_typed")
    got = rebuilt(spark, landing_for(spark, SMALL_SF).table("raw_aadf"))
    for name, (make, _) in sv.DATASETS.items():
        want = make(typed)
        shown = want.select(*[F.col(c).cast("double") if t.startswith("decimal") else c for c, t in want.dtypes])
        source, out = stores(spark)
        assert len(got[name]) == shown.count() > 0, name


def test_a_redelivered_year_rewrites_only_its_own_partitions(spark):
    raw = landing_for(spark, SMALL_SF).table("raw_aadf")
    source, out = stores(spark)
    extracts.deliver(source, raw)
    assert sv.refresh_serving(source, out) == [1990, *range(2017, 2024)][-len(sv.refresh_serving(source, stores(spark)[1])):]
    assert sv.refresh_serving(source, out) == []  # nothing has changed
    before = by_year(out)
    half = raw.where(F.col("count_point_id") % 2 == 0)
    extracts.deliver(source, half, [2019])
    assert sv.refresh_serving(source, out) == [2019]
    after = by_year(out)
    changed = {k for k in before if before[k] != after[k]}
    # the newest year's two datasets have no year of their own and are small
    assert {k for k in changed if k[1] != "None"} == {(n, "2019") for n in (
        "state", "yearly_totals", "regional_by_year", "top_roads_by_year", "road_category_by_year", "point_sets")}
    whole = raw.where((F.col("year") != 2019) | (F.col("count_point_id") % 2 == 0))
    assert content(out) == rebuilt(spark, whole)


def test_a_year_that_is_gone_goes(spark):
    raw = landing_for(spark, SMALL_SF).table("raw_aadf")
    source, out = stores(spark)
    extracts.deliver(source, raw)
    sv.refresh_serving(source, out)
    newest = raw.agg(F.max("year")).first()[0]
    extracts.deliver(source, raw.limit(0), [newest])
    assert sv.refresh_serving(source, out) == []
    assert content(out) == rebuilt(spark, raw.where(F.col("year") != newest))


def test_partial_sets_of_disjoint_years_merge_to_exact_counts(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 5).alias("year"), (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919) % 70_001).alias("k"))
    hot = spark.range(50_000).select(F.lit(2).cast("long").alias("year"), F.lit(1).cast("long").alias("g"),
                                     F.lit(5).cast("long").alias("k"))  # one key in many rows
    rows = rows.unionByName(hot)
    root = new_output_dir(spark, "partials")
    for y in range(5):
        key_bitmaps(rows.where(f"year = {y}"), ["year", "g"], "k").write.parquet(f"{root}/{y}")
    parts = [spark.read.parquet(f"{root}/{y}") for y in range(5)]
    for groups in ([], ["g"], ["year"], ["year", "g"]):
        got = count_keys(merge_bitmaps(parts, ["year", "g"]), groups, "n").collect()
        want = rows.groupBy(*groups).agg(F.count_distinct("k").alias("n")).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_cells_of_any_size_fail_no_analysis(spark):
    raw = landing_for(spark, SMALL_SF).table("raw_aadf")
    odd = raw.limit(3).withColumn("LGVs", F.lit("1e23")).withColumn("pedal_cycles", F.lit("-1e40")).withColumn(
        "cars_and_taxis", F.lit("NaN"))
    source, out = stores(spark)
    extracts.deliver(source, raw.unionByName(odd))
    sv.refresh_serving(source, out)
    typed = extracts.typed(source)
    for name in ("vehicle_mode_trends", "hgv_axle_trends", "road_category_trends"):
        assert getattr(an, name)(typed).count() == getattr(an, name)(an.as_numbers(raw)).count()
    held = extracts.oversize(source).collect()
    assert len(held) == 3 and {r["LGVs"] for r in held} == {"1e23"}  # as they came
    numbers = spark.createDataFrame([(1e23, 1.5), (float("nan"), 2.0), (None, float("inf"))], "LGVs double, all_HGVs double")
    assert [tuple(map(lambda v: None if v is None else float(v), r)) for r in an.as_numbers(numbers).collect()] == [
        (None, 1.5), (None, 2.0), (None, None)]

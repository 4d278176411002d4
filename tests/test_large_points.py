"""A point map too large to broadcast, years delivered by themselves, and the position as one number."""

from decimal import Decimal

from pyspark.sql import functions as F

from roadflow.plans import extracts, serving
from roadflow.plans import warehouse as whm
from roadflow.plans.snapshots import Snapshots
from roadflow.session import new_output_dir
from roadflow.sources.landing import landing_for

from .conftest import SMALL_SF


def content(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_only_rows_set_apart_carry_their_raw_row_to_the_point_join(spark, monkeypatch):
    land = landing_for(spark, SMALL_SF)
    raw, points = land.table("raw_aadf"), land.table("count_points").where("count_point_id % 5 != 0")
    small = whm.build_warehouse(spark, raw, points, new_output_dir(spark, "small"))
    monkeypatch.setattr(whm, "BROADCAST_MAX_ROWS", 10)
    large = whm.build_warehouse(spark, raw, points, new_output_dir(spark, "large"))
    assert not large.broadcastable("DimCountPoint")
    assert content(large.rejected()) == content(small.rejected())
    assert content(large.fact.select(*whm.FACT_COLUMNS)) == content(small.fact.select(*whm.FACT_COLUMNS))
    maps = large.lookups()
    keyed = whm.keyed_rows(raw, maps, whm.unknown_points(raw, maps["cp"]))
    held = {r[0]: (r[1], r[2]) for r in keyed.groupBy(whm.STATUS).agg(
        F.count(F.lit(1)), F.count(whm.AS_CAME)).collect()}
    assert held[whm.LOADED][1] == 0 and held[whm.NO_KEY][0] == held[whm.NO_KEY][1] > 0


def test_years_of_a_partitioned_extract_are_delivered_by_themselves(spark):
    raw = landing_for(spark, SMALL_SF).table("raw_aadf")
    odd = raw.limit(30).withColumn("year", F.when(F.col("count_point_id") % 2 == 0, F.lit(1234)).cast("int"))
    raw = raw.unionByName(odd)
    one, two = (Snapshots(spark, new_output_dir(spark, "extracts")) for _ in range(2))
    extracts.deliver(one, raw)
    extracts.deliver(two, raw, by_year=True)
    assert content(extracts.typed(two)) == content(extracts.typed(one))
    parts = [{str(p.values["year"]): p.rows for p in s.snapshot().of(extracts.TYPED)} for s in (one, two)]
    assert parts[0] == parts[1] and {"None", "1234"} <= parts[0].keys()


def test_smallest_position_is_one_number_and_needs_no_sort(spark):
    rows = [(1, "51.5", "-0.1"), (1, "51.5", "-0.10000001"), (1, "51.50000001", "-179.99999999"), (2, "-0.00000001", "999.99999999"),
            (2, "-0.00000001", "-999.99999999"), (3, "-99.99999999", "0"), (3, None, "1"), (4, "1", None), (5, "0", "0")]
    df = spark.createDataFrame([(k, a and Decimal(a), b and Decimal(b)) for k, a, b in rows],
                               "k int, latitude decimal(10,8), longitude decimal(11,8)")
    out = df.groupBy("k").agg(serving.smallest_position(df))
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    got = out.select("k", *serving.position(df))
    assert got.dtypes[1:] == df.dtypes[1:]
    plain = df.groupBy("k").agg(F.min(F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
                                             F.struct("latitude", "longitude"))).alias("at")).select("k", "at.*")
    assert content(got) == content(plain)

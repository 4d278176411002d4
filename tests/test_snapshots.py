"""Loads become visible as a whole or not at all, and a repeat adds nothing."""

import pytest
from pyspark.sql import functions as F

from roadflow.plans import warehouse as whm
from roadflow.plans.snapshots import Conflict, Part, Snapshot, Snapshots
from roadflow.session import new_output_dir
from roadflow.sources.files import create_once, folder_names, read_text
from roadflow.sources.landing import landing_for

from .conftest import SMALL_SF


@pytest.fixture
def store(spark):
    return Snapshots(spark, new_output_dir(spark, "snapshots"))


def test_a_file_is_created_once(spark):
    path = f"{new_output_dir(spark, 'once')}/a/b.json"
    assert create_once(spark, path, "é one") and not create_once(spark, path, "two")
    assert read_text(spark, path) == "é one"
    assert [n for n in folder_names(spark, path.rpartition("/")[0]) if not n.startswith(".")] == ["b.json"]


def test_only_one_of_two_commits_from_a_snapshot_goes_through(store):
    first = store.commit(Snapshot(), {"t": [Part("t/load=1", 3)]}, {"a": 1})
    second = store.commit(first, {"u": [Part("u/load=2", 4, {"y": 2020})]}, {"b": 2})
    with pytest.raises(Conflict):
        store.commit(first, {"t": []})
    assert store.versions() == [1, 2] and store.snapshot() == second
    assert second.parts == {"t": [Part("t/load=1", 3)], "u": [Part("u/load=2", 4, {"y": 2020})]}
    assert second.notes == {"a": 1, "b": 2} and second.rows("u", y=2020) == 4 and second.rows("u", y=1) == 0
    assert store.snapshot(1) == first


def test_concurrent_commits_take_one_number_each(store):
    from concurrent.futures import ThreadPoolExecutor

    def one(i):
        try:
            store.commit(Snapshot(), {"t": [Part(f"t/load={i}", i)]})
            return i
        except Conflict:
            return None

    with ThreadPoolExecutor(max_workers=8) as pool:
        winners = [i for i in pool.map(one, range(24)) if i is not None]
    assert len(winners) == 1 and store.snapshot().parts["t"][0].rows == winners[0]


def test_partitioned_tables_read_back_from_listed_folders_only(spark, store):
    rows = spark.range(20).select("id", (F.col("id") % 3).cast("int").alias("y"))
    parts = store.write("t", rows, ("y",))
    store.write("t", rows, ("y",))  # a load that fails before its commit
    snap = store.commit(Snapshot(), {"t": parts})
    assert {p.values["y"]: p.rows for p in parts} == {0: 7, 1: 7, 2: 6}
    got = store.read("t", snap.of("t"), rows.schema)
    assert got.columns == ["id", "y"] and sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    plan = got.where("y = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan
    assert store.read("t", [], rows.schema).count() == 0


def test_expiry_deletes_only_what_kept_snapshots_do_not_list(spark, store):
    rows = spark.range(4)
    old, kept, unlisted = (store.write("t", rows)[0] for _ in range(3))
    first = store.commit(Snapshot(), {"t": [old], "u": [kept]})
    second = store.commit(first, {"t": [kept], "u": []})
    store.commit(second, {"t": [kept]})
    assert store.expire(keep=2) == [old.folder]
    left = set(folder_names(spark, f"{store.base}/t"))
    assert left == {kept.folder.split("/")[1], unlisted.folder.split("/")[1]}


# -- the warehouse -------------------------------------------------------------

def content(wh):
    fact = sorted(map(tuple, wh.fact.select(*whm.FACT_COLUMNS).collect()))
    return fact, sorted(map(str, wh.rejected().collect()))


def small(spark):
    land = landing_for(spark, SMALL_SF)
    return land.table("raw_aadf"), land.table("count_points")


@pytest.mark.parametrize("step", ["write_dimensions", "write_load", "commit"])
def test_a_load_killed_after_any_step_and_run_again_is_whole(spark, monkeypatch, step):
    raw, points = small(spark)
    whole = content(whm.build_warehouse(spark, raw, points, new_output_dir(spark, "whole")))
    base = new_output_dir(spark, "killed")
    owner = whm.Warehouse if step == "commit" else whm
    real = getattr(owner, step)

    def killed(*args, **kwargs):
        if step != "commit":
            real(*args, **kwargs)  # all is written, then the driver is gone
        raise KeyboardInterrupt

    monkeypatch.setattr(owner, step, killed)
    with pytest.raises(KeyboardInterrupt):
        whm.build_warehouse(spark, raw, points, base)
    assert whm.open_warehouse(spark, base) is None
    monkeypatch.undo()
    whm.build_warehouse(spark, raw, points, base)
    assert content(whm.open_warehouse(spark, base)) == whole and whole[0] and whole[1]


def test_incremental_loads_at_once_do_not_double_rows(spark):
    raw, points = small(spark)
    base = new_output_dir(spark, "two-loads")
    whm.build_dimensions(spark, points, base)
    one, two = whm.open_warehouse(spark, base), whm.open_warehouse(spark, base)
    whm.incremental_load(one, raw)
    with pytest.raises(Conflict):
        whm.incremental_load(two, raw)
    assert content(whm.open_warehouse(spark, base)) == content(one)
    assert whm.incremental_load(whm.open_warehouse(spark, base), raw).count() == 0  # run again: nothing to do


def test_many_small_loads_are_compacted(spark):
    raw, points = small(spark)
    wh = whm.build_dimensions(spark, points, new_output_dir(spark, "compact"))
    for k in range(3):
        parts = whm.write_load(wh, raw.where(f"count_point_id % 3 = {k} and year between 2018 and 2019"))
        wh.commit({whm.FACT: wh.snapshot.of(whm.FACT) + parts}, {})
    before = content(wh)
    assert whm.compact_years(wh, most=2) == [2018, 2019] and whm.compact_years(wh, most=2) == []
    assert content(wh) == before
    assert len(wh.snapshot.of(whm.FACT, status="loaded")) == 2


def test_dimensions_build_from_a_frame_of_unknown_size(spark):
    _, points = small(spark)
    rows = spark.createDataFrame(points.collect(), points.schema)
    wh = whm.build_dimensions(spark, rows, new_output_dir(spark, "unsized"))
    assert wh.manifest["DimCountPoint"] == points.select("count_point_id").distinct().count()


def test_keys_stay_when_members_come_and_go(spark):
    _, points = small(spark)
    base = new_output_dir(spark, "stable")
    keys = []
    for chosen in ("count_point_id % 3 = 0", "count_point_id % 3 < 2", "count_point_id % 3 > 0"):
        wh = whm.build_dimensions(spark, points.where(chosen), base)
        keys.append({r.CountPointID: r.CountPointKey for r in wh.table("DimCountPoint").collect()})
    for earlier, later in ((0, 1), (1, 2), (0, 2)):
        assert all(keys[later][i] == k for i, k in keys[earlier].items() if i in keys[later])
    known = {r.CountPointID: r.CountPointKey for r in wh.table("KeysDimCountPoint").collect()}
    assert sorted(known.values()) == list(range(1, len(known) + 1))  # dense, none given out twice
    assert set(known) == {i for k in keys for i in k}
    regions = [{(r.RegionID, r.RegionKey) for r in whm.open_warehouse(spark, base, v).table("DimRegion").collect()}
               for v in (1, 3)]
    assert regions[0] == regions[1]

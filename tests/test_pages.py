"""Paged JSON envelopes: parse, flatten, completeness, streaming ingest."""

import glob
import json
import os

from pyspark.sql import functions as F

from roadflow.sources import pages as pg
from roadflow.streaming.page_ingest import ingest_pages


def write(tmp_path, name, payloads):
    d = tmp_path / name
    d.mkdir()
    for i, p in enumerate(payloads):
        (d / f"page-{i}.json").write_text(json.dumps(p) + "\n")
    return str(d)


TWO = {"data": [{"count_point_id": 1, "year": 2023, "all_motor_vehicles": 5000},
                {"count_point_id": 2, "year": 2023, "all_motor_vehicles": 3000}],
       "total": 2, "last_page": 1, "per_page": 1000, "current_page": 1}
ONE = {"data": [{"count_point_id": 1, "year": 2023, "all_motor_vehicles": 5000}], "total": 1, "last_page": 1}


def test_response_parsing(spark, tmp_path):
    env = pg.read_pages(spark, write(tmp_path, "p", [TWO]))
    row = env.first()
    assert len(row.data) == 2 and row.total == 2


def test_payload_converts_to_rows(spark, tmp_path):
    rows = pg.flatten_pages(pg.read_pages(spark, write(tmp_path, "p", [ONE])))
    assert "count_point_id" in rows.columns
    assert rows.count() == 1


def test_completeness_detects_missing_page(spark, tmp_path):
    p1 = dict(TWO, total=3, last_page=2)
    env = pg.read_pages(spark, write(tmp_path, "p", [p1]))
    row = pg.pages_completeness(env).first()
    assert row.pages_received == 1 and row.last_page == 2 and row.complete is False


def test_build_envelopes_bounds_page_size(spark):
    rows = spark.range(0, 2500).selectExpr("id AS k", "id AS count_point_id", "2023 AS year",
                                           "CAST(id AS DOUBLE) AS all_motor_vehicles")
    env = pg.build_envelopes(rows, ["k"], per_page=1000)
    sizes = sorted(r[0] for r in env.selectExpr("size(data)").collect())
    assert sizes == [500, 1000, 1000]
    c = pg.pages_completeness(env).first()
    assert c.complete and c.total == 2500 and c.last_page == 3


def test_records_are_made_in_their_pages_and_stored_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pg, "PAGES_PER_TASK", 2)
    rows = spark.range(0, 45).selectExpr("id AS k", "id % 7 AS narrow")
    env = pg.build_envelopes(rows, ["k"], per_page=10, record=[
        F.col("k").alias("count_point_id"), F.lpad(F.col("narrow").cast("string"), 500, "0").alias("road_name")])
    assert env.rdd.getNumPartitions() == 3  # of five pages
    path = str(tmp_path / "pages")
    pg.write_page_files(env, path)
    files = glob.glob(f"{path}/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)
    assert sum(map(os.path.getsize, files)) < 45 * 500 / 4
    back = pg.flatten_pages(pg.read_pages(spark, path)).select("count_point_id", "road_name").collect()
    assert sorted(map(tuple, back)) == [(k, str(k % 7).rjust(500, "0")) for k in range(45)]
    c = pg.pages_completeness(pg.read_pages(spark, path)).first()
    assert c.complete and c.total == 45 and c.last_page == 5


def test_stream_ingest_is_incremental(spark, tmp_path):
    src = write(tmp_path, "src", [TWO])
    out = tmp_path / "out"
    first = ingest_pages(spark, src, str(out / "t"), str(out / "ck"))
    assert first.count() == 2
    # no new files: nothing appended
    assert ingest_pages(spark, src, str(out / "t"), str(out / "ck")).count() == 2
    (tmp_path / "src" / "page-9.json").write_text(json.dumps(ONE) + "\n")
    assert ingest_pages(spark, src, str(out / "t"), str(out / "ck")).count() == 3


def test_deliveries_of_some_pages_move_and_write_only_these(spark, tmp_path, monkeypatch):
    from roadflow import registry
    from roadflow.sources.landing import landing_for

    from .test_scale_properties import _tables

    sf = _tables(spark, tmp_path)  # 27 rows
    monkeypatch.setattr(pg.number_pages, "__defaults__", (2,))  # rows a page: 14 pages
    gaps = {tuple(r) for r in registry.etl_page_gaps(spark, sf).collect()}
    assert gaps == {("missing", 3, 4, 2, 0), ("missing", 6, 6, 1, 0), ("missing", 13, 14, 2, 0),
                    ("repeated", 5, 5, 1, 2), ("repeated", 10, 10, 1, 2)}
    status = {r["status"]: (r["n_pages"], r["n_rows"], r["n_texts"]) for r in registry.stream_page_receipts(spark, sf).collect()}
    assert status == {"new": (14, 27, 0), "repeat": (2, 4, 0), "corrupt": (2, 0, 2)}
    land = landing_for(spark, sf)
    assert "pages_json" not in land._written  # no copy of all pages as text was made for them
    some = land.envelopes(F.col("page").isin(2, 14))
    assert sorted((r["current_page"], len(r["data"]), r["total"], r["last_page"]) for r in some.collect()) == [
        (2, 2, 27, 14), (14, 1, 27, 14)]
    names = "count_point_id", "year", "region_name", "estimation_method", "estimation_method_detailed"
    paged = pg.flatten_pages(land.envelopes()).select(*names).collect()
    assert sorted(map(tuple, paged)) == sorted(map(tuple, land.table("raw_aadf").select(*names).collect()))


def test_rows_kept_for_a_run_are_stored_with_zstd(spark, tmp_path):
    import pyarrow.parquet as pq

    from roadflow.plans.snapshots import Snapshots
    from roadflow.session import materialise

    rows = spark.range(100)
    store = Snapshots(spark, str(tmp_path / "store"))
    place = store.path(store.write("t", rows)[0].folder)
    for folder in (place, materialise(rows, "rows").inputFiles()[0].replace("file://", "").rpartition("/")[0]):
        for f in glob.glob(f"{folder}/*.parquet"):
            assert pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD"

"""Readers and sinks: explicit-schema CSV round trips, appends, GeoJSON, records."""

import glob
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.sources import readers, sinks
from roadflow.sources.files import delete_folder
from roadflow.sources.landing import landing_for
from roadflow.session import new_output_dir

from .conftest import SMALL_SF


def test_count_points_csv_round_trip(spark):
    land = landing_for(spark, SMALL_SF)
    cp = land.table("count_points")
    back = readers.read_count_points_csv(spark, land.csv_path("count_points"))
    assert back.schema == readers.read_count_points_csv(spark, land.csv_path("count_points")).schema
    assert back.count() == cp.count()
    assert back.exceptAll(cp.select(*back.columns)).count() == 0


def test_raw_counts_csv_parses_dates(spark):
    land = landing_for(spark, SMALL_SF)
    back = readers.read_raw_counts_csv(spark, land.csv_path("raw_counts"))
    assert dict(back.dtypes)["count_date"] == "date"
    assert back.where(F.col("count_date").isNull()).count() == 0
    assert back.count() == land.table("raw_counts").count()


def test_column_pruned_read(spark):
    land = landing_for(spark, SMALL_SF)
    df = readers.read_raw_aadf_csv(spark, land.csv_path("raw_aadf"), ["count_point_id", "year"])
    assert df.columns == ["count_point_id", "year"]
    # only the two columns are parsed, as text
    assert "ReadSchema: struct<year:string,count_point_id:string>" in \
        df._jdf.queryExecution().executedPlan().toString()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    head = ["LGVs", "note", "year", "region_id", "count_point_id", "local_authority_id", "direction_of_travel", "road_name"]
    names = [f.name for f in readers.RAW_AADF_SCHEMA]
    head += [n for n in names if n not in head]
    lines = [",".join(head)]
    for cells in (["7", "x", "2020.0", "3.0", "11", "5", "N", "A1"], ["bad", "x", "20x0", "NULL", "12.0", "n/a", "NA", "A2"]):
        lines.append(",".join(cells + [""] * (len(head) - len(cells))))
    path = tmp_path / "x.csv"
    path.write_text("\n".join(lines) + "\n")
    df = readers.read_raw_aadf_csv(spark, str(path))
    assert df.columns == names
    got = {r["count_point_id"]: r for r in df.collect()}
    assert (got[11]["year"], got[11]["region_id"], got[11]["LGVs"], got[11]["road_name"]) == (2020, 3, "7", "A1")
    assert (got[12]["year"], got[12]["region_id"], got[12]["local_authority_id"], got[12]["direction_of_travel"]) == (
        None, None, None, None)
    counts = readers.malformed_counts(spark, str(path), readers.RAW_AADF_SCHEMA).first()
    assert (counts["rows"], counts["bad_cells"], counts["malformed_lines"]) == (2, 1, 0)


def test_csv_without_a_wanted_column_fails_by_name(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("CP_Number,Road\n1,A1\n")
    with pytest.raises(ValueError, match="RoadNumber"):
        readers.read_road_segments_csv(spark, str(path))


def test_malformed_lines_are_counted(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("CP_Number,RoadNumber\n1,A1\n2,A2,extra\nthree,A3\n")
    counts = readers.malformed_counts(spark, str(path), readers.ROAD_SEGMENT_SCHEMA).first()
    assert (counts["rows"], counts["bad_cells"], counts["malformed_lines"]) == (3, 1, 1)


def test_profile_reports_an_unreadable_file_and_goes_on(spark, tmp_path):
    from roadflow.plans.quality import profile_files

    good, bad, csv = tmp_path / "good", tmp_path / "bad.parquet", tmp_path / "x.csv"
    spark.range(3).selectExpr("id as count_point_id", "2020 as year").write.parquet(str(good))
    bad.write_bytes(b"PAR1 no parquet file at all")
    csv.write_text("year,a\n2001,1\n2003.0,2\n")
    got = {r["file"]: r for r in profile_files(
        spark, {"good": str(good), "bad": str(bad), "csv": str(csv), "none": str(tmp_path / "none")}).collect()}
    assert {n: r["status"] for n, r in got.items()} == {"good": "OK", "bad": "ERROR", "csv": "OK", "none": "MISSING"}
    assert (got["good"]["rows"], got["csv"]["min_year"], got["csv"]["max_year"]) == (3, 2001, 2003)
    assert len(got["bad"]["column_names"]) > 200  # the whole error


def test_a_run_is_appended_once(spark, monkeypatch):
    out = new_output_dir(spark, "append")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    rows = [spark.createDataFrame([(i, f"x,{i}") for i in range(k)], schema) for k in (3, 5)]
    assert sinks.append_csv(rows[0], out, "r1") and not sinks.append_csv(rows[0], out, "r1")
    assert sinks.append_csv(rows[1], out, "r2")

    def content():
        return sorted(map(tuple, sinks.read_appended(spark, out, schema).collect()))

    whole = sorted((i, f"x,{i}") for k in (3, 5) for i in range(k))
    assert content() == whole
    # a run that failed before its commit is not read, and is written anew
    rows[1].write.option("header", True).csv(f"{out}/run=r3")
    delete_folder(spark, f"{out}/run=r3/_SUCCESS")
    assert content() == whole
    assert sinks.append_csv(rows[0], out, "r3") and len(content()) == len(whole) + 3
    with pytest.raises(ValueError, match="columns"):
        sinks.append_csv(rows[0].select("b", "a"), out, "r4")
    with pytest.raises(ValueError, match="folder name"):
        sinks.append_csv(rows[0], out, "../r5")
    assert sinks.read_appended(spark, new_output_dir(spark, "append-none"), schema).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 500])
def test_geojson_document_is_one_collection(spark, monkeypatch, n):
    monkeypatch.setattr(sinks, "partitions_for", lambda df: 4)
    features = spark.range(n).select((F.col("id") * 7919 % 10007).alias("k")).withColumn(
        "feature", F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("k").alias("id"))))
    out = new_output_dir(spark, "geojson-doc")
    assert sinks.write_geojson_document(features.repartition(5), out, "k") == n
    files = sorted(glob.glob(f"{out.replace('file:', '')}/part-*"))
    document = json.loads("".join(open(f).read() for f in files))
    assert document["type"] == "FeatureCollection"
    assert [f["id"] for f in document["features"]] == sorted(i * 7919 % 10007 for i in range(n))
    assert n < 500 or len(files) == 4


def test_append_parquet_partitioned(spark):
    out = new_output_dir(spark, "append-pq")
    df = spark.range(0, 10).select((F.col("id") % 2).alias("y"), "id")
    sinks.append_parquet(df, out, ["y"])
    sinks.append_parquet(df, out, ["y"])
    back = spark.read.parquet(out)
    assert back.count() == 20 and back.where("y = 1").count() == 10


def test_geojson_features_written_one_per_line(spark):
    from roadflow.registry import queries

    feats = queries()["roads_geojson"](spark, SMALL_SF)
    out = new_output_dir(spark, "geojson")
    sinks.write_geojson_features(feats, out)
    lines = spark.read.text(out).limit(5).collect()
    assert all(json.loads(r.value)["type"] == "Feature" for r in lines)


def test_json_records(spark):
    df = spark.createDataFrame([(1, "a")], "k int, name string")
    assert sinks.as_json_records(df).first().record == '{"k":1,"name":"a"}'


def test_road_segments_csv(spark):
    land = landing_for(spark, SMALL_SF)
    back = readers.read_road_segments_csv(spark, land.csv_path("road_segments"))
    assert back.count() == land.table("road_segments").count()

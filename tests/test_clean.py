"""Cleaning, validation and range checks of direction rows."""

import pytest
from pyspark.sql import functions as F

from roadflow.operators.clean import any_over_range, clean_aadf, clean_summary, validate_aadf
from roadflow.schemas import MEASURE_TYPE, RAW_AADF_SCHEMA, VEHICLE_COLS

KIND = MEASURE_TYPE.simpleString()


def rows(spark, *changes):
    """One row per mapping of changes to a plain row; measures are text, as delivered."""
    plain = {"count_point_id": 71, "year": 2011, "region_id": 4, "region_name": "Fenland", "local_authority_id": 38,
             "road_name": "A907", "road_category": "PA", "direction_of_travel": "W", "estimation_method": "Counted"}
    plain |= {c: str(9 * (i + 2)) for i, c in enumerate(VEHICLE_COLS)}
    data = [{**plain, "count_point_id": 71 + i, **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(d.get(n) for n in RAW_AADF_SCHEMA.names) for d in data], RAW_AADF_SCHEMA)


def found(df):
    return {(r["issue"], r["detail"]): r["n"] for r in validate_aadf(df).collect()}


def test_plain_rows_pass_unchanged(spark):
    df = rows(spark, {}, {"direction_of_travel": "C", "year": 2000}, {"year": 2025})
    assert found(df) == {}
    kept = clean_aadf(df).collect()
    assert sorted(r["count_point_id"] for r in kept) == [71, 72, 73]
    assert all(r[c] == 9.0 * (i + 2) for r in kept for i, c in enumerate(VEHICLE_COLS))


@pytest.mark.parametrize("change", [
    {"count_point_id": None}, {"region_id": None}, {"local_authority_id": None}, {"year": None}, {"year": 1999},
    {"year": 2026}, {"direction_of_travel": "n"}, {"direction_of_travel": None}, {"direction_of_travel": ""},
])
def test_rows_that_cleaning_drops(spark, change):
    df = rows(spark, {}, change, {})
    assert sorted(r["count_point_id"] for r in clean_aadf(df).collect()) == [71, 73]
    assert tuple(clean_summary(df).first()) == (3, 2, 1)


@pytest.mark.parametrize("change", [{"road_category": "Q"}, {"road_category": None}, {"road_name": None}])
def test_rows_that_cleaning_keeps(spark, change):
    assert clean_aadf(rows(spark, change)).count() == 1


NUMBERS = [(" 41 ", 41.0), ("0.75", 0.75), ("5.", 5.0), (".5", 0.5), ("2e2", 200.0), ("+8", 8.0), ("-0.5", 0.0), ("-7", 0.0),
           ("3f", 0.0), ("4D", 0.0), ("NaN", 0.0), ("Infinity", 0.0), ("inf", 0.0), ("0x1p3", 0.0), ("1,000", 0.0),
           ("six", 0.0), ("", 0.0), (None, 0.0)]


@pytest.mark.parametrize("kind", ["double", KIND])
def test_measure_texts(spark, kind):
    df = rows(spark, *[{"LGVs": text} for text, _ in NUMBERS])
    got = {r["count_point_id"]: float(r["LGVs"]) for r in clean_aadf(df, kind).collect()}
    assert got == {71 + i: value for i, (_, value) in enumerate(NUMBERS)}


def test_measures_too_large_for_the_fact_are_flagged(spark):
    texts = ["9999999999999999.99", "10000000000000000", "-10000000000000000", "1e40", "Infinity", "bad", None]
    df = rows(spark, *[{"all_HGVs": t} for t in texts])
    flags = df.select("count_point_id", any_over_range(df, KIND).alias("big")).collect()
    assert [r["count_point_id"] - 71 for r in flags if r["big"]] == [1, 3]
    # the double form keeps such numbers
    assert clean_aadf(df).where("count_point_id = 72").first()["all_HGVs"] == 1e16


def test_validation_names_each_fault(spark):
    df = rows(spark, {"pedal_cycles": "-2"}, {"pedal_cycles": " -4.5"}, {"pedal_cycles": "-x"},
              {"direction_of_travel": "NE"}, {"direction_of_travel": "NE"}, {"road_category": "Z9"},
              {"region_id": None, "all_HGVs": None})
    assert found(df) == {("negative_pedal_cycles", None): 2, ("invalid_directions", "NE"): 2,
                         ("invalid_road_categories", "Z9"): 1, ("null_values", "region_id"): 1,
                         ("null_values", "all_HGVs"): 1}


def test_validation_counts_negatives_of_every_measure(spark):
    got = found(rows(spark, {c: "-1" for c in VEHICLE_COLS}))
    assert got == {(f"negative_{c}", None): 1 for c in VEHICLE_COLS}


def test_absent_columns(spark):
    df = rows(spark, {}).drop("local_authority_id", "LGVs")
    assert set(found(df)) == {("missing_columns", "local_authority_id"), ("missing_columns", "LGVs")}
    with pytest.raises(ValueError, match="local_authority_id"):
        clean_aadf(df)
    assert clean_aadf(rows(spark, {}).drop("LGVs")).where(F.col("all_HGVs") > 0).count() == 1

"""Fixed domains and the broadcast size check."""

import pytest

from roadflow import schemas
from roadflow.operators.joins import bounded_broadcast, estimated_bytes
from roadflow.session import shared_dir


def test_fixed_domains():
    assert schemas.VALID_DIRECTIONS == ["N", "S", "E", "W", "C"]
    assert schemas.VALID_ROAD_CATEGORIES == ["TM", "PM", "TA", "PA", "M", "MB", "MCU"]
    assert (schemas.YEAR_MIN, schemas.YEAR_MAX) == (2000, 2025)
    assert len(schemas.VEHICLE_COLS) == 13 and len(schemas.FACT_MEASURES) == 13
    assert list(schemas.FACT_MEASURES) == schemas.VEHICLE_COLS
    assert schemas.REQUIRED_COLS[:5] == ["count_point_id", "year", "region_id", "local_authority_id",
                                         "direction_of_travel"]
    assert set(schemas.MOTORWAY_CATEGORIES + schemas.A_ROAD_CATEGORIES + schemas.MINOR_CATEGORIES) == \
        set(schemas.VALID_ROAD_CATEGORIES)
    assert schemas.MIN_EXPECTED_ROWS["FactTrafficFlowDirection"] == 500000


def _hinted(df):
    return "BroadcastHint" in df._jdf.queryExecution().analyzed().toString() or \
        "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_broadcast_only_with_known_small_size(spark):
    df = spark.range(10)
    assert _hinted(bounded_broadcast(df, max_rows=100, known_rows=10))
    assert not _hinted(bounded_broadcast(df, max_rows=5, known_rows=10))


def test_broadcast_checks_bytes_as_well_as_rows(spark):
    wide = spark.range(10).selectExpr("id", *[f"cast(id as string) as c{i}" for i in range(50)])
    assert not _hinted(bounded_broadcast(wide, max_rows=100, known_rows=10, max_bytes=5_000))


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, path):
        self.path = path


class _Session:
    def __init__(self, master, folder=None):
        from types import SimpleNamespace

        self.sparkContext = _Context(master)
        self.conf = SimpleNamespace(get=lambda key, default=None: folder)


def test_no_machine_local_folder_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(_Session(master))
        assert shared_dir(_Session(master, "s3a://bucket/ckpt/")) == "s3a://bucket/ckpt"
    assert shared_dir(_Session("local[4]")).startswith("/tmp/")


def test_broadcast_from_estimate(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    small = spark.read.parquet(path)
    assert estimated_bytes(small) is not None
    assert _hinted(bounded_broadcast(small, max_bytes=10 ** 9))
    assert not _hinted(bounded_broadcast(small, max_bytes=1))

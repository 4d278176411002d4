"""Sinks: CSV reports, appends, JSON records and GeoJSON features."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import partitions_for, with_dense_key
from ..session import materialise
from .files import create_once, folder_names, read_text
from .readers import read_csv


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header.  ``single_file`` is for results of a bounded number
    of rows (reports): these are stored first, so only the finished rows pass
    through one task, not the work that makes them.  Large outputs keep one
    file per task."""
    out = materialise(df, "result").coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


def append_csv(df: DataFrame, path: str, run_id: str) -> bool:
    """Adds a run's rows to a CSV folder once; False if the run is there already.

    A run has a folder of its own, whose ``_SUCCESS`` file, written last, is its
    commit: a run that failed is written anew, and one that is repeated adds
    nothing. The first run fixes the columns; a run with others is an error.
    Every file carries its header."""
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"run id {run_id!r} is no folder name")
    spark = df.sparkSession
    names = json.dumps(df.columns)
    if not create_once(spark, f"{path}/_columns.json", names) and read_text(spark, f"{path}/_columns.json") != names:
        raise ValueError(f"{path} has the columns {read_text(spark, f'{path}/_columns.json')}, not {names}")
    run = f"{path}/run={run_id}"
    if "_SUCCESS" in (folder_names(spark, run) or []):
        return False
    df.write.mode("overwrite").option("header", True).csv(run)
    return True


def appended_runs(spark: SparkSession, path: str) -> list[str]:
    """Folders of the runs that were written whole."""
    runs = sorted(n for n in folder_names(spark, path) or [] if n.startswith("run="))
    return [f"{path}/{n}" for n in runs if "_SUCCESS" in (folder_names(spark, f"{path}/{n}") or [])]


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of the runs that were written whole."""
    runs = appended_runs(spark, path)
    if not runs:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [read_csv(spark, run, schema) for run in runs])


def append_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def as_json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row (the REST payload form)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))


def write_geojson_document(features: DataFrame, path: str, order: str) -> int:
    """One GeoJSON FeatureCollection, whose files give the document when read one after the other by name; the number
    of features.

    Features stand one a line, in the order of the unique column ``order``: the
    head goes with the first line and the tail with the last, known from a
    dense numbering, so every task writes its own range of lines."""
    numbered = with_dense_key(features.select(order, "feature"), "_n", [order], key_type="bigint")
    n = numbered.count()
    head, tail = '{"type":"FeatureCollection","features":[', "]}"
    if n == 0:
        lines = features.sparkSession.createDataFrame([(head + tail,)], "value string").coalesce(1)
    else:
        place = F.col("_n")
        line = F.concat(F.when(place == 1, head).otherwise(""), "feature", F.when(place == n, tail).otherwise(","))
        lines = numbered.repartitionByRange(partitions_for(features), "_n").sortWithinPartitions("_n").select(
            line.alias("value"))
    lines.write.mode("overwrite").text(path)
    return n


def write_geojson_features(features: DataFrame, path: str) -> None:
    """Write GeoJSON features, one per line (GeoJSON text sequence)."""
    features.select("feature").write.mode("overwrite").text(path)

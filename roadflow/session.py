"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: How Parquet files that a run writes for itself are stored: a third smaller than Spark's default.
STORED = {"compression": "zstd"}


def local_session(cpus: int | str = "*", app: str = "roadflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and the local bench (a cluster supplies its own)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.driver.memory"] = os.environ.get("ROADFLOW_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for materialised tables and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir``; only a local master without
    one (tests) gets a private folder.  A cluster without the setting is an
    error: a machine-local folder would hold a part of each table on every
    executor.
    """
    sc = spark.sparkContext
    current = None
    try:
        current = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - older API
        current = None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that the driver "
                           "and all executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="roadflow-ckpt-", dir="/tmp")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current.rstrip("/")


def new_output_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder."""
    return f"{shared_dir(spark)}/roadflow/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df, name: str):
    """``df`` written to the shared folder and read back: later uses scan the
    result, and a lost executor costs no recomputation of what lies before."""
    path = new_output_dir(df.sparkSession, name)
    df.write.options(**STORED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

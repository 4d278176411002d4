"""Landing zone: raw extracts written once as files, then scanned.

In production the raw extracts arrive as CSV/Parquet files and are read
with :mod:`roadflow.sources.readers`.  For the shared test data they are
derived from the given tables (:mod:`roadflow.sources.standin`) and
written once per session to the shared folder, so every report scans
files with pushdown and pruning instead of recomputing the derivation.
"""

from __future__ import annotations

import os
import threading
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession

from ..schemas import RAW_AADF_SCHEMA
from ..session import STORED, new_output_dir
from . import pages, standin

RAW_TABLES = {
    "raw_aadf": lambda land: standin.raw_aadf(land.spark, land.sf_dir, by=PARTITIONED["raw_aadf"]),
    "count_points": lambda land: standin.count_points(land.spark, land.sf_dir),
    "raw_counts": lambda land: standin.raw_counts(land.spark, land.sf_dir),
    # the two comparison datasets are derived from the landed direction extract
    "full_aadf": lambda land: standin.full_aadf(land.spark, land.sf_dir, land.table("raw_aadf")),
    "subset_aadf": lambda land: standin.subset_aadf(land.spark, land.sf_dir, land.table("full_aadf")),
    "road_segments": lambda land: standin.road_segments(land.spark, land.sf_dir),
}
#: The direction extract with its text measures parsed once (numbers as written, unparsable text -> NULL, nothing
#: clamped or filtered): the raw-extract analyses scan this instead of re-parsing text per query.
TYPED = "raw_aadf_typed"

# Landed tables partitioned by a column (year-filtered analyses prune them).
PARTITIONED = {"raw_aadf": "year"}

_LOCK = threading.RLock()
_CACHE: dict = {}


class Landing:
    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = root
        self._written: set[str] = set()
        self._locks: dict[str, threading.Lock] = {}
        self._paged: pages.PagedRows | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _lock(self, name: str) -> threading.Lock:
        with _LOCK:
            return self._locks.setdefault(name, threading.Lock())

    def table(self, name: str) -> DataFrame:
        """The landed table (written on first use; one writer per table, so
        independent tables can be landed concurrently)."""
        if name == TYPED:
            from ..plans.extracts import typed

            return typed(self.extracts()).select(*RAW_AADF_SCHEMA.names)
        if name not in self._written:
            with self._lock(name):
                if name not in self._written:
                    df = RAW_TABLES[name](self)
                    part = PARTITIONED.get(name)
                    writer = df.write.mode("overwrite").options(**STORED)
                    (writer.partitionBy(part) if part else writer).parquet(self.path(name))
                    self._written.add(name)
        df = self.spark.read.parquet(self.path(name))
        order = RAW_AADF_SCHEMA.names if name in PARTITIONED else df.columns
        return df.select(*order)  # a partition column is read last

    def extracts(self):
        """The parsed direction extract by year (:mod:`roadflow.plans.extracts`), delivered on first use."""
        from ..plans.extracts import deliver
        from ..plans.snapshots import Snapshots

        store = Snapshots(self.spark, self.path("extracts"))
        if TYPED not in self._written:
            with self._lock(TYPED):
                if TYPED not in self._written:
                    deliver(store, self.table("raw_aadf"), by_year=True)
                    self._written.add(TYPED)
        return store

    def prepare(self, names: list[str], parallel: int = 4) -> None:
        """Land several tables, submitting independent writes concurrently."""
        from concurrent.futures import ThreadPoolExecutor

        with ThreadPoolExecutor(max_workers=parallel) as pool:
            list(pool.map(self.table, names))

    def csv_path(self, name: str) -> str:
        """The landed table also written as CSV with a header, in the form in
        which extracts are delivered (:func:`standin.as_delivered`)."""
        key = f"{name}_csv"
        if key not in self._written:
            with self._lock(key):
                if key not in self._written:
                    from .sinks import write_csv

                    write_csv(standin.as_delivered(self.table(name)), self.path(key))
                    self._written.add(key)
        return self.path(key)

    def pages_path(self) -> str:
        """Folder of JSON page files cut from the raw AADF extract."""
        name = "pages_json"
        if name not in self._written:
            with self._lock(name):
                if name not in self._written:
                    pages.write_page_files(self.envelopes(), self.path(name))
                    self._written.add(name)
        return self.path(name)

    def envelopes(self, where: Column | None = None) -> DataFrame:
        """The pages of the raw AADF extract, or those that ``where`` (over ``page``) names, made from numbered rows that
        are stored once: a delivery of some pages needs no copy of all of them as text."""
        with self._lock("page_rows"):
            if self._paged is None:
                rows = standin.aadf_rows(self.spark, self.sf_dir)
                self._paged = pages.number_pages(rows, ["l_orderkey", "l_linenumber"])
        return pages.envelopes_of(self._paged, standin.aadf_columns(),
                                  partial(standin.with_nations, self.spark, self.sf_dir), where)


def landing_for(spark: SparkSession, sf_dir: str) -> Landing:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = Landing(spark, sf_dir, new_output_dir(spark, "landing"))
        return _CACHE[key]

"""The direction extract as delivered year by year, with its text measures parsed once.

A delivery writes its years as one load (:mod:`roadflow.plans.snapshots`) and
replaces these years only, so whatever is derived from the extract can see
which years have changed: those whose folders differ. Measures are exact
decimals as written; a cell too large for the type is NULL there, and its row is
kept beside, as it came (``oversize``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import any_over_range
from ..schemas import ANALYSIS_TYPE
from .analyses import as_numbers
from .snapshots import Part, Snapshot, Snapshots
from .warehouse import calendar_years

TYPED, AS_CAME = "direction_rows", "_as_came"


def deliver(store: Snapshots, raw: DataFrame, years: list[int] | None = None, by_year: bool = False) -> Snapshot:
    """Takes a whole extract, or replaces the given years by what ``raw`` holds of them; committed.

    ``by_year`` says that ``raw`` is read from files partitioned by year: then
    each calendar year is read and written by itself, and no row is moved to
    another task."""
    before = store.snapshot()
    rows = raw if years is None else raw.where(F.col("year").isin(years))
    large = any_over_range(rows, ANALYSIS_TYPE.simpleString())
    rows = as_numbers(rows.withColumn(AS_CAME, F.when(large, F.struct(*raw.columns))))
    own = calendar_years(rows) if by_year else []
    parts = store.write_slices(TYPED, "year", {y: rows.where(F.col("year") == y) for y in own})
    rest = rows.where(~F.coalesce(F.col("year").isin(own), F.lit(False))) if own else rows
    parts += store.write(TYPED, rest.hint("rebalance", "year"), ("year",))
    kept = [] if years is None else [p for p in before.of(TYPED) if p.values["year"] not in years]
    return store.commit(before, {TYPED: kept + parts}, {"schema": rows.schema.json()})


def _schema(snapshot: Snapshot) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(snapshot.notes["schema"]))


def typed(store: Snapshots, years: list[int] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
    """The rows of the newest delivery of each year, or of some years."""
    snapshot = snapshot or store.snapshot()
    parts = [p for p in snapshot.of(TYPED) if years is None or p.values["year"] in years]
    return store.read(TYPED, parts, _schema(snapshot)).drop(AS_CAME)


def oversize(store: Snapshots) -> DataFrame:
    """Rows with a measure too large to be summed exactly, as they came."""
    snapshot = store.snapshot()
    rows = store.read(TYPED, snapshot.of(TYPED), _schema(snapshot))
    return rows.where(F.col(AS_CAME).isNotNull()).select(f"{AS_CAME}.*")


def year_versions(snapshot: Snapshot) -> dict[str, list[str]]:
    """Which folders make up each year; a year without a number has the name ``None``."""
    out: dict[str, list[str]] = {}
    for p in sorted(snapshot.of(TYPED), key=lambda p: p.folder):
        out.setdefault(str(p.values["year"]), []).append(p.folder)
    return out


def year_parts(parts: list[Part], column: str, years: set[str], inside: bool) -> list[Part]:
    return [p for p in parts if (str(p.values[column]) in years) == inside]

"""ETL entry point over delivered extract files.

``run_etl`` is the whole batch: read the extracts (explicit schemas), load
the dimensions and the fact (full refresh, or only the years not yet
loaded), run the data-quality checks and export the reports.  Each step is
a set of Spark jobs.  A failing load stops the run; failing checks or
exports are recorded and the rest still runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import COUNT_POINTS_SCHEMA, RAW_AADF_SCHEMA
from ..sources import pages
from ..sources.readers import malformed_counts, read_count_points_csv, read_parquet, read_raw_aadf_csv
from . import exports, extracts, quality, serving
from .snapshots import Snapshots
from .warehouse import FACT, build_dimensions, build_warehouse, incremental_load, open_warehouse


def read_extract(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A delivered extract: CSV with a header, Parquet, or a folder of JSON pages."""
    place = path.rstrip("/")
    if place.endswith(".parquet"):
        return read_parquet(spark, path)
    if place.endswith("json"):
        return pages.flatten_pages(pages.read_pages(spark, path))
    reader = {"aadf": read_raw_aadf_csv, "count_points": read_count_points_csv}[kind]
    return reader(spark, path)


def extract_step(spark: SparkSession, path: str, kind: str) -> tuple[str, str, str]:
    """What did not parse in an extract, as a step of the run."""
    place = path.rstrip("/")
    if place.endswith(".parquet"):
        return f"extract:{kind}", "OK", "typed"
    if place.endswith("json"):
        envelopes = pages.read_pages(spark, path)
        done, bad = pages.pages_completeness(envelopes).first(), pages.corrupt_pages(envelopes).first()
        status = "OK" if done["complete"] and not bad["corrupt_pages"] else "WARN"
        return f"extract:{kind}", status, f"{done['rows_received']} of {done['total']} rows, {bad['corrupt_pages']} corrupt pages"
    r = malformed_counts(spark, path, {"aadf": RAW_AADF_SCHEMA, "count_points": COUNT_POINTS_SCHEMA}[kind]).first()
    status = "WARN" if r["bad_cells"] or r["malformed_lines"] else "OK"
    return f"extract:{kind}", status, f"{r['rows']} rows, {r['bad_cells']} bad cells, {r['malformed_lines']} malformed lines"


def run_etl(spark: SparkSession, aadf_path: str, count_points_path: str, warehouse_root: str,
            incremental: bool = False, years=None, reports_dir: str | None = None) -> DataFrame:
    """Run the batch and return ``(step, status, detail)`` rows."""
    steps = [extract_step(spark, aadf_path, "aadf"), extract_step(spark, count_points_path, "count_points")]
    raw = read_extract(spark, aadf_path, "aadf")
    points = read_extract(spark, count_points_path, "count_points")

    wh = open_warehouse(spark, warehouse_root) if incremental else None
    if incremental:
        if wh is None:
            wh = build_dimensions(spark, points, warehouse_root)
        loaded = incremental_load(wh, raw, set(years) if years else None)
        steps.append(("load", "OK", f"years not yet loaded, attempted: {sorted(r[0] for r in loaded.collect())}"))
    else:
        wh = build_warehouse(spark, raw, points, warehouse_root)
        steps.append(("load", "OK", f"{wh.manifest.get(FACT, 0)} fact rows"))

    for r in quality.dq_report(wh).collect():
        steps.append((f"dq:{r['check']}", r["status"], r["detail"]))

    if reports_dir:
        # Parsed once for the analyses and the stored dashboard datasets, which take over the changed years only.
        source, stored = (Snapshots(spark, f"{root}/{name}") for root, name in (
            (warehouse_root, "extracts"), (reports_dir, "datasets")))
        known = source.snapshot().version
        delivered = sorted(r[0] for r in loaded.collect()) if incremental and known else None
        if delivered != []:
            extracts.deliver(source, raw, delivered)
        typed = extracts.typed(source)
        n = extracts.oversize(source).count()
        steps.append(("extract:oversize", "WARN" if n else "OK", f"{n} rows with a measure too large for exact sums"))
        done = serving.refresh_serving(source, stored)
        steps.append(("datasets", "OK", f"years computed: {done}"))
        results = (exports.report_results(wh) | exports.analysis_results(typed, points)
                   | exports.serving_results(stored) | exports.quality_results(wh))
        steps += [(f"export:{name}", status, detail) for name, status, detail in exports.write_results(results, reports_dir)]
    return spark.createDataFrame(steps, "step string, status string, detail string")

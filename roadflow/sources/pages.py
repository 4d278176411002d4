"""Paged JSON extracts: ``{data: [rows], total, last_page, per_page}``.

The source system serves its extract in pages of 1,000 rows.  Page files
land in a folder (one JSON envelope per line) and are read with an
explicit schema and flattened with ``explode`` - no per-page loop.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import with_dense_key
from ..schemas import CORRUPT, PAGE_ENVELOPE_SCHEMA, with_corrupt

PER_PAGE = 1000
PAGES_PER_TASK = 200


@dataclass(frozen=True)
class PagedRows:
    """Rows numbered by ``page``, stored, and how many there are."""

    rows: DataFrame
    total: int
    per_page: int

    @property
    def last_page(self) -> int:
        return (self.total + self.per_page - 1) // self.per_page


def number_pages(rows: DataFrame, order_cols: list[str], per_page: int = PER_PAGE) -> PagedRows:
    """Deals ``rows`` out to pages of ``per_page`` rows in ``order_cols`` order."""
    keyed = with_dense_key(rows, "_row", order_cols, key_type="bigint")
    total = int(keyed.agg(F.count(F.lit(1)).alias("n")).first()["n"])
    return PagedRows(keyed.withColumn("page", (F.expr(f"(_row - 1) div {per_page}") + 1)).drop("_row"), total, per_page)


def envelopes_of(paged: PagedRows, record: list[Column], attach: Callable[[DataFrame], DataFrame] | None = None,
                 where: Column | None = None) -> DataFrame:
    """The envelopes of all pages, or of those that ``where`` (over ``page``) names: the others' rows are not moved.

    Each page holds at most ``per_page`` rows, so the per-page collect is
    bounded whatever the table size, and each task makes a bounded number of
    pages. ``attach`` joins small tables to the rows once they are dealt out,
    and ``record`` gives a record's columns: only the stored rows are moved."""
    spark, rows, n = paged.rows.sparkSession, paged.rows, paged.last_page
    if where is not None:
        rows = rows.where(where)
        n = spark.range(1, n + 1).withColumnRenamed("id", "page").where(where).count()
    dealt = rows.repartition(max(1, -(-n // PAGES_PER_TASK)), "page")
    env = (attach(dealt) if attach else dealt).groupBy("page").agg(F.collect_list(F.struct(*record)).alias("data"))
    return env.select(
        "data",
        F.lit(paged.total).cast("bigint").alias("total"),
        F.lit(paged.last_page).cast("bigint").alias("last_page"),
        F.lit(paged.per_page).cast("int").alias("per_page"),
        F.col("page").alias("current_page"),
    )


def build_envelopes(rows: DataFrame, order_cols: list[str], per_page: int = PER_PAGE,
                    record: list[Column] | None = None) -> DataFrame:
    """Cut ``rows`` into pages of ``per_page`` rows in ``order_cols`` order.

    ``record`` gives a record's columns where they are wider than the rows they
    are computed from: only the rows are numbered and dealt out to the pages."""
    record = record or [F.col(c) for c in rows.columns if c not in order_cols]
    return envelopes_of(number_pages(rows, order_cols, per_page), record)


def write_page_files(envelopes: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Page files, compressed: as plain text they are many times the extract's size."""
    envelopes.write.mode(mode).option("compression", "gzip").json(path)


def page_lines(spark: SparkSession, path: str) -> DataFrame:
    """The page files' lines as text (``value``), with their page number."""
    return spark.read.text(path).withColumn("page", F.get_json_object("value", "$.current_page").cast("long"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page envelopes; a page that is no valid JSON is kept as text in ``_corrupt``."""
    return spark.read.schema(with_corrupt(PAGE_ENVELOPE_SCHEMA)).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def corrupt_pages(envelopes: DataFrame) -> DataFrame:
    """The number of pages that could not be parsed."""
    # Spark refuses to read only the corrupt-record column, so another one is counted with it.
    return envelopes.agg(F.count(F.when(F.col(CORRUPT).isNotNull(), F.lit(1))).alias("corrupt_pages"),
                         F.count("total").alias("parsed_pages"))


def flatten_pages(envelopes: DataFrame) -> DataFrame:
    """Page envelopes -> one row per record."""
    return envelopes.select(F.explode("data").alias("r")).select("r.*")


def pages_completeness(envelopes: DataFrame) -> DataFrame:
    """Pages and rows received against the envelope's ``last_page`` and
    ``total``."""
    g = envelopes.agg(
        F.count(F.lit(1)).alias("pages_received"),
        F.count_distinct("current_page").alias("distinct_pages"),
        F.max("last_page").alias("last_page"),
        F.coalesce(F.sum(F.size("data")), F.lit(0)).cast("bigint").alias("rows_received"),
        F.max("total").alias("total"),
    )
    # a corrupt page has no data, so its rows are missing from the count
    return g.withColumn(
        "complete",
        (F.col("distinct_pages") == F.col("last_page")) & (F.col("rows_received") == F.col("total")),
    )


def page_gaps(envelopes: DataFrame) -> DataFrame:
    """Which pages lack, came more than once, or lie beyond the last one: runs of neighbouring pages as
    ``(problem, first_page, last_page, pages, copies)``.

    Pages of a kind are numbered densely in page order; along a run, page and
    number grow together, so their difference names the run. No page list is
    gathered in one place: the numbering is range-partitioned."""
    last = envelopes.agg(F.max("last_page")).first()[0] or 0
    came = envelopes.where(F.col("current_page").isNotNull()).groupBy(F.col("current_page").alias("page")).agg(
        F.count(F.lit(1)).alias("copies"))
    expected = envelopes.sparkSession.range(1, last + 1).withColumnRenamed("id", "page")
    missing = expected.join(came, "page", "left_anti").select(
        F.lit("missing").alias("problem"), "page", F.lit(0).cast("long").alias("copies"))
    inside = F.col("page").between(1, last)
    wrong = came.where(~inside | (F.col("copies") > 1)).select(
        F.when(inside, "repeated").otherwise("unexpected").alias("problem"), "page", "copies")
    kinds = ["problem", "copies"]
    numbered = with_dense_key(missing.unionByName(wrong), "_n", [*kinds, "page"], key_type="bigint")
    runs = numbered.groupBy(*kinds, (F.col("page") - F.col("_n")).alias("_run")).agg(
        F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.count(F.lit(1)).alias("pages"))
    return runs.select("problem", "first_page", "last_page", "pages", "copies")

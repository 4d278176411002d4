"""Readers for the raw extracts as they arrive (CSV / Parquet / JSON pages).

A CSV is read as text by its header: columns are found by name, in any order,
and extra ones are ignored.  The wanted columns are then cast to the declared
types, with no inference pass.  Ids written as ``3.0`` are whole numbers, and
the usual words for a missing value are NULL.  The files of one folder share a
header; a file with another one fails the read by name.  What does not fit its type is
NULL and counted by :func:`malformed_counts`; raw measures stay text, so that
the cleaner decides how bad values are coerced.  Files are split by the reader
(``spark.sql.files.maxPartitionBytes``), so a large extract is scanned in
parallel without any chunk loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CORRUPT, COUNT_POINTS_SCHEMA, RAW_AADF_SCHEMA, RAW_COUNTS_SCHEMA, ROAD_SEGMENT_SCHEMA

# Cell texts that mean a missing value.
MISSING_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                 "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
BAD_CELLS = "_bad_cells"


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV (a read of one line of each file's head)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def _cell(name: str) -> Column:
    text = F.trim(F.col(f"`{name}`"))
    return F.when(~text.isin(MISSING_WORDS), text)


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.regexp_replace(text, r"\.0*$", "").try_cast(kind)
    return text.try_cast(kind)


def read_text_csv(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """The wanted columns with ``_bad_cells`` (cells that do not fit their type) and ``_corrupt`` (a malformed line).

    Fails, naming it, if a wanted column is not in the header."""
    found = header_of(spark, path)
    wanted = [f for f in schema.fields if columns is None or f.name in columns]
    absent = [f.name for f in wanted if f.name not in found]
    if absent:
        raise ValueError(f"{path} lacks columns {absent}; its header is {found}")
    lines = T.StructType([T.StructField(c, T.StringType()) for c in found] + [T.StructField(CORRUPT, T.StringType())])
    raw = spark.read.schema(lines).option("header", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False).csv(path)
    cells = {f.name: _cell(f.name) for f in wanted}
    typed = {f.name: _typed(cells[f.name], f.dataType) for f in wanted}
    bad = [(cells[n].isNotNull() & typed[n].isNull()).cast("int") for n in typed]
    order = columns or [f.name for f in wanted]
    return raw.select(*[typed[n].alias(n) for n in order], reduce(lambda a, b: a + b, bad, F.lit(0)).alias(BAD_CELLS),
                      F.col(CORRUPT))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    return read_text_csv(spark, path, schema, columns).drop(BAD_CELLS, CORRUPT)


def malformed_counts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows, cells that do not fit their type, and malformed lines of a CSV: one aggregate."""
    return read_text_csv(spark, path, schema).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(BAD_CELLS), F.lit(0)).cast("bigint").alias("bad_cells"),
        F.count(CORRUPT).alias("malformed_lines"))


def read_raw_aadf_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return read_csv(spark, path, RAW_AADF_SCHEMA, columns)


def read_count_points_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    return read_csv(spark, path, COUNT_POINTS_SCHEMA, columns)


def read_raw_counts_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    # count_date is declared as a date and cast to one
    return read_csv(spark, path, RAW_COUNTS_SCHEMA, columns)


def read_road_segments_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ROAD_SEGMENT_SCHEMA)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    """First rows of an extract (the 'peek' read)."""
    return df.limit(n)

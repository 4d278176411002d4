"""Cleaning and validation of raw AADF extracts (one pass each)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_text_over_range, coerce_measure, over_range, parse_double
from ..schemas import (
    KEY_COLS, REQUIRED_COLS, VALID_DIRECTIONS, VALID_ROAD_CATEGORIES, VEHICLE_COLS,
    YEAR_MAX, YEAR_MIN,
)


def keep_predicate(df: DataFrame) -> Column:
    """Row filter of the cleaner: keys present, valid direction, year in range."""
    missing = [c for c in KEY_COLS if c not in df.columns]
    if missing:
        raise ValueError(f"raw AADF lacks key columns {missing}")
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in KEY_COLS])
    if "direction_of_travel" in df.columns:
        cond = cond & F.col("direction_of_travel").isin(VALID_DIRECTIONS)
    if "year" in df.columns:
        cond = cond & F.col("year").between(YEAR_MIN, YEAR_MAX)
    return F.coalesce(cond, F.lit(False))


def clean_aadf(df: DataFrame, measure_type: str = "double") -> DataFrame:
    """Coerce measures (bad text -> 0, negatives -> 0), drop rows with a
    missing key, an invalid direction or a year outside 2000-2025.  Road
    category is not filtered.  Measures come out as ``measure_type``
    (double by default; the fact load asks for its decimal type)."""
    dtypes = dict(df.dtypes)
    present = [c for c in VEHICLE_COLS if c in df.columns]
    coerced = df.withColumns({c: coerce_measure(c, dtypes[c], measure_type) for c in present})
    return coerced.where(keep_predicate(df))


def any_over_range(df: DataFrame, measure_type: str) -> Column:
    """Whether a row holds a measure that is too large for ``measure_type``."""
    dtypes = dict(df.dtypes)
    texts = [c for c in VEHICLE_COLS if dtypes.get(c) == "string"]
    numbers = [c for c in VEHICLE_COLS if c in dtypes and c not in texts]
    found = any_text_over_range(texts, measure_type) if texts else F.lit(False)
    return reduce(lambda a, b: a | b, [over_range(c, dtypes[c], measure_type) for c in numbers], found)


def clean_summary(df: DataFrame) -> DataFrame:
    """initial / kept / dropped row counts of :func:`clean_aadf`, one pass."""
    keep = keep_predicate(df)
    return df.agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(keep).alias("kept_rows"),
    ).withColumn("dropped_rows", F.col("initial_rows") - F.col("kept_rows"))


def _numeric(df: DataFrame, c: str) -> Column:
    if dict(df.dtypes)[c] == "string":
        return parse_double(c)
    return F.col(c).cast("double")


def validate_aadf(df: DataFrame) -> DataFrame:
    """Issues found in a raw extract, as rows ``(issue, detail, n)``.

    * ``missing_columns`` - one row per absent required column (n NULL)
    * ``negative_<measure>`` - rows with a negative number
    * ``invalid_directions`` / ``invalid_road_categories`` - one row per
      bad value with its row count
    * ``null_values`` - one row per required column holding NULLs

    An empty result means the extract is valid.
    """
    spark = df.sparkSession
    schema = "issue string, detail string, n bigint"
    parts: list[DataFrame] = []

    missing = [c for c in REQUIRED_COLS if c not in df.columns]
    if missing:
        parts.append(spark.createDataFrame([("missing_columns", c, None) for c in missing], schema))

    # Negative counts and null counts: one aggregate over the whole extract.
    counters = []
    types = dict(df.dtypes)
    for c in VEHICLE_COLS:
        if c in df.columns:
            if types[c] == "string":
                # a negative number is written with a leading '-': only those
                # values are parsed (CASE short-circuits the pattern check)
                neg = F.when(F.trim(F.col(c)).startswith("-"), _numeric(df, c) < 0)
            else:
                neg = F.col(c) < 0
            counters.append(F.count_if(F.coalesce(neg, F.lit(False))).alias(f"negative_{c}|"))
    for c in REQUIRED_COLS:
        if c in df.columns:
            counters.append(F.count_if(F.col(c).isNull()).alias(f"null_values|{c}"))
    if counters:
        wide = df.agg(*counters)
        long = wide.unpivot([], wide.columns, "key", "n")
        parts.append(
            long.where(F.col("n") > 0).select(
                F.split_part("key", F.lit("|"), F.lit(1)).alias("issue"),
                F.nullif(F.split_part("key", F.lit("|"), F.lit(2)), F.lit("")).alias("detail"),
                F.col("n").cast("bigint").alias("n"),
            )
        )

    for col, valid, issue in (
        ("direction_of_travel", VALID_DIRECTIONS, "invalid_directions"),
        ("road_category", VALID_ROAD_CATEGORIES, "invalid_road_categories"),
    ):
        if col in df.columns:
            bad = (
                df.where(F.col(col).isNotNull() & ~F.col(col).isin(valid))
                .groupBy(col)
                .agg(F.count(F.lit(1)).alias("n"))
            )
            parts.append(bad.select(F.lit(issue).alias("issue"), F.col(col).alias("detail"), "n"))

    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)

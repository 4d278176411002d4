"""Exact distinct counts that merge.

A count of distinct keys cannot be added to another; a set can. The set of a
group is kept as bitmaps, one for each block of 32,768 key numbers, so partial
results of batches, years or regions can be stored and merged later, and counted
at any coarser grouping, without their rows. Keys must be whole numbers; dense
ones (surrogate keys) fill their bitmaps best.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = "block"


def key_bitmaps(df: DataFrame, groups: list[str], key: str, to: str = "keys") -> DataFrame:
    """``groups``, ``block`` and the bitmap of the keys that a group holds in it; null keys are left out.

    Keys are made distinct first, combined in the map task, so a bitmap is
    built from at most 32,768 rows however often a key occurs."""
    number = F.col(key).cast("long")
    once = df.where(F.col(key).isNotNull()).select(*groups, number.alias(to)).distinct()
    return once.groupBy(*groups, F.bitmap_bucket_number(to).alias(BLOCK)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(to)).alias(to))


def merge_bitmaps(parts: list[DataFrame] | DataFrame, groups: list[str], to: str = "keys") -> DataFrame:
    """Bitmaps of the same shape, merged to ``groups`` (all of the parts' groups, or fewer)."""
    rows = parts if isinstance(parts, DataFrame) else reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*groups, BLOCK).agg(F.bitmap_or_agg(to).alias(to))


def count_keys(bitmaps: DataFrame, groups: list[str], alias: str, of: str = "keys") -> DataFrame:
    """Distinct keys of each group (one row for no groups)."""
    merged = merge_bitmaps(bitmaps, groups, of)
    return merged.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count(of)), F.lit(0)).alias(alias))

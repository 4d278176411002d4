"""Dense surrogate keys without a single-task global window.

Rows are range-partitioned on the ordering columns and sorted inside each
partition; the position inside a partition comes from
``monotonically_increasing_id`` and the partition's start offset from a
tiny per-partition count table (one row per partition, so its size is
bounded by the partition count, not by the data).  The tagged rows are
written first, as Parquet files, so both passes see the same partitioning.  Keys are
1..n in the order of ``order_cols``; equal to ``row_number() OVER (ORDER
BY order_cols)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, shared_dir
from .joins import input_bytes


TARGET_PARTITION_BYTES = 16 * 1024 * 1024
#: Sizes from here on are the planner's stand-in for "unknown" (the largest long, or products of it).
UNKNOWN_BYTES = 1 << 60


def partitions_for(df: DataFrame) -> int:
    """Range partitions of ~16 MB of input files each (compressed columns; as
    rows they are many times that): a small dimension gets a handful, a large
    input as many as its size asks for.  An input whose size
    the planner does not know gets the session's number of shuffle partitions."""
    size = input_bytes(df)
    if size >= UNKNOWN_BYTES:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // TARGET_PARTITION_BYTES))


def with_dense_key(df: DataFrame, key: str, order_cols: list[str], num_partitions: int | None = None,
                   key_type: str = "int") -> DataFrame:
    """``key_type`` is ``int`` for dimensions (under 2^31 members) and must be
    ``bigint`` where rows are numbered."""
    shared_dir(df.sparkSession)  # make sure a checkpoint folder is registered
    n = num_partitions or partitions_for(df)
    tagged = materialise(
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_kp", F.spark_partition_id())
        .withColumn("_km", F.monotonically_increasing_id()), "numbered")
    counts = tagged.groupBy("_kp").agg(F.count(F.lit(1)).alias("_kn"), F.min("_km").alias("_k0"))
    w = Window.orderBy("_kp").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_koff", F.coalesce(F.sum("_kn").over(w), F.lit(0))).select("_kp", "_k0", "_koff")
    # Counted once, not by every job that reads the keys; a row per partition.
    out = tagged.join(F.broadcast(offsets.checkpoint(eager=True)), "_kp")
    out = out.withColumn(key, (F.col("_koff") + F.col("_km") - F.col("_k0") + 1).cast(key_type))
    return out.drop("_kp", "_km", "_k0", "_koff", "_kn")


def with_stable_key(members: DataFrame, known: DataFrame | None, key: str, natural: list[str]) -> tuple[DataFrame, DataFrame]:
    """(members with ``key``, the registry): members that ``known`` holds keep
    their keys, new ones get dense keys after its highest.

    ``members`` are distinct in ``natural``; ``known`` is the registry of an
    earlier refresh (``natural`` columns and ``key``), or None.  The registry
    also keeps members that are gone, so a key is never given out twice."""
    if known is None:
        keyed = with_dense_key(members, key, natural)
        return keyed, keyed.select(*natural, key)
    old = known.select(*[F.col(c).alias(f"_k_{c}") for c in natural], F.col(key).alias(key))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in natural])
    # Written once: both the found and the new members come from it. Read as files they have their real size, where
    # a checkpoint keeps the planner's estimate of the join, the product of both sides, and as many partitions.
    found = materialise(members.join(old, same, "left").drop(*[f"_k_{c}" for c in natural]), "members")
    highest = known.agg(F.max(key)).first()[0] or 0
    new = with_dense_key(found.where(F.col(key).isNull()).drop(key), key, natural)
    new = new.withColumn(key, (F.col(key) + F.lit(highest)).cast(dict(old.dtypes)[key]))
    keyed = found.where(F.col(key).isNotNull()).unionByName(new)
    return keyed, known.select(*natural, key).unionByName(new.select(*natural, key))

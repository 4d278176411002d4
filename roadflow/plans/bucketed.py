"""A copy of the fact and the count points, bucketed alike on the point key.

Where the point dimension is too large to broadcast, every report that joins it
would shuffle the fact, or its partial sums, by point. Stored in buckets of the
point key, both sides are dealt out already: the sums per point and the join
with the dimension run in the scan's tasks, without an exchange.

The tables stand in the session's catalogue under names of their own, their
files in the shared folder. Reports take a :class:`BucketedWarehouse` as they
take any other; year predicates still prune partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import STORED, new_output_dir
from .warehouse import FACT, FACT_COLUMNS, Warehouse

POINTS = "DimCountPoint"


class BucketedWarehouse(Warehouse):
    """A snapshot whose fact and count points are read from bucketed copies."""

    def __init__(self, wh: Warehouse, names: dict[str, str], buckets: int):
        super().__init__(wh.spark, wh.store.base, wh.snapshot)
        self.names, self.buckets = names, buckets

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.names[name]) if name in self.names else super().table(name)

    def dim(self, name: str, broadcast: bool = True) -> DataFrame:
        return self.table(name) if name == POINTS else super().dim(name, broadcast)

    def broadcastable(self, name: str) -> bool:
        return name != POINTS and super().broadcastable(name)

    def drop(self) -> None:
        """Takes the tables out of the catalogue (their files stay)."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def bucketed(wh: Warehouse, buckets: int = 64) -> BucketedWarehouse:
    """Writes the bucketed copies. ``buckets`` should be the number of tasks that a scan of the fact is worth.

    Rows are dealt out by bucket and year before they are written, so each
    bucket of a year is few files, and adaptive execution splits those that are
    larger than the advisory size: a point that holds a third of all rows is
    written by many tasks."""
    tag, names = uuid.uuid4().hex[:12], {}
    for name, df in ((FACT, wh.fact.select(*FACT_COLUMNS)), (POINTS, wh.table(POINTS))):
        by = ["DateKey"] if name == FACT else []
        # The bucket in which Spark puts a key.
        dealt = df.withColumn("_bucket", F.pmod(F.hash("CountPointKey"), F.lit(buckets)))
        dealt = dealt.hint("rebalance", "_bucket", *by).drop("_bucket")
        names[name] = f"bucketed_{name.lower()}_{tag}"
        writer = dealt.write.bucketBy(buckets, "CountPointKey").sortBy("CountPointKey").options(**STORED)
        (writer.partitionBy(*by) if by else writer).option(
            "path", new_output_dir(wh.spark, f"bucketed-{name}")).saveAsTable(names[name])
    return BucketedWarehouse(wh, names, buckets)

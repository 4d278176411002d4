"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension hinted as broadcast; above it the planner (and AQE at
# run time, from actual shuffle sizes) chooses between broadcast and a
# shuffled join.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (no job is run)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - estimate unavailable
        return None


def row_bytes(df: DataFrame) -> int:
    """Bytes of a row as the planner counts them: each type's default size plus a header."""
    return 8 + df._jdf.schema().defaultSize()


def input_bytes(df: DataFrame) -> int:
    """Bytes of the scans below ``df``.  Unlike the estimate of a join, which
    multiplies its sides, this stays near the size of the result when each
    row finds one partner."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, known_rows: int | None = None,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint ``df`` as broadcast only when it is provably small.

    ``known_rows`` (e.g. from the warehouse manifest) is checked against
    ``max_rows`` and, times the width of a row in Spark's own estimate, against
    ``max_bytes``; otherwise the optimizer's byte estimate is checked.  A side that is too big, or of unknown size, is returned
    unhinted so the planner can choose a shuffled join.
    """
    if known_rows is not None:
        small = known_rows <= max_rows and known_rows * row_bytes(df) <= max_bytes
        return F.broadcast(df) if small else df
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df

"""Exact dedup by a heavy-hitter split.

Texts are equal when identical after deleting white space. A narrow table of
digests is written once; all later steps read only it.

1. Each task summarises its digests with a Misra-Gries sketch of ``k``
   counters; the summed sketches name at most ``k`` candidates and miss no
   digest with more than 2 / (k + 1) of all rows.
2. Candidates are verified: their exact size and the row that stays come from
   a map-side combined aggregate over all rows.
3. The verified winners (at most ``k`` rows) are broadcast, and rows of heavy
   digests are settled in the map task, without a shuffle. All other digests,
   none of which is large, are shuffled on the digest.

Defined results: null text is an empty text; a null id is a document like any
other but loses ties against other ids; rows repeated in full are copies, of
which one is kept; texts of any length are read whole; an empty table gives an
empty result. Other columns of the
input, whatever their names, are ignored by ``exact_groups`` and kept by
``drop_exact_duplicates``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, content_key, materialise, small_arrow_batches, survivors, text_of

#: Counters of a sketch, and so the most winners that are broadcast.
COUNTERS = 1024


def sketch(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries over a task's digests, fed in batches; at most ``counters`` counters are kept."""
    held: Counter = Counter()
    for batch in batches:
        held.update(batch.column(0).to_pylist())
        if len(held) > counters:
            cut = sorted(held.values(), reverse=True)[counters]
            held = Counter({d: n - cut for d, n in held.items() if n > cut})
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["digest", "n"])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: row, id, content key, length in code points, SHA-256 of the normalised text."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "id", content_key(F.col("text")).alias("key"),
        F.length("text").cast("long").alias("length"),
        F.unhex(F.sha2(F.regexp_replace("text", f"{SPACE}+", ""), 256)).alias("digest"))


def heavy_digests(table: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests; every digest with over 2 / (counters + 1) of all rows is among them."""
    small_arrow_batches(table.sparkSession)
    total = table.count()
    found = table.select("digest").mapInArrow(lambda it: sketch(it, counters), "digest binary, n long")
    return found.groupBy("digest").agg(F.sum("n").alias("n")).filter(
        F.col("n") > total / (counters + 1)).select("digest")


def _winners(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct(-F.col("length"), F.col("id").isNull(), F.col("id"), F.col("row")))
    return rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size")).select(
        "digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 counters: int = COUNTERS) -> DataFrame:
    """id, key, digest, keep_id, group_size, kept for each row of ``docs``."""
    table = materialise(digests(docs, id_col, text_col), "digests")
    candidates = F.broadcast(heavy_digests(table, counters))
    winners = F.broadcast(materialise(
        _winners(table.join(candidates, "digest")).filter("group_size > 1"), "winners"))
    settled = table.join(winners, "digest")
    rest = table.join(winners, "digest", "left_anti")
    out = settled.unionByName(rest.join(_winners(rest), "digest"))
    return out.select("id", "key", "digest", "keep_id", "group_size",
                      (F.col("row") == F.col("keep_row")).alias("kept"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row per group of equal texts, all columns as they were."""
    return survivors(docs, exact_groups(docs, id_col, text_col), id_col, text_col)

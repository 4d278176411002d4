"""SimHash near-dedup with pigeonring filtering.

Fingerprints are made per text in Python (bytes, xxhash, numpy); everything
after is DataFrame work on distinct 64-bit fingerprints.

A fingerprint is cut into ``m = 2 * distance + 1`` segments on a ring. If two
differ in at most ``distance`` bits, some segment starts a chain whose first l
segments together differ in at most l * distance / m bits, for every l. With
distance 2 and five segments: two neighbouring segments are equal, three and
four together differ in one bit at most. The equal pair is the join key; the
chain budgets prune candidates before the full Hamming check.

Buckets of more than ``BUCKET`` different fingerprints would make too many
pairs. There each fingerprint emits itself and its one-bit neighbours outside
the equal segments: two fingerprints are within two bits exactly if they share
one of these, so linking each to the smallest that shares it joins the same
components with linear work. No link is lost.

Defined results: null text is an empty text; texts without words have
fingerprint zero; null ids belong to components but never name one unless all
its ids are null; rows repeated in full are copies, of which a drop keeps one;
other columns of any name pass through ``drop_near_duplicates`` and are ignored
otherwise; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content_key, materialise, small_arrow_batches, survivors, text_of

SHINGLE, DISTANCE, SEED = 3, 2, 42
#: Different fingerprints in a bucket up to which they are compared pair by pair.
BUCKET = 64
_BLOCK = 1 << 15


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash: a bit is set if it is in over half of the shingle hashes, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    grams = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    hashes = np.fromiter((digest(join(g), SEED) for g in grams), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        votes += np.unpackbits(hashes[at:at + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """id, key, fp for each row of ``docs``."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    small_arrow_batches(docs.sparkSession)
    text = text_of(text_col)
    return docs.select(F.col(id_col).alias("id"), content_key(text).alias("key"), fp(text).alias("fp"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def ring(distance: int = DISTANCE) -> list[list[int]]:
    """masks[i][l - 1]: the bits of the chain of l segments from segment i on."""
    m = 2 * distance + 1
    cuts = [round(k * 64 / m) for k in range(m + 1)]
    segments = [((1 << cuts[k + 1]) - 1) ^ ((1 << cuts[k]) - 1) for k in range(m)]
    return [[reduce(int.__or__, (segments[(i + k) % m] for k in range(length))) for length in range(1, m + 1)]
            for i in range(m)]


def links(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that join the same components as all pairs of ``fp`` within ``distance`` bits."""
    if distance != 2:
        raise ValueError("the one-bit neighbours of full buckets fit a distance of two only")
    masks, m = ring(distance), 2 * distance + 1
    equal = sum(length * distance < m for length in range(1, m + 1))  # leading segments with a budget below one bit
    keys = [F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(_signed(masks[i][equal - 1])).alias("part"))
            for i in range(m)]
    entries = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.start", "k.part")
    sizes = entries.groupBy("start", "part").agg(F.count("*").alias("n")).filter("n > 1")
    entries = materialise(entries.join(sizes, ["start", "part"]), "buckets")

    light = entries.filter(F.col("n") <= bucket)
    left, right = (light.select("start", "part", F.col("fp").alias(x)) for x in "ab")
    differ = F.col("a").bitwiseXOR(F.col("b"))

    def within(length: int) -> Column:
        mask = F.element_at(F.array(*[F.lit(_signed(masks[i][length - 1])) for i in range(m)]), F.col("start") + 1)
        return F.bit_count(differ.bitwiseAND(mask)) <= length * distance // m

    chain = reduce(Column.__and__, (within(length) for length in range(equal + 1, m + 1)))
    pairs = left.join(right, ["start", "part"]).filter((F.col("a") < F.col("b")) & chain).select("a", "b")

    full = entries.filter(F.col("n") > bucket)
    free = [F.lit(_signed(1 << bit)) for bit in range(64)]
    taken = F.element_at(F.array(*[F.lit(_signed(masks[i][equal - 1])) for i in range(m)]), F.col("start") + 1)
    near = F.transform(F.filter(F.array(F.lit(0).cast("long"), *free), lambda f: taken.bitwiseAND(f) == 0),
                       lambda f: F.col("fp").bitwiseXOR(f))
    around = full.select("fp", F.explode(near).alias("point")).distinct()
    smallest = around.groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    stars = around.join(smallest, "point").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) of the graph's nodes, by alternating large and small stars.

    Each round is written to the shared folder; nothing but counts reaches the driver.
    """
    def star(table: DataFrame, large: bool) -> DataFrame:
        both = table.unionByName(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        seen = both if large else both.filter("b < a")
        # Written, so that the join meets two plain shuffles and adaptive execution can split a hub's edges.
        least = materialise(seen.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        moved = seen.join(least, "a")
        if large:
            out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b")))
        return out.filter("a <> b")

    def starred(table: DataFrame) -> bool:
        """Whether the edges are stars: no node is at both ends of edges, and none leads to two roots."""
        ends = table.select(F.col("a").alias("node"), F.lit(1).alias("end")).unionByName(
            table.select(F.col("b").alias("node"), F.lit(2).alias("end")))
        return ends.groupBy("node").agg(F.bit_or("end").alias("ends"), F.count_if(F.col("end") == 1).alias("roots")).filter(
            "ends = 3 OR roots > 1").isEmpty()

    table = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    while not starred(table):
        table = materialise(star(star(table, True), False).distinct(), "stars")
    return table.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        table.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """id, key, fp, component_id (smallest id of the component), kept for each row of ``docs``."""
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("key")))
    distinct = materialise(rows.groupBy("fp").agg(first.alias("first")), "distinct")
    roots = components(links(distinct, distance, bucket))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("name"))
    named = rooted.join(names, "root").select("fp", "name")
    return rows.join(named, "fp").select(
        "id", "key", "fp", F.col("name.id").alias("component_id"),
        (F.col("id").eqNullSafe(F.col("name.id")) & (F.col("key") == F.col("name.key"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the row of the smallest id of each component, all columns as they were."""
    return survivors(docs, near_groups(docs, id_col, text_col), id_col, text_col)

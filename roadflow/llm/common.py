"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.session import new_output_dir

#: The contract's white space ([\x20\x09-\x0D]).
SPACE = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
#: Text handed to Python at a time; a single longer text still goes whole.
ARROW_ROWS, ARROW_BYTES = "256", "4m"
#: A side is broadcast only when its counted rows times its row width stay under this.
BROADCAST_BYTES = 32 << 20
_BLOCK = 128
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: writes the rows to the shared folder and reads them back.

    Files in ``spark.checkpoint.dir`` outlive any executor, so a lost executor
    costs a re-read, not a recomputation of the whole history.
    """
    path = new_output_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_arrow_batches(spark: SparkSession) -> None:
    """Readies a session for Python workers: bounds what one Arrow batch holds, whatever the text lengths,
    and lets workers import this package from where the driver has it (on a cluster it is installed there,
    or sent with --py-files)."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast hint when ``rows`` (counted, not estimated) proves the side small; else Spark plans a shuffle."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that does not clash with any of ``df`` (Spark resolves names in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, not once per use."""
    return F.transform(F.array(value), body)[0]


def _scan(numbers: Column) -> Column:
    """[0, a1, a1+a2, ...]; one entry more than ``numbers``. Only for short arrays."""
    return F.aggregate(
        numbers, F.array(F.lit(0).cast("long")),
        lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))


def offsets(numbers: Column) -> Column:
    """Exclusive prefix sums of an array of longs.

    Two levels of short blocks, so the copying that an array accumulator
    costs stays near-linear for very long arrays.
    """
    def blocks(a: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(a) - 1) / F.lit(_BLOCK)).cast("int")),
            lambda b: _scan(F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK))))

    def joined(scanned: Column) -> Column:
        return let(
            _scan(F.transform(scanned, lambda s: F.element_at(s, -1))),
            lambda base: F.flatten(F.transform(
                scanned, lambda s, i: F.transform(
                    F.slice(s, F.lit(1), F.size(s) - 1), lambda v: v + F.get(base, i)))))

    return let(numbers, lambda a: F.when(F.size(a) > 0, let(blocks(a), joined)).otherwise(
        F.array().cast("array<bigint>")))


SPAN = "array<struct<start:bigint,end:bigint,kind:string,match:string>>"


def match_spans(text: Column, pattern: str, kind: str, keep: Callable[[Column], Column] | None = None,
                may: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as (start, end, kind, match), in code points, end exclusive.

    SQL has no function for match positions; the pieces between the matches
    give them: each match starts after the pieces and matches before it.
    ``may`` is a cheap test that is true wherever the pattern can match.
    """
    def located(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
        return let(gaps, lambda g: let(
            offsets(F.zip_with(F.slice(g, F.lit(1), F.size(found)), found, lambda a, m: a + F.length(m))),
            lambda before: F.zip_with(
                F.zip_with(before, F.slice(g, F.lit(1), F.size(found)), lambda b, a: b + a), found,
                lambda start, m: F.struct(
                    start.alias("start"), (start + F.length(m)).alias("end"),
                    F.lit(kind).alias("kind"), m.alias("match")))))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if may is not None:
        found = F.when(may, found).otherwise(F.array().cast("array<string>"))
    empty = F.array().cast(SPAN)
    spans = let(found, lambda f: F.when(F.size(f) > 0, located(f)).otherwise(empty))
    return F.filter(spans, lambda s: keep(s["match"])) if keep else spans


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def content_key(text: Column) -> Column:
    """Identifies a text next to its doc_id: rows equal in both are interchangeable copies."""
    return F.xxhash64(text, F.length(text))


def drop_rows(docs: DataFrame, dropped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows whose (id, content key) is in ``dropped`` (``id``, ``key``; null ids match).

    ``dropped`` must be materialised: it is counted, and broadcast only if small.
    """
    key, gone_id, gone_key = (fresh(docs, n) for n in ("__key", "__gone_id", "__gone_key"))
    gone = broadcast_if_small(dropped.select(F.col("id").alias(gone_id), F.col("key").alias(gone_key)),
                              dropped.count(), 64)
    keyed = docs.withColumn(key, content_key(text_of(text_col)))
    return keyed.join(gone, keyed[id_col].eqNullSafe(F.col(gone_id))
                      & (keyed[key] == F.col(gone_key)), "left_anti").drop(key)


def survivors(docs: DataFrame, verdict: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` reduced to one row per group.

    ``verdict`` has a row (``id``, ``key``, ``kept``) for each row of ``docs``.
    Rows equal in (id, key) are copies of one another; where one of them is
    kept, exactly one of them stays.
    """
    rows = materialise(verdict.groupBy("id", "key").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
                       .filter(~F.col("kept") | (F.col("n") > 1)), "verdict")
    out = drop_rows(docs, rows.filter(~F.col("kept")), id_col, text_col)
    again = rows.filter("kept")
    if again.isEmpty():
        return out
    key, again_id, again_key = (fresh(docs, n) for n in ("__key", "__again_id", "__again_key"))
    keyed = out.withColumn(key, content_key(text_of(text_col)))
    again = again.select(F.col("id").alias(again_id), F.col("key").alias(again_key))
    on = keyed[id_col].eqNullSafe(F.col(again_id)) & (keyed[key] == F.col(again_key))
    copies = keyed.join(again, on, "left_semi").dropDuplicates([id_col, key])
    return keyed.join(again, on, "left_anti").unionByName(copies).drop(key)


def replace_spans(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """``text`` with each span (sorted by start) replaced by ``label(span)``; of overlapping spans the first counts."""
    def step(acc: Column, s: Column) -> Column:
        taken = F.struct(
            F.concat(acc["out"], F.substring(text, acc["end"] + 1, s["start"] - acc["end"]), label(s)).alias("out"),
            s["end"].cast("int").alias("end"))
        return F.when(s["start"] >= acc["end"], taken).otherwise(acc)

    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("end"))
    done = F.aggregate(spans, zero, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["end"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def ordered(spans: Column, kinds: list[str], kind_first: bool) -> Column:
    """Spans as (start, end, kind), by start then kind in the order of ``kinds``, or by kind first."""
    place = F.array(*[F.lit(k) for k in kinds])

    def key(s: Column) -> Column:
        at = F.array_position(place, s["kind"]).alias("at")
        first = [at, s["start"].alias("start")] if kind_first else [s["start"].alias("start"), at]
        return F.struct(*first, s["end"].alias("end"), s["kind"].alias("kind"))

    return F.transform(F.array_sort(F.transform(spans, key)), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

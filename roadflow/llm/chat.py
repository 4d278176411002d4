r"""Chat formatting by prefix-target expansion.

A turn is formatted as ``<|im_start|>role``, a line end, the text,
``<|im_end|>`` and a line end. Control strings inside texts are escaped by one
more backslash between ``<`` and ``|``, so no text holds a mark, and reading
back takes the backslash away.

Every assistant turn becomes an example of its own: all turns before it are its
context, and only its text is trainable. The context of an example is a prefix
of its conversation's formatted text, and so of the next example's, so the
turns are stored once (``segments``) and an example holds where its prefix ends
and which characters are trainable (``examples``): the output grows with the
input, however long a conversation is. ``render`` writes examples out in full.
Turns after the last reply, or of a conversation without one, end in an example
that trains nothing, so that every turn is part of the output.

Places are running sums over a conversation, computed without gathering it:
turns are range-partitioned by conversation and turn, summed within each task,
and the sum that a conversation brings from earlier tasks (a row per task) is
added. A conversation may hold any share of all rows.

Defined results: null text and null role are empty; null ids are one
conversation; null turns come first; rows of one turn number are ordered by
role, then by a hash of the text; repeated rows are turns each; roles may hold
any characters; an empty table gives empty results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_arrow_batches

START, END = "<|im_start|>", "<|im_end|>"
REPLY = "assistant"
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*)" + re.escape(END) + r"\n", re.S)


# --------------------------------------------------------------------------
# Template
# --------------------------------------------------------------------------

def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"<(\\*)\|"), F.lit(r"<$1\\|"))


def header(role: Column) -> Column:
    """The opening mark and the role on one line, whatever the role holds."""
    one_line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.concat(F.lit(START), escaped(one_line), F.lit("\n"))


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def read_turn(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    role, text = _TURN.fullmatch(segment).groups()
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))
    return role, unescaped(text)


# --------------------------------------------------------------------------
# Places
# --------------------------------------------------------------------------

class Sums:
    """Running sums over the runs of equal ids in a partition's sorted rows."""

    def __init__(self):
        self.last: tuple = ()
        self.held = np.zeros(3, np.int64)
        self.runs = 0

    def add(self, ids: pd.Series, chars: pd.Series, reply: pd.Series) -> pd.DataFrame:
        """position, first character, replies before each row, and the number of its run."""
        keys = [(None,) if i is None or i is pd.NA else (i,) for i in ids]
        new = np.array([a != b for a, b in zip(keys, [self.last, *keys])], bool)
        step = np.stack([np.ones(len(keys), np.int64), chars.to_numpy(np.int64), reply.to_numpy(np.int64)], axis=1)
        before = np.cumsum(step, axis=0) - step
        run = np.cumsum(new)
        base = np.vstack([-self.held, before[new]])  # what the run had before its first row here
        out = before - base[run]
        self.held = out[-1] + step[-1]
        self.last = keys[-1]
        frame = pd.DataFrame(out, columns=["position", "start", "replies"])
        frame["run"] = run + self.runs
        self.runs += int(run[-1])
        return frame


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with their places, counted from the start of their partition (materialised)."""
    @F.pandas_udf("position long, start long, replies long, run long")
    def place(columns: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        sums = Sums()
        for ids, chars, reply in columns:
            yield sums.add(ids, chars, reply) if len(ids) else pd.DataFrame(
                columns=["position", "start", "replies", "run"], dtype="int64")

    small_arrow_batches(rows.sparkSession)
    order = ["id", "turn", "role", F.xxhash64("segment"), "segment"]
    # Equal rows may be many; their input place deals them out too.
    spread = rows.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(*order[:4], "at")
    spread = spread.sortWithinPartitions(*order)
    placed = spread.withColumn("part", F.spark_partition_id()).withColumn(
        "place", place(F.col("id").cast("string"), F.length("segment"), (F.col("role") == REPLY).cast("int")))
    return materialise(placed.select("id", "role", "segment", "opening", "part", "place.*"), "turns")


def _brought(placed: DataFrame) -> DataFrame:
    """part, position, start, replies: what the first conversation of a partition brings from earlier ones."""
    end = F.struct(F.col("id").cast("string").alias("id"), (F.col("position") + 1).alias("position"),
                   (F.col("start") + F.length("segment")).alias("start"),
                   (F.col("replies") + (F.col("role") == REPLY).cast("int")).alias("replies"))
    ends = placed.groupBy("part").agg(
        F.max("run").alias("runs"), F.max_by(end, F.struct("run", "position")).alias("last"),
        F.min_by(F.col("id").cast("string"), F.struct("run", "position")).alias("first")).orderBy("part")
    spark, out, held = placed.sparkSession, [], None
    for r in ends.collect():  # a row per partition
        mine = (0, 0, 0)
        if held is not None and held[0] == r["first"]:
            mine = held[1]
            out.append((r["part"], *mine))
        own = tuple(r["last"][1:])
        held = r["last"]["id"], tuple(a + b for a, b in zip(own, mine)) if r["runs"] == 1 else own
    return spark.createDataFrame(out, "part int, d_position long, d_start long, d_replies long")


def segments(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """id, position, role, segment (the formatted turn), start, end (its characters in the conversation's formatted
    text), text_start, text_end (those of its text) and replies (assistant turns before it)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.concat(header(role), escaped(text), F.lit(END + "\n")).alias("segment"),
        F.length(header(role)).alias("opening"))
    placed = _placed(rows)
    first = F.col("run") == 1
    brought = F.broadcast(_brought(placed).withColumnRenamed("part", "to_part"))  # a row per partition at most
    joined = placed.join(brought, (F.col("part") == F.col("to_part")) & first, "left")
    for c in ("position", "start", "replies"):
        joined = joined.withColumn(c, F.col(c) + F.coalesce(f"d_{c}", F.lit(0)))
    end = F.col("start") + F.length("segment")
    return joined.select("id", "position", "role", "segment", "start", end.alias("end"),
                         (F.col("start") + F.col("opening")).alias("text_start"),
                         (end - len(END) - 1).alias("text_end"), "replies")


def examples(formatted: DataFrame) -> DataFrame:
    """id, example, target (position of the trained turn; the last turn where none is), context_turns, context_chars,
    loss_start, loss_end (trainable characters) and chars (length of the whole example)."""
    turns = formatted.drop("segment")
    replies = turns.filter(F.col("role") == REPLY).select(
        "id", F.col("replies").alias("example"), F.col("position").alias("target"),
        F.col("position").alias("context_turns"), F.col("start").alias("context_chars"),
        F.col("text_start").alias("loss_start"), F.col("text_end").alias("loss_end"), F.col("end").alias("chars"))
    last = turns.groupBy("id").agg(F.max_by(F.struct("position", "role", "replies", "end"), "position").alias("t"))
    rest = last.filter(F.col("t.role") != REPLY).select(
        "id", F.col("t.replies").alias("example"), F.col("t.position").alias("target"),
        (F.col("t.position") + 1).alias("context_turns"), F.col("t.end").alias("context_chars"),
        F.col("t.end").alias("loss_start"), F.col("t.end").alias("loss_end"), F.col("t.end").alias("chars"))
    return replies.unionByName(rest)


def render(formatted: DataFrame, chosen: DataFrame) -> DataFrame:
    """id, example, text, loss_start, loss_end of the chosen examples, each with its whole context.

    Every prefix is copied, so the result is as large as the sum of ``chars``; a group is one example's text.
    """
    rows = formatted.select(F.col("id").alias("of"), "position", "segment")
    parts = chosen.join(rows, F.col("id").eqNullSafe(F.col("of")) & (F.col("position") <= F.col("target")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "segment"))),
                                    lambda s: s["segment"]), "")
    return parts.groupBy("id", "example", "loss_start", "loss_end").agg(text.alias("text")).select(
        "id", "example", "text", "loss_start", "loss_end")


# --------------------------------------------------------------------------
# Reading back
# --------------------------------------------------------------------------

class Reader:
    """One conversation, read from its stored pieces in order; holds a turn at a time."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = self.at = self.start = 0
        self.segment = ""

    def turn(self, segment: str) -> None:
        self.start, self.segment = self.at, segment
        self.at += len(segment)
        role, text = read_turn(segment)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1

    def example(self, loss_start: int, loss_end: int, chars: int) -> None:
        if chars != self.at or loss_start < self.start:
            raise ValueError("an example does not end with its target")
        trained = unescaped(self.segment[loss_start - self.start:loss_end - self.start])
        self.loss.update(trained.encode())
        self.loss_chars += len(trained)
        self.formatted_chars += chars


READ = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last, reader, out = (), None, []

    def row() -> tuple:
        return (*last, reader.n_turns, reader.turns.hexdigest(), reader.loss_chars, reader.loss.hexdigest(),
                reader.formatted_chars)

    for frame in frames:
        for i, segment, loss_start, loss_end, chars in zip(
                frame["id"], frame["segment"], frame["loss_start"], frame["loss_end"], frame["chars"]):
            key = (i if isinstance(i, str) else None,)
            if key != last:
                if reader:
                    out.append(row())
                last, reader = key, Reader()
            if isinstance(segment, str):
                reader.turn(segment)
            else:
                reader.example(int(loss_start), int(loss_end), int(chars))
        yield pd.DataFrame(out, columns=["id", *READ])
        out = []
    if reader:
        yield pd.DataFrame([row()], columns=["id", *READ])


def read_back(formatted: DataFrame, made: DataFrame) -> DataFrame:
    """id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (of all examples) for each conversation, from
    the stored turns and masks. A digest is sequential, so a conversation is streamed through one task, turn by turn."""
    kind = formatted.schema["id"].dataType.simpleString()
    none = F.lit(None).cast("long")
    small_arrow_batches(formatted.sparkSession)
    pieces = formatted.select("id", "position", F.lit(0).alias("kind"), "segment", none.alias("loss_start"),
                              none.alias("loss_end"), none.alias("chars"))
    masks = made.select("id", F.col("target").alias("position"), F.lit(1).alias("kind"),
                        F.lit(None).cast("string").alias("segment"), "loss_start", "loss_end", "chars")
    rows = pieces.unionByName(masks).repartition("id").sortWithinPartitions("id", "position", "kind")
    found = rows.select(F.col("id").cast("string").alias("id"), "segment", "loss_start", "loss_end", "chars").mapInPandas(
        _read, "id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return found.withColumn("id", F.col("id").cast(kind))

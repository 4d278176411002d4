"""Line dedup by content-defined chunks of lines.

Lines are cut where they end and, inside, at words that their own content
chooses: one word in some ``WORDS``, by a rolling hash over it and the word
before, ends a piece. So a long line is several pieces, and a passage is cut
alike wherever it begins. In the same way a rolling hash over the hashes of the
last two pieces chooses chunk boundaries, after one piece in ``PIECES``:
boundaries shift with the text, and a passage holds whole chunks in any context.

Chunks of at least ``MIN_PIECES`` pieces whose hash occurs more than once in the
corpus are seeds. The first of
equal chunks (smallest id, then earliest) is their owner; each other occurrence
is compared with the owner's bytes and then extended, piece by piece and at last
word by word, as far as the text before and after it equals the owner's: to the
passage's real ends, which lie inside the neighbouring chunks. A stretch along
one owner is a passage if it holds two whole lines or at least ``LEAST`` pieces
(some twenty words); passages are removed, but for their first occurrence. A
passage of fifty words holds no whole chunk, and stays, in fewer than one case
in a hundred.

Hashes are counted with map-side combining, occurrences meet their owner in a
join that adaptive execution splits where a chunk is frequent; no chunk's rows
are gathered in one task.

Defined results: null text is an empty text of one empty line; rows equal in id
and text are one document, which is no copy of itself; null ids come after all
others; lines end at \\n only; white space at the ends of a passage inside a line
stays; empty tables give empty results; extra columns of any name pass through
``drop_...`` and are ignored by ``scan``; texts of any length are cut whole.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import content_key, fresh, materialise, small_arrow_batches, text_of

#: One word in so many ends a piece, one piece in so many a chunk.
WORDS, PIECES = 3, 2
#: Pieces that make a seed, and a passage of parts of lines.
MIN_PIECES, LEAST = 2, 8
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xFF51AFD7ED558CCD)
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Pieces before a seed's neighbour that are read, too: boundaries there may depend on what lies before the passage.
SLACK = 5
POSITIVE = np.arange(1, 257, dtype=np.uint64)
IS_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])


@lru_cache(maxsize=None)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64."""
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(1 << bits, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _MIX
    return h ^ (h >> np.uint64(29))


class Hashes:
    """Polynomial hashes of stretches of bytes, the same wherever a stretch stands."""

    def __init__(self, data: np.ndarray):
        power, self.back = _powers(max(16, len(data).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(POSITIVE[data] * power[:len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))


def rolled(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """At each place the polynomial hash of the last two hashes, as a hash rolled along them has it; ``first`` marks
    where a document begins, with nothing before."""
    out = h.copy()
    out[1:] += np.where(first[1:], np.uint64(0), h[:-1] * np.uint64(_BASE))
    return mixed(out)


def begins(group: np.ndarray) -> np.ndarray:
    """Marks the first member of each run of equal numbers."""
    out = np.ones(len(group), bool)
    out[1:] = group[1:] != group[:-1]
    return out


class Cuts:
    """Some texts with their pieces and chunks: all in one pass, as the bytes of one text behind the other."""

    def __init__(self, texts: list[str]):
        self.data = [t.encode("utf-8", "surrogatepass") for t in texts]
        whole = np.frombuffer(b"\n".join(self.data), np.uint8)
        size = np.array([len(d) + 1 for d in self.data], np.int64)
        self.at = np.cumsum(size) - size  # where each text begins
        with np.errstate(over="ignore"):
            self._cut(whole, Hashes(whole))

    def _cut(self, b: np.ndarray, hashes: Hashes) -> None:
        edge = np.diff(np.concatenate([[True], IS_SPACE[b], [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)  # of words
        line = np.searchsorted(np.flatnonzero(b == 10), starts)
        doc = np.searchsorted(self.at, starts, "right") - 1
        last = (rolled(hashes.of(starts, ends), begins(doc)) >> np.uint64(40)) % np.uint64(WORDS) == 0
        last[:-1] |= line[1:] != line[:-1]
        last[-1:] = True
        at = np.flatnonzero(last)
        first = np.concatenate([[0], at + 1])[:len(at)].astype(np.int64)
        self.start, self.end, self.line, self.doc = starts[first], ends[at], line[at], doc[at]
        self.hash = hashes.of(self.start, self.end)
        new = begins(self.doc)
        last = (rolled(self.hash, new) >> np.uint64(40)) % np.uint64(PIECES) == 0
        last[:-1] |= new[1:]
        last[-1:] = True
        end = np.flatnonzero(last) + 1
        first = np.concatenate([[0], end])[:len(end)].astype(np.int64)
        long = end - first >= MIN_PIECES
        self.chunk_first, self.chunk_end = first[long], end[long]
        self.chunk_doc = self.doc[self.chunk_first]
        self.chunk_hash = hashes.of(self.start[self.chunk_first], self.end[self.chunk_end - 1]).view(np.int64)

    def sides(self) -> np.ndarray:
        """The hashes of the pieces before and after each long chunk, 32 bits of each; 0 at a text's ends."""
        h = np.concatenate([[0], self.hash >> np.uint64(32), [0]]).astype(np.uint64)
        doc = np.concatenate([[-1], self.doc, [-1]])
        left = np.where(doc[self.chunk_first] == self.chunk_doc, h[self.chunk_first], np.uint64(0))
        right = np.where(doc[self.chunk_end + 1] == self.chunk_doc, h[self.chunk_end + 1], np.uint64(0))
        return (left << np.uint64(32) | right).view(np.int64)

    def small(self) -> np.ndarray:
        """Whether a chunk that goes on to neither side can be no passage: it has few pieces, all on one line."""
        pieces = self.chunk_end - self.chunk_first
        return (pieces + 2 < LEAST) & (self.line[self.chunk_first] == self.line[self.chunk_end - 1])

    def __len__(self) -> int:
        return len(self.data)

    def __getitem__(self, k: int) -> "Cut":
        return Cut(self, k)


class Cut:
    """One text with its pieces and long chunks."""

    def __init__(self, cuts: Cuts, k: int):
        lo, hi = np.searchsorted(cuts.doc, [k, k + 1])
        self.data = cuts.data[k]
        self.start, self.end = cuts.start[lo:hi] - cuts.at[k], cuts.end[lo:hi] - cuts.at[k]
        before = int(np.count_nonzero(np.frombuffer(self.data[:self.start[0]], np.uint8) == 10)) if lo < hi else 0
        self.line = cuts.line[lo:hi] - (cuts.line[lo] - before) if lo < hi else cuts.line[lo:hi]
        self.hash = cuts.hash[lo:hi]
        one, two = np.searchsorted(cuts.chunk_doc, [k, k + 1])
        self.chunk_first, self.chunk_end = cuts.chunk_first[one:two] - lo, cuts.chunk_end[one:two] - lo
        self.chunk_hash = cuts.chunk_hash[one:two]

    def seeds(self, wanted: list) -> list[dict]:
        """The wanted chunks' bytes, where their pieces stand, and the bytes before and after them.

        Bytes are read up to the far end of the long chunk beside, and before it over ``SLACK`` pieces more. Where that
        chunk goes on along the same owner, it shows itself, and only what lies between is read, by the earlier one. An
        owner shows both sides, as its copies may need either, and no pieces."""
        new_line = np.append(self.line[1:] != self.line[:-1], True)
        flags = np.concatenate([[True], new_line[:-1]])[:len(self.line)] + 2 * new_line[:len(self.line)]
        info = np.stack([np.arange(len(self.line)), self.line, self.start, self.end, flags], axis=1).astype(np.int32)
        firsts, ends, n = self.chunk_first.tolist(), self.chunk_end.tolist(), len(self.line)
        out = []
        for w in wanted:
            at, left, right = w["at"], 0, n
            first, end = firsts[at], ends[at]
            if at:
                left = max(firsts[at - 1] - SLACK, 0)
            if at + 1 < len(ends):
                right = ends[at + 1]
            if not w["owner"]:
                left = left if w["before"] else first
                right = right if w["after"] else firsts[at + 1]
            start, stop = int(self.start[first]), int(self.end[end - 1])
            out.append({"at": at, "hash": int(self.chunk_hash[at]), "owner": bool(w["owner"]), "start": start,
                        "end": stop, "body": self.data[start:stop], "before": self.data[self.start[left]:start],
                        "after": self.data[stop:self.end[right - 1]],
                        "info": b"" if w["owner"] else info[left:right].tobytes()})
        return out


SEED = ("struct<at:int,hash:bigint,owner:boolean,start:bigint,end:bigint,body:binary,before:binary,after:binary,"
        "info:binary>")


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, key and the hashes, sides and smallness of the long chunks, in order, of each document once."""
    @F.pandas_udf("hashes array<bigint>, sides array<bigint>, small array<boolean>")
    def chunks(texts: pd.Series) -> pd.DataFrame:
        cuts = Cuts(texts.tolist())
        parts = np.searchsorted(cuts.chunk_doc, np.arange(1, len(cuts)))
        return pd.DataFrame({name: pd.Series(np.split(x, parts) if len(cuts) else [], dtype=object) for name, x in (
            ("hashes", cuts.chunk_hash), ("sides", cuts.sides()), ("small", cuts.small()))})

    small_arrow_batches(docs.sparkSession)
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), content_key(text).alias("key"), chunks(text).alias("c"))
    return rows.dropDuplicates(["id", "key"]).select("id", "key", "c.*")


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("key").alias("key"),
                    F.col("at").alias("at"))


def repeated_chunks(table: DataFrame) -> DataFrame:
    """id, key and wanted for documents that hold chunks which are repeated somewhere: array of at (which of its hashes),
    owner (whether it is the first of its hash), before, after (whether the chunk beside it does not go on along the
    same owner).

    Left out are small copies whose neighbouring pieces both differ from their owner's: they go on to neither side, and
    so can be no passage. These are most, as short strings repeat by chance."""
    each = table.select("id", "key", F.posexplode(F.arrays_zip("hashes", "sides", "small")).alias("at", "c")).select(
        "id", "key", "at", F.col("c.hashes").alias("hash"), "c.sides", "c.small")
    first = F.min(F.struct(_place().alias("place"), "sides"))
    repeated = each.groupBy("hash").agg(F.count("*").alias("n"), first.alias("first")).filter("n > 1")
    repeated = materialise(repeated.select("hash", F.col("first.place").alias("owner"), F.col("first.sides").alias("shown")),
                           "repeated")
    owner, differ = F.col("owner"), F.col("sides").bitwiseXOR(F.col("shown"))
    apart = (F.shiftrightunsigned(differ, 32) != 0) & (differ.bitwiseAND(F.lit(0xFFFFFFFF)) != 0)
    copies = each.join(repeated, "hash").filter((owner != _place()) & ~(F.col("small") & apart))
    copies = materialise(copies.select("id", "key", "at", "hash", "owner"), "copies")
    # Which document owns a chunk, and at which place.
    of, there = F.xxhash64(owner["id"], owner["key"]).alias("of"), owner["at"].alias("there")
    owners = copies.groupBy("hash").agg(F.min("owner").alias("owner")).select(
        owner["id"].alias("id"), owner["key"].alias("key"), owner["at"].alias("at"), F.lit(True).alias("owner"), of, there)
    found = copies.select("id", "key", "at", F.lit(False).alias("owner"), of, there).unionByName(owners)
    wanted = found.groupBy("id", "key").agg(F.array_sort(F.collect_list(F.struct("at", "owner", "of", "there"))).alias("w"))

    def goes_on(x: Column, other: Column, step: int) -> Column:
        """Whether the neighbouring chunk is the neighbour of this chunk's owner, too."""
        return F.coalesce((other["at"] == x["at"] + step) & (other["of"] == x["of"]) & (other["there"] == x["there"] + step),
                          F.lit(False))

    marked = F.transform("w", lambda x, i: F.struct(
        x["at"].alias("at"), x["owner"].alias("owner"),
        F.when(i > 0, ~goes_on(x, F.get("w", i - 1), -1)).otherwise(True).alias("before"),
        (~goes_on(x, F.get("w", i + 1), 1)).alias("after")))
    return wanted.select("id", "key", marked.alias("wanted"))


def seed_table(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               repeated_rows: bool = True) -> DataFrame:
    """id, key and the fields of ``Cut.seeds`` for each occurrence of a repeated chunk. ``repeated_rows`` says that rows
    of ``docs`` may be equal in id and text."""
    @F.pandas_udf(f"array<{SEED}>")
    def cut(texts: pd.Series, chosen: pd.Series) -> pd.Series:
        cuts = Cuts(texts.tolist())
        return pd.Series([cuts[k].seeds(list(c)) for k, c in enumerate(chosen)], dtype=object)

    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("doc"), text.alias("text"), content_key(text).alias("doc_key"))
    if repeated_rows:
        rows = rows.dropDuplicates(["doc", "doc_key"])
    once = rows.join(wanted, F.col("doc").eqNullSafe(F.col("id")) & (F.col("doc_key") == F.col("key")))
    return once.select("id", "key", F.explode(cut("text", "wanted")).alias("s")).select("id", "key", "s.*")


SPACE = b" \t\n\v\f\r"


def common(a: bytes, b: bytes) -> tuple[int, bool]:
    """(bytes at the start that are equal, up to the end of a word that ends there in both; whether a difference ends
    them and not an end of the bytes)."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    if differ:
        n = ((differ & -differ).bit_length() - 1) // 8
    while n and not all(n == len(t) or t[n] in SPACE for t in (a, b)):
        n -= 1
    return len(a[:n].rstrip(SPACE)), bool(differ)


def extended(start: int, end: int, before: bytes, owner_before: bytes, after: bytes, owner_after: bytes,
             info: bytes) -> tuple | None:
    """(start, end, pieces) of a seed as far as the text around it equals the owner's, in whole words; None if the
    stretch ends in differences on both sides and is no passage."""
    left, ended = common(before[::-1], owner_before[::-1])
    right, closed = common(after, owner_after)
    start, end = start - left, end + right
    pieces = np.frombuffer(info, np.int32).reshape(-1, 5)
    pieces = pieces[(pieces[:, 3] > start) & (pieces[:, 2] < end)]
    known = pieces.tobytes()
    if ended and closed and len(pieces) < LEAST + 2 and not Covered([known]).passage(start, end):
        return None
    return start, end, known


def _extended(body: pd.Series, owner_body: pd.Series, *rest: pd.Series) -> pd.DataFrame:
    """The stretches; start is null for no passage, and -1 where the seed itself differs from the owner's."""
    rows = [(extended(*r) or (None, None, None)) if a == b else (-1, -1, None)
            for a, b, r in zip(body, owner_body, zip(*rest))]
    return pd.DataFrame({"start": pd.Series([r[0] for r in rows], dtype="Int64"),
                         "end": pd.Series([r[1] for r in rows], dtype="Int64"),
                         "info": pd.Series([r[2] for r in rows], dtype=object)})


class Covered:
    """What is known of a document's pieces, and what byte ranges cover."""

    def __init__(self, pieces: list[bytes]):
        rows = np.unique(np.frombuffer(b"".join(pieces), np.int32).reshape(-1, 5), axis=0)
        self.number, self.line, start, end, flags = rows.T.tolist()
        self.starts, self.ends = start, end
        self.begins, self.closes = [f & 1 for f in flags], [f & 2 for f in flags]

    def joined(self, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Sorted ranges, those joined that touch or have white space between them only."""
        out: list[tuple[int, int]] = []
        for start, end in ranges:
            if out and (start <= out[-1][1] or self.next_to(out[-1][1], start)):
                out[-1] = out[-1][0], max(out[-1][1], end)
            else:
                out.append((start, end))
        return out

    def next_to(self, end: int, start: int) -> bool:
        """Whether a piece ends here and the next piece starts there."""
        k = bisect_left(self.ends, end)
        return (k + 1 < len(self.ends) and self.ends[k] == end and self.starts[k + 1] == start
                and self.number[k + 1] == self.number[k] + 1)

    def measured(self, start: int, end: int) -> dict:
        """The range with its lines, whole pieces and whole lines."""
        touched = range(bisect_right(self.ends, start), bisect_left(self.starts, end))
        inside = [k for k in touched if start <= self.starts[k] and self.ends[k] <= end]
        whole = {self.line[k] for k in inside if self.begins[k]} & {self.line[k] for k in inside if self.closes[k]}
        first, last = self.line[touched[0]], self.line[touched[-1]]
        return {"first": first, "lines": last - first + 1, "start": start, "end": end, "pieces": len(inside),
                "whole": len(whole)}

    def passage(self, start: int, end: int) -> bool:
        m = self.measured(start, end)
        return m["whole"] >= 2 or m["pieces"] >= LEAST


def passages_of(pieces: list[bytes], stretches: list) -> list[dict]:
    """Passages of a document: stretches along one owner's text are joined, those long enough count, and what they
    cover together is returned."""
    known, along = Covered(pieces), {}
    for s in stretches:
        along.setdefault((s["of"], s["apart"]), []).append((s["start"], s["end"]))
    long = []
    for ranges in along.values():
        for start, end in known.joined(sorted(ranges)):
            if known.passage(start, end):
                long.append((start, end))
    return [known.measured(*r) for r in known.joined(sorted(long))]


PASSAGE = "array<struct<first:int,lines:int,start:bigint,end:bigint,pieces:int,whole:int>>"


def repeated_passages(seeds: DataFrame) -> DataFrame:
    """id, key and passages of documents that hold some. ``seeds`` is a written table."""
    extend = F.pandas_udf(_extended, "start long, end long, info binary")

    def compared(copies: DataFrame, owners: DataFrame, on: list[str]) -> DataFrame:
        """What each copy shares with its owner."""
        owned = owners.select(*on, _place().alias("place"), F.col("start").alias("owner_start"), F.col("body").alias(
            "owner_body"), F.col("before").alias("owner_before"), F.col("after").alias("owner_after"))
        same = extend(*[F.col(c) for c in ("body", "owner_body", "start", "end", "before", "owner_before", "after",
                                           "owner_after", "info")])
        return copies.join(owned, on).withColumn("same", same).filter("same.start is not null").select(
            "id", "key", "at", F.xxhash64(F.col("place")["id"], F.col("place")["key"]).alias("of"),
            (F.col("owner_start") - F.col("start")).alias("apart"), "same.start", "same.end", "same.info")

    found = materialise(compared(seeds.filter("not owner"), seeds.filter("owner"), ["hash"]), "stretches")
    stretches = found.filter("start >= 0")
    other = found.filter("start < 0").select("id", "key", "at")
    if not other.isEmpty():  # hashes that collide: among the others, chunks are equal where their bytes are
        mine = seeds["id"].eqNullSafe(other["id"]) & (seeds["key"] == other["key"]) & (seeds["at"] == other["at"])
        rest = materialise(seeds.join(other, mine, "left_semi"), "colliding")
        first = rest.groupBy("hash", "body").agg(F.min(_place()).alias("first"))
        rest = rest.join(first, ["hash", "body"]).withColumn("owner", F.col("first") == _place())
        stretches = stretches.unionByName(compared(rest.filter("not owner"), rest.filter("owner"), ["hash", "body"]))
    per = stretches.groupBy("id", "key").agg(
        F.collect_list("info").alias("info"), F.collect_list(F.struct("of", "apart", "start", "end")).alias("stretches"))

    @F.pandas_udf(PASSAGE)
    def joined(pieces: pd.Series, stretches: pd.Series) -> pd.Series:
        return pd.Series([passages_of(list(p), list(s)) for p, s in zip(pieces, stretches)], dtype=object)

    return per.select("id", "key", joined("info", "stretches").alias("passages")).filter(F.size("passages") > 0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, key, n_lines, n_chunks and passages (first line, lines, first byte and end in UTF-8, pieces, whole lines) for
    each row of ``docs``."""
    table = materialise(chunk_table(docs, id_col, text_col), "chunks")
    again = table.count() < docs.count()  # rows equal in id and text
    seeds = materialise(seed_table(docs, repeated_chunks(table), id_col, text_col, again), "seeds")
    found = materialise(repeated_passages(seeds), "passages")
    counted = table.select(F.col("id").alias("doc"), F.col("key").alias("doc_key"),
                           F.size("hashes").cast("long").alias("n_chunks"))
    per = counted.join(found, F.col("doc").eqNullSafe(F.col("id")) & (F.col("doc_key") == F.col("key")), "left").select(
        "doc", "doc_key", "n_chunks", "passages")
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), content_key(text).alias("key"),
                       F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"))
    return rows.join(per, rows["id"].eqNullSafe(F.col("doc")) & (rows["key"] == F.col("doc_key")), "left").select(
        "id", "key", "n_lines", "n_chunks", F.coalesce("passages", F.array().cast(PASSAGE)).alias("passages"))


def without(text: str, passages: list) -> str:
    """A text without the passages; a line end goes with a whole line, and blank lines between them with a passage."""
    data, out, at = text.encode("utf-8", "surrogatepass"), [], 0
    for p in passages:
        start, end = p["start"], p["end"]
        begins = data[:start].rpartition(b"\n")[2].strip() == b""
        closes = data[end:].partition(b"\n")[0].strip() == b""
        if begins and closes:  # only whole lines: their own white space and one line end go too
            start = data.rfind(b"\n", 0, start) + 1
            stop = data.find(b"\n", end)
            if stop >= 0:
                end = stop + 1
            else:  # the last line: the line end before it
                start, end = max(start - 1, 0), len(data)
        out.append(data[at:max(at, start)])
        at = max(at, end)
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of the texts."""
    gone_id, gone_key, gone = (fresh(docs, n) for n in ("__gone_id", "__gone_key", "__gone"))
    found = materialise(scan(docs, id_col, text_col).filter(F.size("passages") > 0).select(
        F.col("id").alias(gone_id), F.col("key").alias(gone_key), F.col("passages").alias(gone)).dropDuplicates(
        [gone_id, gone_key]), "removed")

    @F.pandas_udf("string")
    def kept(texts: pd.Series, passages: pd.Series) -> pd.Series:
        return pd.Series([t if p is None else without(t, list(p)) for t, p in zip(texts, passages)], dtype=object)

    text = text_of(text_col)
    joined = docs.join(found, docs[id_col].eqNullSafe(F.col(gone_id)) & (content_key(text) == F.col(gone_key)), "left")
    return joined.withColumn(text_col, F.when(F.col(gone).isNotNull(), kept(text, F.col(gone))).otherwise(
        F.col(text_col))).select(*[F.col(f"`{c}`") for c in docs.columns])

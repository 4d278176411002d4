"""Cross-tokenizer alignment with pair counts under a minimal perfect hash.

Each text is encoded by a byte-level BPE (A) and by a sentencepiece model with
byte fallback (B). Where a token of both ends at the same byte, a group ends;
all A-B token pairs of a group are linked. The corpus-wide number of documents
that hold an id pair linked is found and looked up without a join:

1. texts are encoded once; the ids go to a written table;
2. a first pass aligns them and writes, per task, how many of its documents
   hold each pair; the distinct pairs are dealt into shards by hash, and each
   shard gets a minimal perfect hash (levels of bits: a pair that meets no
   other of its level takes its place there, the others go on to the next);
3. each leaf task adds its counts into dense vectors indexed by that hash, and
   the vectors are summed in a tree of fan-in ``FAN``;
4. a second pass aligns the documents again and looks the counts up; the pair
   kept at each place verifies that the hash was asked for a pair it knows.

Pairs are bounded by the product of the two vocabularies, whatever the corpus;
they are handled in blocks of at most ``BLOCK`` pairs (some 40 MB with keys and
counts), one block in memory at a time. Several blocks mean several passes over
the written ids, whose partial sums are added up; the results are the same.

Defined results: null and empty texts, and texts whose tokens of A or B do not
join to a space and the text, have no tokens, no groups and no links. Each row
is a document, repeated rows too. An empty table gives an empty result. Extra
columns are ignored by ``align`` and kept by ``encode``. A group of any length
is linked whole, in slices.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import byte_symbols
from .common import fresh, materialise, small_arrow_batches, text_of

#: Pairs of a shard (on average) and of a block (at most, but for the last shard's excess).
SHARD, BLOCK = 1 << 16, 1 << 21
#: Bits of a level for each pair that is left, and vectors added at a time.
GAMMA, FAN = 2, 8
#: Entries of a vector that travel as one row.
SLICE = 1 << 16
#: Links handled at a time, and pairs a task gathers before it writes them.
LINKS, GATHERED = 1 << 20, 1 << 20
#: White space beyond this goes to the slower of two equal encoders: the quicker one's pattern search is recursive.
RUN = re.compile(r"\s{50000}")
#: The fixed word pattern of byte-level BPE vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --------------------------------------------------------------------------
# Tokens and their bytes
# --------------------------------------------------------------------------

class ByteLevel:
    """A byte-level BPE of a tokenizer file, without its special tokens.

    tiktoken runs it with the file's vocabulary as ranks, several times faster
    than the tokenizers library and with the same ids: the vocabulary numbers
    tokens in the order of their merges, which is checked here.
    """

    def __init__(self, source: str):
        import tiktoken

        spec = json.loads(source)
        special = {t["content"] for t in spec["added_tokens"]}
        at = {s: i for i, s in enumerate(byte_symbols())}
        self.bytes: dict[int, bytes] = {
            i: bytes(at[c] for c in token) for token, i in spec["model"]["vocab"].items() if token not in special}
        made = [spec["model"]["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        before = spec["pre_tokenizer"]
        if made != sorted(made) or before["type"] != "ByteLevel" or not before.get("use_regex", True):
            raise ValueError("not a byte-level BPE with ids in the order of its merges")
        self.source = source
        self.quick = tiktoken.Encoding(
            "a", pat_str=WORDS, mergeable_ranks={b: i for i, b in self.bytes.items()}, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        text = " " + text
        if len(text) > 50_000 and RUN.search(text):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.int32)
        return np.asarray(self.quick.encode_to_numpy(text, disallowed_special=()), np.int32)

    @property
    def plain(self):
        from tokenizers import Tokenizer

        out = Tokenizer.from_str(self.source)
        out.encode_special_tokens = True
        return out


class Pieces:
    """A sentencepiece model; it puts the space before a text itself."""

    def __init__(self, source: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=source)
        self.bytes = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int32)


class Side:
    """What a worker knows of one tokenizer: its encoder, and the bytes and their number by id."""

    def __init__(self, tokenizer: ByteLevel | Pieces):
        self.encode = tokenizer.encode
        self.size = max(tokenizer.bytes, default=0) + 1
        self.bytes = np.array([tokenizer.bytes.get(i, b"") for i in range(self.size)], object)
        self.length = np.array([len(b) for b in self.bytes], np.int64)

    def joins_to(self, ids: np.ndarray, whole: bytes) -> bool:
        return int(self.length[ids].sum()) == len(whole) and b"".join(self.bytes[ids].tolist()) == whole


@lru_cache(maxsize=1)
def sides(a: str, b: bytes) -> tuple[Side, Side]:
    """One pair per Python worker, kept from task to task."""
    return Side(ByteLevel(a)), Side(Pieces(b))


class Tokenizers:
    """The two tokenizer files, read by the driver and sent to the executors once (a few MB, whatever the input)."""

    def __init__(self, df: DataFrame, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as f, open(path_b, "rb") as g:
            sent = f.read(), g.read()
        self.sent = df.sparkSession.sparkContext.broadcast(sent)

    def sides(self) -> tuple[Side, Side]:
        return sides(*self.sent.value)


def token_ids(text: str, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The ids of both sides; none if a side's bytes are not those of a space and the text."""
    none = np.empty(0, np.int32)
    if not text:
        return none, none
    whole = (" " + text).encode()
    left, right = a.encode(text), b.encode(text)
    return (left, right) if a.joins_to(left, whole) and b.joins_to(right, whole) else (none, none)


def encode(docs: DataFrame, tokenizers: Tokenizers, text_col: str = "text", a: str = "a", b: str = "b") -> DataFrame:
    """``docs`` with both sides' ids as the bytes of 32-bit numbers."""
    @F.pandas_udf("a binary, b binary")
    def both(texts: pd.Series) -> pd.DataFrame:
        left, right = tokenizers.sides()
        found = [token_ids(t, left, right) for t in texts]
        return pd.DataFrame({"a": [x.tobytes() for x, _ in found], "b": [y.tobytes() for _, y in found]}, dtype=object)

    small_arrow_batches(docs.sparkSession)
    both_col = fresh(docs, "__both")
    out = docs.withColumn(both_col, both(text_of(text_col)))
    return out.withColumns({a: F.col(f"{both_col}.a"), b: F.col(f"{both_col}.b")}).drop(both_col)


# --------------------------------------------------------------------------
# Groups and links
# --------------------------------------------------------------------------

class Aligned:
    """The groups of a batch of documents.

    The documents stand one behind the other: both sides of each have the same
    bytes, so a document's end is a common end and no group reaches over it.
    """

    def __init__(self, left: list[bytes], right: list[bytes], a: Side, b: Side):
        self.a, self.b = (np.frombuffer(b"".join(x), np.int32).astype(np.int64) for x in (left, right))
        self.n_a, self.n_b = (np.array([len(x) // 4 for x in y], np.int64) for y in (left, right))
        ends_a, ends_b = np.cumsum(a.length[self.a]), np.cumsum(b.length[self.b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        self.in_a, self.in_b = (np.bincount(g, minlength=len(common)) for g in (self.group_a, self.group_b))
        self.doc_a = np.repeat(np.arange(len(left)), self.n_a)
        last = np.cumsum(self.in_a) - 1
        self.doc = self.doc_a[last] if len(common) else np.empty(0, np.int64)
        self.sizes = a.size, b.size

    def n_groups(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.n_a))

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(document, pair) of every link, ``LINKS`` or so at a time; a pair is A's id times B's size plus B's id."""
        each = self.in_b[self.group_a]  # links of each A token
        first = (np.cumsum(self.in_b) - self.in_b)[self.group_a]
        before = np.concatenate([[0], np.cumsum(each)])
        at = 0
        while at < len(each):
            end = max(at + 1, int(np.searchsorted(before, before[at] + LINKS, "right")) - 1)
            n = each[at:end]
            if n.sum() <= 2 * LINKS:
                yield self._between(at, end, n, first)
            else:  # one token with a great many partners
                for k in range(0, int(n[0]), LINKS):
                    partners = self.b[first[at] + k:first[at] + min(k + LINKS, int(n[0]))]
                    yield np.full(len(partners), self.doc_a[at]), self.a[at] * self.sizes[1] + partners
            at = end

    def _between(self, at: int, end: int, n: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum(n) - n
        partner = np.arange(int(n.sum())) - np.repeat(starts - first[at:end], n)
        return np.repeat(self.doc_a[at:end], n), np.repeat(self.a[at:end] * self.sizes[1], n) + self.b[partner]

    def group_texts(self) -> list[bytes]:
        """a1,a2|b1;a3|b2,b3 for each document."""
        n_a, n_b = self.sizes
        shown = _shown(n_a, n_b)
        ends = [np.append(g[1:] != g[:-1], True) if len(g) else np.empty(0, bool) for g in (self.group_a, self.group_b)]
        code = np.concatenate([self.a + n_a * ends[0], 2 * n_a + self.b + n_b * ends[1]])
        order = np.argsort(np.concatenate([2 * self.group_a, 2 * self.group_b + 1]), kind="stable")
        parts = shown[code[order]].tolist()
        stops = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        return [b"".join(parts[s:e])[:-1] for s, e in zip(stops, stops[1:])]


@lru_cache(maxsize=1)
def _shown(n_a: int, n_b: int) -> np.ndarray:
    """Decimal ids with what follows: A's within and at the end of a group, then B's."""
    return np.array([b"%d%s" % (i, mark) for n, marks in ((n_a, (b",", b"|")), (n_b, (b",", b";")))
                     for mark in marks for i in range(n)], object)


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def pair_counts(batches: Iterable[pa.RecordBatch], tokenizers: Tokenizers) -> Iterator[pa.RecordBatch]:
    """pair and n: how many of the documents read so far hold it. A pair may come several times."""
    a, b = tokenizers.sides()
    gathered: list[tuple[np.ndarray, np.ndarray]] = []

    def out() -> Iterator[pa.RecordBatch]:
        pairs, n = _merged(gathered)
        for k in range(0, len(pairs), SLICE):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[k:k + SLICE]), pa.array(n[k:k + SLICE])], ["pair", "n"])

    held = 0
    for batch in batches:
        here = Aligned(_column(batch, "a"), _column(batch, "b"), a, b)
        space = a.size * b.size
        seen = np.empty(0, np.int64)
        for doc, pair in here.links():  # each document holds a pair once, whatever slices its links come in
            seen = np.unique(np.concatenate([seen, doc * space + pair]))
        if len(seen):
            pairs, n = np.unique(seen % space, return_counts=True)
            gathered.append((pairs, n.astype(np.int64)))
            held += len(pairs)
        if held > GATHERED:
            gathered = [_merged(gathered)]
            held = len(gathered[0][0])
            if held > GATHERED // 2:
                yield from out()
                gathered, held = [], 0
    if gathered:
        yield from out()


# --------------------------------------------------------------------------
# Minimal perfect hash
# --------------------------------------------------------------------------

def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A well-mixed 64-bit number of each key."""
    z = keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(keys, 0) % np.uint64(shards)).astype(np.int64)


def build_shard(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(bits of each level, the bits of all levels as 64-bit words) for distinct keys."""
    sizes, words, left = [], [], keys
    while len(left):
        size = -(-GAMMA * len(left) // 64) * 64
        place = (mixed(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(size)
        left = left[~alone[place]]
    return sizes, np.concatenate(words) if words else np.empty(0, np.uint64)


class PerfectHash:
    """The shards of one block, behind each other: keys get places from 0 without gaps."""

    def __init__(self, shards: int, rows: list[tuple[int, list[int], bytes, bytes]]):
        """rows: (shard, bits of its levels, words, keys in the order of their places or b'')."""
        self.shards = shards
        levels = max((len(r[1]) for r in rows), default=0)
        self.size = np.zeros((shards, levels), np.int64)
        self.start = np.zeros((shards, levels), np.int64)
        at = 0
        for shard, sizes, _, _ in rows:
            self.size[shard, :len(sizes)] = sizes
            self.start[shard, :len(sizes)] = at + np.cumsum([0, *sizes[:-1]])
            at += sum(sizes)
        self.words = np.frombuffer(b"".join(r[2] for r in rows), np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.n = int(ones.sum())
        self.keys = np.frombuffer(b"".join(r[3] for r in rows), np.int64)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if no level has one; only keys of the block are sure to be meant by their place."""
        out = np.full(len(keys), -1, np.int64)
        shard = shard_of(keys, self.shards)
        left = np.arange(len(keys))
        for level in range(self.size.shape[1]):
            size = self.size[shard[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            bit = self.start[shard[left], level] + (mixed(keys[left], level + 1) % size.astype(np.uint64)).astype(np.int64)
            word, within = bit >> 6, (bit & 63).astype(np.uint64)
            hit = (self.words[word] >> within & np.uint64(1)).astype(bool)
            word, within = word[hit], within[hit]
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << within) - np.uint64(1)))
            out[left[hit]] = self.before[word] + below
            left = left[~hit]
        return out

    def verified(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key of the block, -1 for all other keys."""
        place = self.place(keys)
        if not self.n:
            return place
        return np.where((place >= 0) & (self.keys[place] == keys), place, -1)


HASH = "shard int, n long, sizes array<long>, words binary, keys binary"


def hashed_shard(frame: pd.DataFrame, shards: int) -> pd.DataFrame:
    """The row of one shard; it holds about ``SHARD`` distinct pairs."""
    keys = np.sort(frame["pair"].to_numpy(np.int64))
    sizes, words = build_shard(keys)
    shard = int(frame["shard"].iloc[0])
    place = PerfectHash(shards, [(shard, sizes, words.tobytes(), b"")]).place(keys)
    ordered = np.empty(len(keys), np.int64)
    ordered[place] = keys
    return pd.DataFrame({"shard": [shard], "n": [len(keys)], "sizes": [sizes], "words": [words.tobytes()],
                         "keys": [ordered.tobytes()]})


def perfect_hash(pairs: DataFrame) -> tuple[DataFrame, int]:
    """(a row for each shard of the distinct ``pair`` values, the number of shards)."""
    distinct = materialise(pairs.select("pair").distinct(), "pairs")
    shards = max(1, -(-distinct.count() // SHARD))

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(shard_of(keys.to_numpy(np.int64), shards), dtype="int32")

    rows = distinct.withColumn("shard", shard("pair")).groupBy("shard").applyInPandas(
        partial(hashed_shard, shards=shards), HASH)
    return materialise(rows, "hash"), shards


def blocks_of(hashed: DataFrame, block: int) -> list[list[int]]:
    """Shards in runs of about ``block`` pairs; a number per shard goes to the driver (vocabularies bound the shards)."""
    out, held = [], block
    for shard, n in sorted(hashed.select("shard", "n").collect()):
        if held + n > block:
            out.append([])
            held = 0
        out[-1].append(shard)
        held += n
    return out


def load(hashed: DataFrame, shards: int, block: list[int], keys: bool) -> PerfectHash:
    """The perfect hash of a block (bounded by ``BLOCK``), read by the driver."""
    rows = hashed.filter(F.col("shard").between(block[0], block[-1])).select(
        "shard", "sizes", "words", "keys" if keys else F.lit(b"").alias("keys")).collect()
    return PerfectHash(shards, [(r[0], list(r[1]), bytes(r[2]), bytes(r[3])) for r in sorted(rows)])


# --------------------------------------------------------------------------
# Dense count vectors
# --------------------------------------------------------------------------

VECTOR = "leaf int, slice int, counts binary"


def leaf_vectors(batches: Iterable[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """The counts of a leaf task's runs as one dense vector over the block, cut into slices; empty slices stay away."""
    from pyspark import TaskContext

    table: PerfectHash = sent.value
    counts = np.zeros(table.n, np.int64)
    for batch in batches:
        pairs, n = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("pair", "n"))
        place = table.verified(pairs)
        np.add.at(counts, place[place >= 0], n[place >= 0])
    for k in range(0, table.n, SLICE):
        if counts[k:k + SLICE].any():
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([k // SLICE], pa.int32()),
                pa.array([counts[k:k + SLICE].tobytes()], pa.binary())], ["leaf", "slice", "counts"])


def added(frame: pd.DataFrame) -> pd.DataFrame:
    """The sum of at most ``FAN`` slices."""
    total = sum(np.frombuffer(c, np.int64) for c in frame["counts"])
    return pd.DataFrame({"leaf": frame["leaf"].iloc[:1] // FAN, "slice": frame["slice"].iloc[:1], "counts": [total.tobytes()]})


def tree_counts(runs: DataFrame, table: PerfectHash) -> np.ndarray:
    """How many documents hold each pair of the block, by its place."""
    spark = runs.sparkSession
    sent = spark.sparkContext.broadcast(table)
    leaves = runs.coalesce(max(1, spark.sparkContext.defaultParallelism))
    vectors = leaves.mapInArrow(partial(leaf_vectors, sent=sent), VECTOR)
    left = spark.sparkContext.defaultParallelism
    while left > 1:
        vectors = vectors.groupBy((F.col("leaf") / FAN).cast("int").alias("node"), "slice").applyInPandas(added, VECTOR)
        left = -(-left // FAN)
    out = np.zeros(table.n, np.int64)
    for r in vectors.collect():  # one vector of the block's bounded length
        at = r["slice"] * SLICE
        part = np.frombuffer(r["counts"], np.int64)
        out[at:at + len(part)] += part
    sent.unpersist()
    return out


# --------------------------------------------------------------------------
# Second pass
# --------------------------------------------------------------------------

NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "known"]


def look_up(batches: Iterable[pa.RecordBatch], tokenizers: Tokenizers, sent) -> Iterator[pa.RecordBatch]:
    """A row per document with what this block's pairs add to its sums."""
    a, b = tokenizers.sides()
    table, counts, best = sent.value
    for batch in batches:
        here = Aligned(_column(batch, "a"), _column(batch, "b"), a, b)
        docs = len(here.n_a)
        links, n_best, total, known = (np.zeros(docs, np.int64) for _ in range(4))
        for doc, pair in here.links():
            links += np.bincount(doc, minlength=docs)
            if not table.n:
                continue
            place = table.verified(pair)
            ours = place >= 0
            doc, pair, count = doc[ours], pair[ours], counts[place[ours]]
            known += np.bincount(doc, minlength=docs)
            np.add.at(total, doc, count)
            n_best += np.bincount(doc[count == best[pair // b.size]], minlength=docs)
        digests = [hashlib.sha256(t).hexdigest() if t else "" for t in here.group_texts()]
        columns = [here.n_a, here.n_b, here.n_groups(), links, n_best, total, known]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(c)) for c in ("id", "row")]
            + [pa.array(c, pa.int64()) for c in columns] + [pa.array(digests, pa.string())],
            ["id", "row", *NUMBERS, "groups_sha256"])


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          block: int = BLOCK) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best (links whose pair's count is the highest of its A id), count_sum (of the
    links' counts) and groups_sha256 for each row of ``docs``."""
    spark = docs.sparkSession
    tokenizers = Tokenizers(docs, path_a, path_b)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = materialise(encode(rows, tokenizers).select("id", F.monotonically_increasing_id().alias("row"), "a", "b"), "ids")
    found_type = T.StructType([*ids.select("id", "row").schema, *[T.StructField(c, T.LongType()) for c in NUMBERS],
                               T.StructField("groups_sha256", T.StringType())])
    runs = materialise(ids.select("a", "b").mapInArrow(partial(pair_counts, tokenizers=tokenizers), "pair long, n long"),
                       "runs")
    hashed, shards = perfect_hash(runs)
    blocks = blocks_of(hashed, block)
    n_b = Pieces(tokenizers.sent.value[1]).model.get_piece_size()
    n_a = max(json.loads(tokenizers.sent.value[0])["model"]["vocab"].values()) + 1
    best = np.zeros(n_a, np.int64)  # of each A id: bounded by the vocabulary
    counted = []
    for k in blocks:
        table = load(hashed, shards, k, keys=True)
        counts = tree_counts(runs, table)
        np.maximum.at(best, table.keys // n_b, counts)
        counted.append(counts if len(blocks) == 1 else _stored(spark, counts))
    out = None
    for k, counts in zip(blocks or [[]], counted or [np.empty(0, np.int64)]):
        table = load(hashed, shards, k, keys=True) if k else PerfectHash(shards, [])
        counts = counts if isinstance(counts, np.ndarray) else _read(counts)
        sent = spark.sparkContext.broadcast((table, counts, best))
        found = ids.mapInArrow(partial(look_up, tokenizers=tokenizers, sent=sent), found_type)
        if len(blocks) > 1:
            found = materialise(found, "found")
        out = found if out is None else out.unionByName(found)
    if len(blocks) > 1:
        parts = ["n_best", "count_sum", "known"]
        out = out.groupBy("row").agg(*[(F.sum if c in parts else F.first)(c).alias(c) for c in found_type.names if c != "row"])
    out = materialise(out, "aligned")
    if not out.filter("known != n_links").isEmpty():
        raise RuntimeError("a link's pair has no verified place in the perfect hash")
    return out.drop("row", "known")


def _stored(spark, counts: np.ndarray) -> DataFrame:
    rows = [(k, counts[k * SLICE:(k + 1) * SLICE].tobytes()) for k in range(-(-len(counts) // SLICE))]
    return materialise(spark.createDataFrame(rows, "slice int, counts binary"), "counts")


def _read(stored: DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(r[1]) for r in sorted(stored.collect())), np.int64)

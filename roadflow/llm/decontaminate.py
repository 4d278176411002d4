"""Benchmark decontamination with DataFrame functions only.

Wherever a benchmark window (ten consecutive words, or the whole of a shorter
item) of m words stands in a document, it holds a whole block of (m + 1) / 2
words that starts at a multiple of that number. So only the document's aligned
blocks are looked up, in a bitmap of the hashes of all blocks of all windows.
Around each block that the bitmap may hold, the windows that contain it are
hashed and looked up in a second bitmap, and what is left is joined to the
windows by hash and compared word by word. No window is missed, and a word is
hashed once unless its block is found.

What a task holds does not grow with the benchmark: a bitmap is broadcast and
has at most ``MOST_BITS``; past that it only lets more candidates through. The
windows are broadcast if they are proven small and sorted and merged if not.
Windows of the same items share a numbered set of items, which is joined to the
documents once their hits are found.

Defined results: null or empty texts have no words and are clean; items
without words have no windows; a null item id marks words as hit but is not
listed; repeated rows get equal results; an empty benchmark finds nothing; an
empty documents table gives an empty result; other columns of any name pass
through ``drop_contaminated`` and ``cut_spans`` and are ignored otherwise; texts
of any length are read whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, ascii_lower, content_key, drop_rows, fresh, let, materialise, text_of

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same class before lower-casing.
NOT_WORD_RAW = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD_RAW = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
#: Bytes that a row may take in a broadcast table, beside its words or items, and that an item may take there.
ROW_BYTES, ITEM_BYTES = 200, 40
#: Bytes of benchmark text that one task makes windows of.
TASK_BYTES = 1 << 20
#: A bitmap has so many bits for a hash, and at least and at most so many in all (powers of two).
BITS_PER_HASH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")


def block_size(length: int) -> int:
    """The longest aligned block that every place of a window of ``length`` words contains whole."""
    return (length + 1) // 2


def block_hash(words: str, start: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, start + i) for i in range(size)])


def benchmark_windows(bench: DataFrame, item_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """Distinct windows: words, length, items (ids of the items that contain it)."""
    # Windows are many times their text, and a file of items may be one task's.
    tasks = -(-(bench.agg(F.sum(F.length(text_col))).first()[0] or 0) // TASK_BYTES)
    spread = bench.repartition(tasks) if tasks > 1 else bench
    items = spread.select(F.col(item_col).alias("item"), words_of(text_of(text_col)).alias("all")).filter(
        F.size("all") > 0).withColumn("length", F.least(F.size("all"), F.lit(window)))
    each = items.select("item", "length", "all", F.explode(F.sequence(
        F.lit(0), F.size("all") - F.col("length"))).alias("at"))
    each = each.select("item", "length", F.slice("all", F.col("at") + 1, F.col("length")).alias("words"))
    return each.groupBy("words", "length").agg(F.collect_set("item").alias("items"))


def window_blocks(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """hash of each block of each window."""
    def size(make):
        return reduce(lambda e, n: e.when(F.col("length") == n, make(block_size(n))), lengths[1:],
                      F.when(F.col("length") == lengths[0], make(block_size(lengths[0]))))

    each = windows.select("words", "length", F.explode(F.sequence(F.lit(0), F.col("length") - size(F.lit))).alias("offset"))
    return each.select(size(lambda b: block_hash("words", F.col("offset"), b)).alias("hash"))


def bitmap(hashes: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(rows of 64 longs by ``row``, bits in all) of about ``n`` hashes."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (n * BITS_PER_HASH).bit_length()))
    place = hashes.select(F.col("hash").bitwiseAND(F.lit(bits - 1)).alias("bit"))
    longs = place.groupBy(F.shiftright("bit", 12).alias("row"), F.shiftright("bit", 6).bitwiseAND(F.lit(63)).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("long"))
    rows = longs.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("at", "long"))).alias("longs")).select(
        "row", F.transform(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long")), lambda i: F.coalesce(
            F.try_element_at("longs", i), F.lit(0).cast("long"))).alias("longs"))
    return materialise(rows, "bitmap"), bits


def maybe_in(probes: DataFrame, hash_col: str, held: tuple[DataFrame, int]) -> DataFrame:
    """The rows whose hash the bitmap may hold."""
    rows, bits = held
    bit = F.col(hash_col).bitwiseAND(F.lit(bits - 1))
    long = F.get("longs", F.shiftright(bit, 6).bitwiseAND(F.lit(63)).cast("int"))
    return probes.join(F.broadcast(rows), F.shiftright(bit, 12) == F.col("row")).filter(
        F.getbit(long, bit.bitwiseAND(F.lit(63)).cast("int")) == 1).drop("row", "longs")


def small_or_merged(table: DataFrame, width: Column) -> DataFrame:
    """``table`` for a join: broadcast if its rows, each of at most ``width`` bytes, are few enough, else sorted and
    merged, whatever its files' size lets Spark expect."""
    small = (table.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES
    return F.broadcast(table) if small else table.hint("merge")


def numbered_windows(bench: DataFrame, item_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """(the windows: words, length, hash, set; the sets of items: set, items, for a join)."""
    windows = materialise(benchmark_windows(bench, item_col, text_col, window).withColumn(
        "items", F.array_sort("items")), "windows")
    sets = materialise(windows.select("items").distinct().withColumn("set", F.monotonically_increasing_id()), "item-sets")
    sets = small_or_merged(sets, F.lit(ROW_BYTES) + ITEM_BYTES * F.size("items"))
    numbered = windows.join(sets, "items").select("words", "length", F.xxhash64("words").alias("hash"), "set")
    return materialise(numbered, "numbered-windows"), sets


def find_hits(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", bench_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, key, hits (array of at, length: merged word ranges), items, n_hit for each contaminated text."""
    windows, sets = numbered_windows(bench, item_col, bench_text_col, window)
    # At most ``window`` lengths; an empty benchmark goes the same way with no rows.
    counted = {r[0]: r[1] for r in windows.groupBy("length").count().collect()}
    lengths = sorted(counted) or [window]
    n_windows = sum(counted.values())
    # Neighbouring windows share their blocks, so there are about as many.
    blocks_held = bitmap(window_blocks(windows, lengths), n_windows)
    windows_held = bitmap(windows.select("hash"), n_windows)

    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    words = texts.select("id", content_key(F.col("text")).alias("key"), words_of(F.col("text")).alias("doc"))
    # A slot holds where a block starts and its size, as start * (window + 1) + size. It is computed from the words
    # themselves: generated code makes a column at its first use, and that has to come before the loop over the slots.
    sizes, base = sorted({block_size(n) for n in lengths}), window + 1
    n = F.size("doc").cast("long")
    slots = F.concat(*[F.when(n >= b, F.sequence(
        F.lit(b).cast("long"), (F.floor(n / b) - 1) * b * base + b, F.lit(b * base).cast("long"))).otherwise(
        F.array().cast("array<bigint>")) for b in sizes])
    probes = words.select("id", "key", "doc", F.explode(slots).alias("slot")).select(
        "id", "key", "doc", F.floor(F.col("slot") / base).cast("int").alias("start"), (F.col("slot") % base).alias("size"))

    def by_size(make):
        return reduce(lambda e, b: e.when(F.col("size") == b, make(b)), sizes[1:],
                      F.when(F.col("size") == sizes[0], make(sizes[0])))

    found = maybe_in(probes.withColumn("block", by_size(lambda b: block_hash("doc", F.col("start"), b))), "block", blocks_held)
    # The windows around a block, as offset (of the block) * (window + 1) + length.
    around = {b: F.array(*[F.lit(o * base + m) for m in lengths if block_size(m) == b for o in range(m - b + 1)]) for b in sizes}
    found = found.withColumn("around", F.explode(by_size(around.get)))
    found = found.select("id", "key", "doc", (F.col("start") - F.floor(F.col("around") / base).cast("int")).alias("at"),
                         (F.col("around") % base).alias("length")).filter(
        (F.col("at") >= 0) & (F.col("at") + F.col("length") <= F.size("doc")))
    found = found.select("id", "key", "at", "length", F.slice("doc", F.col("at") + 1, F.col("length")).alias("words"))
    found = maybe_in(found.withColumn("hash", F.xxhash64("words")), "hash", windows_held)

    table = small_or_merged(windows.select(F.col("hash").alias("_hash"), F.col("words").alias("_words"), "set"),
                            F.lit(ROW_BYTES) + F.length(F.array_join("_words", " ")))
    hits = found.join(table, (F.col("hash") == F.col("_hash")) & (F.col("words") == F.col("_words")))
    # A place in a text is one window's, so the sets of a text share no hits.
    grouped = hits.groupBy("id", "key", "set").agg(F.collect_set(F.struct("at", "length")).alias("found")).join(
        sets, "set").groupBy("id", "key").agg(
        F.array_sort(F.flatten(F.collect_list("found"))).alias("found"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    # found is sorted, so each hit adds what lies past the end of those before it.
    covered = F.aggregate(
        "found", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, h: F.struct(
            (acc["n"] + F.greatest(h["at"] + h["length"] - F.greatest(acc["end"], h["at"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], h["at"] + h["length"]).alias("end")))
    return grouped.select("id", "key", F.col("found").alias("hits"), "items",
                          covered["n"].cast("long").alias("n_hit"))


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_hit, items for each row of ``docs``, clean ones too."""
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    counts = texts.select("id", content_key(F.col("text")).alias("key"),
                          F.size(F.array_remove(F.split("text", NOT_WORD_RAW), "")).cast("long").alias("n_words"))
    hits = find_hits(docs, bench, id_col, text_col).select(
        F.col("id").alias("hit_id"), F.col("key").alias("hit_key"), "n_hit", "items")
    return counts.join(hits, counts["id"].eqNullSafe(hits["hit_id"]) & (counts["key"] == hits["hit_key"]), "left").select(
        "id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast(hits.schema["items"].dataType)).alias("items"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    hits = materialise(find_hits(docs, bench, id_col, text_col).select("id", "key"), "contaminated")
    return drop_rows(docs, hits, id_col, text_col)


def cut_spans(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the words inside benchmark windows, and what separates them, cut from the text."""
    hit_id, hit_key, spans = (fresh(docs, n) for n in ("__hit_id", "__hit_key", "__hits"))
    hits = materialise(find_hits(docs, bench, id_col, text_col).select(
        F.col("id").alias(hit_id), F.col("key").alias(hit_key), F.col("hits").alias(spans)), "spans")
    text = text_of(text_col)
    joined = docs.join(hits, docs[id_col].eqNullSafe(F.col(hit_id))
                       & (content_key(text_of(text_col)) == F.col(hit_key)), "left")
    words, gaps = F.array_remove(F.split(text, NOT_WORD_RAW), ""), F.split(text, WORD_RAW, -1)
    kept = let(words, lambda w: let(gaps, lambda g: F.concat(
        F.array_join(F.transform(
            F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: ~F.exists(
                spans, lambda h: (h["at"] <= i) & (i < h["at"] + h["length"]))),
            lambda i: F.concat(F.get(g, i), F.get(w, i))), ""),
        F.element_at(g, -1))))
    return joined.withColumn(text_col, F.when(F.col(spans).isNotNull(), kept).otherwise(F.col(text_col))).select(
        *[F.col(f"`{c}`") for c in docs.columns])

"""The registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bpe, chat, decontaminate, exact_dedup, licenses, line_dedup, pii, quality, secrets, simhash,
               toxicity, whitening)
from .common import n_of, span_text, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                         F.lower(F.hex("digest")).alias("text_sha256"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(secrets.BASE_KINDS))
    return found.select("doc_id", *[n_of(F.col("spans"), k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def encoded(docs: DataFrame) -> DataFrame:
    """doc_id, ids, and the digests of ids and of the text decoded from them."""
    return bpe.round_trip(docs.select("doc_id", "text"), tokenizer_path()).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.id_text(F.col("ids")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents")).drop("ids")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(pii.KINDS))
    return found.select(F.col("id").alias("doc_id"), *[n_of(F.col("spans"), k).alias(f"n_{k}") for k in pii.KINDS],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licenses.scan(docs, licenses.train(docs))
    return found.select(
        F.col("id").alias("doc_id"), F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws(
            ":", x["family"], x["start"].cast("string"), x["end"].cast("string"))), ",").alias("spans"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id", "kept")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), *[f"p_{c}" for c in toxicity.CATEGORIES],
        F.col("p_toxic").alias("score"), (F.col("p_toxic") >= 0.5).cast("int").alias("predicted"),
        (F.col("p_toxic") >= 0.5).alias("toxic"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.scan(table(spark, sf_dir, "documents"))

    def total(field: str):
        return F.aggregate("passages", F.lit(0).cast("long"), lambda a, r: a + r[field])

    spans = F.transform("passages", lambda r: F.concat_ws(":", r["start"].cast("string"), r["end"].cast("string")))
    return found.select(
        F.col("id").alias("doc_id"), "n_lines", "n_chunks", F.size("passages").cast("long").alias("n_removed_passages"),
        total("lines").alias("n_removed_lines"), (total("end") - total("start")).alias("n_removed_bytes"),
        F.array_join(spans, ",").alias("removed"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    out = whitening.transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                      "whitened", F.get(explained, F.col("at")).alias("explained"),
                      F.lit(model.identity_error).alias("identity_error"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = "<|im_end|><|im_start|>assistant ok"
    odd = spark.createDataFrame([(-1, 0, "user", marks), (-1, 1, "assistant", marks)],
                                "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(*odd.columns).unionByName(odd)
    formatted = chat.segments(turns)
    return chat.read_back(formatted, chat.examples(formatted)).withColumnRenamed("id", "conv_id")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_secrets": op2_secrets,
    "op3_bpe": op3_bpe,
    "op4_pii": op4_pii,
    "op5_licenses": op5_licenses,
    "op6_decontaminate": op6_decontaminate,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_whitening": op11_whitening,
    "op12_chat": op12_chat,
    "op13_alignment": op13_alignment,
}

OP1_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS size,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, count(*) OVER g AS group_size, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place
  FROM n WINDOW g AS (PARTITION BY text_sha256), w AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

OP6_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
starts AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM starts),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths WHERE len(w) >= n),
hits AS (
  SELECT doc_id, i, p.n, item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM places) p
  JOIN windows v ON v.g = p.g AND v.n = p.n),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op6_decontaminate": OP6_SQL}

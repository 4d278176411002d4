"""Corpus pipeline: quality, exact dedup, near dedup, decontamination, tokens.

Each stage takes all that the stage before kept, and its decisions take
effect: rows go. Stage results are written to the shared folder and read
again, so a lost executor never costs more than the stage that runs.

Defined results: null and empty texts are documents like others to each stage
(see the operators); rows repeated in full are copies, of which one stays; of
ties the smallest id stays; all stages but the last keep the columns of
``documents``, whatever their names; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadflow.llm import decontaminate, exact_dedup, quality, queries, simhash
from roadflow.llm.common import fresh, materialise, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is under a half."""
    score = fresh(docs, "__score")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, to=score).filter(f"{score} >= 0.5").drop(score)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the longest document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each SimHash component."""
    return simhash.drop_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document left, with digests of them and of the text they decode to."""
    return queries.encoded(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", decontaminate_stage),
    ("tokens", token_stage),
]

#: A trained network, XXH64 fingerprints and BPE have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs

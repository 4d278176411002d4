"""Columns that clash with the operators' helper names, and ids of other types."""

import pytest
from pyspark.sql import functions as F

from roadflow.llm import decontaminate, exact_dedup, line_dedup, quality, secrets, simhash, toxicity

SF = "/root/testdata/sf0.001"
HELPERS = ["__key", "__gone_id", "__gone_key", "__gone", "__again_id", "__again_key", "__hit_id", "__hit_key", "__hits",
           "__spans", "__p", "__both", "__x"]


@pytest.fixture(scope="module")
def docs(spark):
    text = F.when(F.col("i") % 3 == 0, F.lit("one text and its copies")).otherwise(
        F.concat(F.lit("a text of its own, number "), F.col("i").cast("string"), F.lit(" of many; token=abcdefgh1234")))
    rows = spark.range(30).withColumnRenamed("id", "i").select(F.concat(F.lit("d"), "i").alias("doc_id"), text.alias("text"))
    rows = rows.unionByName(rows.filter("doc_id = 'd3'"))
    return rows.withColumns({n: F.lit(n) for n in HELPERS})


BENCH = [("b1", "a text of its own, number 7 of many; token")]


@pytest.mark.parametrize("name, call, n", [
    ("exact", exact_dedup.drop_exact_duplicates, 21),
    ("near", simhash.drop_near_duplicates, None),
    ("drop", lambda d: decontaminate.drop_contaminated(d, d.sparkSession.createDataFrame(BENCH, "item_id string, text string")), 30),
    ("cut", lambda d: decontaminate.cut_spans(d, d.sparkSession.createDataFrame(BENCH, "item_id string, text string")), 31),
    ("lines", line_dedup.drop_repeated_lines, 31),
    ("redact", secrets.redact, 31),
])
def test_columns_of_helper_names_pass_through(docs, name, call, n):
    out = call(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert n is None or len(rows) == n
    assert all(r[c] == c for r in rows for c in HELPERS)


def test_classifiers_take_ids_of_any_type_and_repeated_ids(spark, docs):
    labelled = spark.range(40).select(F.concat(F.lit("t"), "id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"),
                                      F.when(F.col("id") % 2 == 0, "rude awful words here").otherwise("kind words there").alias("text"))
    twice = labelled.unionByName(labelled.withColumn("text", F.concat(F.lit("x "), "text")))  # an id with two texts
    labels = labelled.select("doc_id", F.col("label").alias("quality"), (1 - F.col("label")).alias("toxic"))
    one, two = (quality.score(docs, quality.train(rows, labels)).select("doc_id", "score")
                for rows in (twice.repartition(3), twice.orderBy(F.rand(1)).repartition(2)))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    scored = toxicity.score(docs, toxicity.train(twice, labels))
    assert scored.filter("__p <> '__p'").count() == 0 and scored.count() == docs.count()

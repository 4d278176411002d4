"""License scan with DataFrame functions only.

A passage is a line, or neighbouring lines that a wrapped notice may run over:
lines are linked where the words on both sides of the break, or with one word
between them, stand together in a license template. Lines without words end a
paragraph and link nothing. Passages are described by their word 2- and
3-grams, as far as these occur in license templates. A sparse multinomial
logistic regression (Spark ML) tells families apart, with "unknown" as a class
of its own; a temperature fitted on held-out passages calibrates its
probabilities. A prediction counts only if the passage also holds enough of a
template of that family. Of linked lines and one of them of the same family
the linked lines count, unless they hold no more of the family's templates.

Training passages are word windows of the templates, and as "unknown" a
sample of ``SAMPLE`` different n-gram sets, chosen by hash, of the corpus
passages that hold too little of any template. Counting, scoring and comparing
cover all passages of whole texts. A passage without any template 2-gram has no
features, gets the intercepts alone and is unknown, so such passages are set
aside first; nothing is lost by it. Nor is by scoring only those with enough
template 2-grams to reach ``CONTAINMENT``.

Defined results: null and empty texts have no license; repeated rows get equal
results; an empty table is scored with the templates' windows alone as
training data; other columns are ignored; texts of any length are read whole;
of equally likely families the first of ``FAMILIES`` counts.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import content_key, let, materialise, offsets, text_of

# Short notices by family.
TEMPLATES = {
    "apache": ("Licensed under the Apache License, Version 2.0",
               "you may not use this file except in compliance with the License",
               "distributed on an AS IS BASIS, without warranties or conditions of any kind, either express or implied",
               "SPDX-License-Identifier: Apache-2.0"),
    "mit": ("Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files",
            "The software is provided as is, without warranty of any kind, express or implied",
            "SPDX-License-Identifier: MIT"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation",
            "SPDX-License-Identifier: GPL-3.0"),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 2.1",
             "SPDX-License-Identifier: LGPL-2.1"),
    "bsd": ("Licensed under the BSD 3-Clause License",
            "Redistribution and use in source and binary forms, with or without modification, are permitted",
            "SPDX-License-Identifier: BSD-3-Clause"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
            "SPDX-License-Identifier: MPL-2.0"),
    "cc_by": ("Licensed under CC BY 4.0",
              "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc_by_nc": ("Licensed under CC BY-NC 4.0",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "proprietary": ("All rights reserved", "Proprietary and confidential, unauthorized copying is prohibited"),
}
UNKNOWN = "unknown"
FAMILIES = [UNKNOWN, *TEMPLATES]
SAMPLE, CONTAINMENT, CONFIDENCE = 2000, 0.6, 0.5
L1, ROUNDS = 1e-3, 40
FAMILY_WEIGHT = 40.0  # in rows of the "unknown" sample
TEMPERATURES = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
NOT_WORD = r"[^\p{L}\p{N}]+"


class Model(NamedTuple):
    grams: DataFrame  # gram, weights (by family), templates (that hold it); as many rows as the templates have n-grams
    intercepts: list[float]
    temperature: float
    sizes: list[int]  # n-grams of each template
    owners: list[int]  # family of each template


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), NOT_WORD), "")


def grams_of(words: Column, n: int) -> Column:
    return F.transform(
        F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice(words, i + 1, F.lit(n)), " "))


def all_grams(words: Column) -> Column:
    return let(words, lambda w: F.array_distinct(F.concat(grams_of(w, 2), grams_of(w, 3))))


def templates(spark: SparkSession) -> DataFrame:
    """template (number), family (number), words."""
    rows = [(FAMILIES.index(f), t) for f, texts in TEMPLATES.items() for t in texts]
    frame = spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(rows)], "template int, family int, text string")
    return frame.select("template", "family", words_of(F.col("text")).alias("words"))


def gram_table(spark: SparkSession) -> DataFrame:
    """gram, templates that hold it."""
    return templates(spark).select("template", F.explode(all_grams(F.col("words"))).alias("gram")).groupBy("gram").agg(
        F.sort_array(F.collect_set("template")).alias("templates"))


def _hashes(spark: SparkSession, grams: list[str]) -> dict[str, int]:
    """The n-grams' hashes, from the driver: a function of a literal array would be computed for every passage."""
    rows = spark.createDataFrame([(g, g.split(" ")) for g in grams], "gram string, words array<string>")
    n = {len(g.split(" ")) for g in grams}
    return {r["gram"]: r["h"] for k in n for r in rows.filter(F.size("words") == k).select(
        "gram", F.xxhash64(*[F.get("words", F.lit(i)) for i in range(k)]).alias("h")).collect()}


def _set(hashes) -> Column:
    return F.lit(sorted(hashes) or [0]).cast("array<bigint>")


def _pairs(w: Column) -> Column:
    return F.zip_with(w, F.slice(w, F.lit(2), F.greatest(F.size(w), F.lit(1))), lambda a, b: F.xxhash64(a, b))


def _triples(w: Column) -> Column:
    return F.transform(F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>")),
                       lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))


def passages_of(docs: DataFrame, known: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, id, key, start, end, lines (their number), words and pairs (hashes of the template 2-grams, at least one)
    of each passage. ``known`` has the templates' n-grams and their hashes."""
    spark = docs.sparkSession
    words = [r["words"] for r in templates(spark).select("words").collect()]
    # Both sides of a break, as in the template or with one word of it left out.
    links = _set(_hashes(spark, sorted({f"{w[i]} {w[i + d]}" for w in words for d in (1, 2) for i in range(len(w) - d)})).values())
    text = text_of(text_col)
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                      content_key(text).alias("key"), F.split(text, "\n", -1).alias("lines"))
    cut = cut.select("row", "id", "key", "lines", F.transform("lines", words_of).alias("words"),
                     offsets(F.transform("lines", lambda x: F.length(x).cast("long") + 1)).alias("starts"))

    def linked(w: Column, after: Column) -> Column:
        """Whether a line's text may go on in the next line; a word next to the break may be another one."""
        tail, head = [F.get(w, F.size(w) - i) for i in (1, 2)], [F.get(after, F.lit(i)) for i in (0, 1)]
        sides = F.array(F.xxhash64(tail[0], head[0]), F.xxhash64(tail[0], head[1]), F.xxhash64(tail[1], head[0]))
        return F.coalesce((F.size(w) > 0) & (F.size(after) > 0) & F.arrays_overlap(sides, links), F.lit(False))

    cut = cut.withColumn("on", F.transform("words", lambda w, i: linked(w, F.get("words", i + 1))))
    before = lambda i: F.coalesce(F.get("on", i - 1), F.lit(False))
    place = F.transform("on", lambda on, i: F.struct(on.alias("on"), before(i).alias("before"), i.alias("i")))
    cut = cut.withColumn("place", place)
    # Linked lines begin where only the break after is crossed, and end where only the one before is.
    firsts = F.filter("place", lambda p: p["on"] & ~p["before"])
    lasts = F.filter("place", lambda p: ~p["on"] & p["before"])
    runs = F.zip_with(firsts, lasts, lambda a, z: F.struct(a["i"].alias("first"), z["i"].alias("last")))
    single = F.transform("place", lambda p: F.struct(p["i"].alias("first"), p["i"].alias("last")))
    cut = cut.withColumn("spans", F.concat(single, runs))
    each = cut.select("row", "id", "key", F.explode(F.transform("spans", lambda s: F.struct(
        F.get("starts", s["first"]).alias("start"),
        (F.get("starts", s["last"]) + F.length(F.get("lines", s["last"]))).alias("end"),
        (s["last"] - s["first"] + 1).alias("lines"),
        F.flatten(F.slice("words", s["first"] + 1, s["last"] - s["first"] + 1)).alias("words")))).alias("x")).select(
        "row", "id", "key", "x.*")
    # Hashes may collide, which only lets a passage through that then has no n-gram in the table.
    pairs = _set(h for g, h in known.items() if g.count(" ") == 1)
    found = let(_pairs(F.col("words")), lambda h: F.when(F.arrays_overlap(h, pairs), F.array_intersect(h, pairs)))
    return each.withColumn("pairs", found).filter(F.col("pairs").isNotNull())


def _may_hold(words: list[list[str]], known: dict[str, int]) -> Column:
    """Whether ``pairs`` are enough for ``CONTAINMENT`` of any template: k of its 2-grams come with k 3-grams at most,
    and with k - 1 if none of them stands twice in it."""
    enough = []
    for w in words:
        two = {known[f"{a} {b}"] for a, b in zip(w, w[1:])}
        n = len(two) + len({tuple(w[i:i + 3]) for i in range(len(w) - 2)})
        least = math.ceil((CONTAINMENT * n + (len(two) == len(w) - 1)) / 2 - 1e-9)
        enough.append((max(1, least), two))
    any_of = F.lit(False)
    for k, two in enough:
        any_of = any_of | (F.size(F.array_intersect("pairs", _set(two))) >= k)
    return (F.size("pairs") >= min(k for k, _ in enough)) & any_of


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    spark = docs.sparkSession
    table = materialise(gram_table(spark), "grams")
    vocabulary = sorted(r["gram"] for r in table.select("gram").collect())  # the templates' n-grams
    known = _hashes(spark, vocabulary)
    shapes = templates(spark).select("template", "family", all_grams(F.col("words")).alias("grams"), "words").orderBy(
        "template").collect()
    # Windows of at least 60 % of a template, and of at least three words, stand for partial and changed notices.
    windows = templates(spark).select("family", "words", F.explode(F.sequence(
        F.greatest(F.least(F.lit(3), F.size("words")), F.ceil(F.size("words") * 0.6).cast("int")),
        F.size("words"))).alias("n")).select("family", "words", "n", F.explode(F.sequence(
            F.lit(0), F.size("words") - F.col("n"))).alias("at")).select(
        "family", F.slice("words", F.col("at") + 1, F.col("n")).alias("words"))
    # Each family weighs the same, however few windows its notices have.
    share = windows.groupBy("family").agg((F.lit(FAMILY_WEIGHT) / F.count("*")).alias("weight"))
    positive = windows.join(F.broadcast(share), "family").select(
        "family", "weight", all_grams(F.col("words")).alias("grams"))
    passages = passages_of(docs, known, id_col, text_col)
    # A template 3-gram comes with two template 2-grams.
    triples = _set(h for g, h in known.items() if g.count(" ") == 2)
    more = F.when(F.size("pairs") > 1, F.array_intersect(_triples(F.col("words")), triples))
    sets = passages.select(F.array_sort(F.concat("pairs", F.coalesce(more, F.array().cast("array<bigint>")))).alias("hashes"))
    # Different sets first, so a frequent one fills the sample no more than any other.
    sets = materialise(sets.groupBy("hashes").agg(F.count("*").alias("n")), "license_sets")
    held = [F.size(F.array_intersect("hashes", _set(known[g] for g in r["grams"]))) / len(r["grams"])
            for r in shapes if r["grams"]]
    few = sets.filter(F.greatest(*held) < CONTAINMENT / 2).orderBy(F.xxhash64("hashes"), "hashes").limit(sample)
    names = F.create_map(*[F.lit(x) for g, h in known.items() for x in (h, g)])
    negative = few.select(F.lit(0).alias("family"), F.lit(1.0).alias("weight"),
                          F.transform("hashes", lambda h: F.element_at(names, h)).alias("grams"))
    # The empty passage is the most frequent one: most hold no template n-gram at all.
    empty = spark.range(20).select(F.lit(0).alias("family"), F.lit(1.0).alias("weight"),
                                   F.array().cast("array<string>").alias("grams"))
    rows = positive.unionByName(negative).unionByName(empty).withColumn(
        "fold", F.pmod(F.xxhash64("family", "grams"), F.lit(4)))
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", minTF=1.0)
    rows = materialise(rows, "license_rows").coalesce(1)  # a few thousand rows: an iteration is one small task
    rows = vectors.setBinary(True).transform(rows)
    learner = LogisticRegression(labelCol="family", weightCol="weight", family="multinomial", elasticNetParam=1.0, regParam=L1,
                                 maxIter=ROUNDS, standardization=False)
    # Every family needs rows on both sides; a template's windows are spread over folds by their hash.
    trial = learner.fit(rows.filter("fold <> 0").unionByName(vectors.transform(positive.withColumn("fold", F.lit(1)))).coalesce(1))
    held_out = trial.transform(rows.filter("fold = 0")).select("family", F.col("rawPrediction").alias("raw"))
    losses = held_out.select("family", vector_to_array("raw").alias("raw")).agg(*[
        F.avg(-F.log(F.greatest(F.get(softmax(F.col("raw"), t), F.col("family")), F.lit(1e-9)))).alias(f"t{i}")
        for i, t in enumerate(TEMPERATURES)]).first()
    temperature = min(((losses[f"t{i}"] if losses[f"t{i}"] is not None else 0.0), abs(t - 1), t)
                      for i, t in enumerate(TEMPERATURES))[2]
    model = learner.fit(rows)
    matrix = model.coefficientMatrix.toArray()
    classes = model.numClasses
    weights = spark.createDataFrame(
        [(g, [float(matrix[c][i]) if c < classes else 0.0 for c in range(len(FAMILIES))])
         for i, g in enumerate(vocabulary)], "gram string, weights array<double>")
    return Model(materialise(table.join(weights, "gram"), "license_model"), [float(b) for b in model.interceptVector],
                 temperature, [len(r["grams"]) for r in shapes], [r["family"] for r in shapes])


def softmax(logits: Column, temperature: float) -> Column:
    def normal(scaled: Column) -> Column:
        return let(F.transform(scaled, lambda v: F.exp(v - F.array_max(scaled))), lambda e: let(
            F.aggregate(e, F.lit(0.0), lambda a, v: a + v), lambda s: F.transform(e, lambda v: v / s)))

    return let(F.transform(logits, lambda v: v / temperature), normal)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, licenses (array of start, end, family, confidence, held: share of the template) for each row of ``docs``."""
    vocabulary = sorted(r["gram"] for r in model.grams.select("gram").collect())
    known = _hashes(docs.sparkSession, vocabulary)
    words = [r["words"] for r in templates(docs.sparkSession).select("words").collect()]
    may = passages_of(docs, known, id_col, text_col).filter(_may_hold(words, known))
    at = ["row", "id", "key", "start", "end", "lines"]
    grams = may.select(*at, F.explode(all_grams(F.col("words"))).alias("gram")).join(
        F.broadcast(model.grams), "gram")  # as many rows as the templates have n-grams
    sums = [F.sum(F.get("weights", F.lit(c))).alias(f"w{c}") for c in range(len(FAMILIES))]
    holds = [F.sum(F.array_contains("templates", t).cast("int")).alias(f"t{t}") for t in range(len(model.sizes))]
    per = grams.groupBy(*at).agg(*sums, *holds)
    logits = F.array(*[F.col(f"w{c}") + F.lit(b) for c, b in enumerate(model.intercepts)])
    best = F.array_max(F.transform(softmax(logits, model.temperature), lambda p, c: F.struct(
        p.alias("confidence"), (-c).alias("less"))))

    def share(family: int) -> Column:
        own = [F.col(f"t{t}") / F.lit(float(max(1, n))) for t, n in enumerate(model.sizes) if model.owners[t] == family]
        return F.greatest(*own) if len(own) > 1 else own[0]

    def mass(family: int) -> Column:
        return sum((F.col(f"t{t}") for t, owner in enumerate(model.owners) if owner == family), F.lit(0))

    families = range(1, len(FAMILIES))
    named = per.select("id", "key", "start", "end", "lines", best.alias("best"),
                       F.array(F.lit(0.0), *[share(f) for f in families]).alias("held"),
                       F.array(F.lit(0), *[mass(f) for f in families]).alias("mass")).select(
        "id", "key", "start", "end", "lines", F.col("best.confidence").alias("confidence"),
        (-F.col("best.less")).alias("c"), "held", "mass").select("id", "key", F.struct(
            "start", "end", F.get(F.lit(FAMILIES), F.col("c")).alias("family"),
            F.round("confidence", 6).alias("confidence"), F.get("held", F.col("c")).alias("held"), "lines",
            F.get("mass", F.col("c")).alias("mass")).alias("found"))
    sure = named.filter((F.col("found.family") != UNKNOWN) & (F.col("found.confidence") >= CONFIDENCE)
                        & (F.col("found.held") >= CONTAINMENT))

    def inside(o: Column, s: Column) -> Column:
        return (o["lines"] < s["lines"]) & (s["start"] <= o["start"]) & (o["end"] <= s["end"]) & (o["family"] == s["family"])

    def chosen(found: Column) -> Column:
        runs = F.filter(found, lambda s: (s["lines"] > 1) & ~F.exists(found, lambda o: inside(o, s) & (o["mass"] >= s["mass"])))
        kept = let(runs, lambda r: F.filter(found, lambda o: F.when(o["lines"] > 1, F.array_contains(r, o)).otherwise(
            ~F.exists(r, lambda s: inside(o, s)))))
        return F.transform(kept, lambda x: F.struct(
            *[x[c].alias(c) for c in ("start", "end", "family", "confidence", "held")]))

    # Equal rows of a document find the same passages, so a set is enough.
    per_doc = sure.groupBy(F.col("id").alias("hit_id"), F.col("key").alias("hit_key")).agg(
        let(F.array_sort(F.collect_set("found")), chosen).alias("licenses"))
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), content_key(text).alias("key"))
    kind = per_doc.schema["licenses"].dataType
    return rows.join(per_doc, rows["id"].eqNullSafe(F.col("hit_id")) & (rows["key"] == F.col("hit_key")), "left").select(
        "id", F.coalesce("licenses", F.array().cast(kind)).alias("licenses"))

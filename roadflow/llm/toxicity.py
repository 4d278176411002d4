"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models on words; each
model also gets the probabilities of the categories before it. In training
those are out-of-fold predictions, so a model learns how far to trust what it
will see on new texts. The last category is the label itself; the ones before
it are weak labels: a toxic document that uses a word of the category's seed
list. Seeds only make training labels; weights are learned for all words.

The fit, the choice of words included, takes a bounded sample (``SAMPLE``
documents of each label); only the chosen words of these reach the driver. Rows are scored from their whole texts by the task that holds them.

Defined results: null and empty texts have no words and get the models' base
rates; rows without a usable label do not train; without labels of both values
every probability is the smoothed share of toxic rows; repeated rows get equal
results; an id with several labels has the highest; an empty table gives an
empty result; other columns pass through, but ones named ``p_<category>`` are
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise, small_arrow_batches, text_of
from .quality import held_out

#: Chain order; the seeds of each category but the last, which is the label.
SEEDS = {
    "insult": ("idiot", "moron", "clown", "loser", "scum", "fool", "dumb"),
    "contempt": ("worthless", "trash", "disgusting", "pathetic", "stupid", "garbage", "filth"),
}
CATEGORIES = [*SEEDS, "toxic"]
WORDS, SAMPLE, FOLDS = 1000, 1500, 4
SURE = 16.0  # G, as for a word that stands in seven documents, all toxic, if a third are
ROUNDS, PENALTY = 300, 1e-4
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


class Linear:
    """Logistic regression by Adam on the whole sample."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, penalty: float = PENALTY, rate: float = 0.1):
        share = (y.sum() + 1) / (len(y) + 2)
        w, b = np.zeros(x.shape[1], np.float32), float(np.log(share / (1 - share)))
        m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
        for step in range(1, rounds + 1):
            error = ((1 / (1 + np.exp(-(x @ w + b)))) - y) / max(1, len(y))
            g, gb = x.T @ error + penalty * w, float(error.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            fix, slow = 1 - 0.9 ** step, rate * (1 - step / (rounds + 1))
            w -= (slow * (m / fix) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
            b -= slow * (mb / fix) / (np.sqrt(vb / (1 - 0.99 ** step)) + 1e-8)
        self.weights, self.bias = w, b

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


class Chain:
    """Linear models in order; model k sees the words and the k probabilities before it."""

    def __init__(self, words: list[str], x: np.ndarray, labels: np.ndarray, folds: np.ndarray):
        self.place = {w: i for i, w in enumerate(words)}
        self.models: list[Linear] = []
        for k in range(labels.shape[1]):
            self.models.append(Linear(x, labels[:, k]))
            unseen = np.zeros(len(x), np.float32)
            for fold in np.unique(folds):
                out = folds == fold
                unseen[out] = Linear(x[~out], labels[~out, k])(x[out])
            x = np.column_stack([x, unseen])

    def score(self, texts: Iterator[str]) -> np.ndarray:
        """(texts, categories) probabilities."""
        found = [[self.place[w] for w in words_of(t) & self.place.keys()] for t in texts]
        out = np.zeros((len(found), len(self.models)))
        for k, model in enumerate(self.models):
            words = model.weights[:len(self.place)]
            logit = np.array([words[f].sum() for f in found], np.float64) + model.bias
            logit += out[:, :k] @ model.weights[len(self.place):]
            out[:, k] = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        return out


class Constant:
    """Stands in where the labels cannot train a chain."""

    def __init__(self, share: float):
        self.share = share

    def score(self, texts: Iterator[str]) -> np.ndarray:
        return np.full((len(list(texts)), len(CATEGORIES)), self.share)


def _least(salt: int) -> Column:
    return F.array_min(F.transform("words", lambda w: F.xxhash64(w, F.lit(salt))))


def _distinct_words(texts: pd.Series) -> pd.Series:
    return pd.Series([list(words_of(t)) for t in texts], dtype=object)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE) -> Chain | Constant:
    """A chain from labelled rows that are not held out."""
    small_arrow_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = (n.get(1, 0) + 1) / (n.get(0, 0) + n.get(1, 0) + 2)
    if len(n) < 2:
        return Constant(share)
    ids = [known.filter(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(sample) for c in (0, 1)]
    few = F.broadcast(ids[0].unionByName(ids[1]))  # 2 * sample rows at most
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(few, "id")
    words = F.pandas_udf(_distinct_words, "array<string>")(F.col("text"))
    rows = materialise(texts.select("id", "label", words.alias("words")), "toxicity_rows")
    # Copies of a document must not count as evidence: nearly equal word sets mostly share four smallest hashes,
    # others hardly ever.
    rows = rows.withColumn("least", F.array(*map(_least, range(4)))).groupBy(
        "label", "least").agg(F.min_by(F.struct("id", "words"), F.col("id")).alias("one")).select(
        "one.id", "label", "one.words")
    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    # Words that speak for toxicity, by likelihood ratio, the surest first. Words against it only tell the languages
    # and topics of the sample apart.
    total = max(1, sum(size.values()))
    want = {c: (F.col("n1") + F.col("n0")) * (size.get(k, 0) / total) for k, c in ((0, "n0"), (1, "n1"))}
    sure = sum((F.when(F.col(c) > 0, 2 * F.col(c) * F.log(F.col(c) / want[c])).otherwise(0.0) for c in want), F.lit(0.0))
    counted = rows.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("label").alias("n1"), F.sum(1 - F.col("label")).alias("n0")).withColumn("sure", sure)
    chosen = [r["word"] for r in counted.filter((F.col("n1") > want["n1"]) & (F.col("sure") >= SURE)).orderBy(F.desc("sure"), "word").limit(
        WORDS).collect()]
    kept = F.array_intersect("words", F.lit(chosen) if chosen else F.array().cast("array<string>"))
    seeds = [F.arrays_overlap("words", F.lit(list(s))).alias(c) for c, s in SEEDS.items()]
    got = rows.select("id", "label", kept.alias("words"), *seeds)
    got = sorted(got.collect(), key=lambda r: r["id"])
    place = {w: i for i, w in enumerate(chosen)}
    x = np.zeros((len(got), len(chosen)), np.float32)
    for i, r in enumerate(got):
        x[i, [place[w] for w in r["words"]]] = 1
    truth = np.array([[r["label"] and r[c] for c in SEEDS] + [r["label"]] for r in got], np.float32)
    if len(got) < FOLDS or len(set(truth[:, -1].tolist())) < 2:
        return Constant(share)
    return Chain(chosen, x, truth, np.arange(len(got)) % FOLDS)


def score(docs: DataFrame, model: Chain | Constant, text_col: str = "text") -> DataFrame:
    """``docs`` with p_<category> for each category of the chain."""
    @F.pandas_udf("array<double>")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(list(model.score(texts.tolist())), dtype=object)

    small_arrow_batches(docs.sparkSession)
    p = fresh(docs, "__p")
    out = docs.withColumn(p, scored(text_of(text_col)))
    return out.withColumns({f"p_{c}": F.get(p, F.lit(k)) for k, c in enumerate(CATEGORIES)}).drop(p)

"""Quality classifier: a byte-level convolutional network in numpy.

The bytes of a whole text are cut into overlapping chunks. In each chunk,
learned filters slide over embedded bytes and are max-pooled; two dense layers
turn the pooled responses into the chunk's logit; the mean over all chunks
gives the text's one probability. Texts are scored by the task that holds
them, in slabs of a fixed size, however long they are.

Training uses a bounded sample: at most ``SAMPLE`` labelled documents of each
class and ``CHUNKS`` evenly spread chunks of each, cut by the executors, so a
few MB reach the driver whatever the table's size. The training labels' class
shares set the final bias.

Defined results: null text is an empty text and is scored as one (a chunk of
padding); rows without a usable label do not train; without labels of both
classes every score is the smoothed share of label 1; repeated rows get equal
scores; an id with several labels has the highest, one with several texts trains
on the one whose chunks come first; ids of any type; an empty table gives an
empty result; other columns pass through, but one named like ``to`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_arrow_batches, text_of

CHUNK, STEP, BLOCK = 256, 224, 4
EMBED, FILTERS, HIDDEN = 8, 32, 16
SLAB = 512
SAMPLE, CHUNKS = 800, 8
EPOCHS, RATE, SEED = 14, 3e-3, 7


def chunks_of(text: str) -> np.ndarray:
    """(n, CHUNK) bytes; overlapping chunks that cover the whole text, the last one padded with zeros."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-(len(data) - CHUNK) // STEP) + 1)
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[:len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


class ConvNet:
    """Filters of two byte blocks, one block apart; weights are plain arrays."""

    def __init__(self, rng: np.random.Generator):
        wide = BLOCK * EMBED

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.weights = {
            "embed": normal(256, EMBED, scale=0.5),
            "first": normal(wide, FILTERS, scale=(2 * wide) ** -0.5),
            "second": normal(wide, FILTERS, scale=(2 * wide) ** -0.5),
            "bias": np.zeros(FILTERS, np.float32),
            "dense": normal(FILTERS, HIDDEN, scale=FILTERS ** -0.5), "dense_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, scale=HIDDEN ** -0.5), "out_bias": np.zeros(1, np.float32)}
        self.prior = 0.0

    def responses(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embedded blocks (n, blocks, wide) and filter responses (n, blocks - 1, FILTERS)."""
        w = self.weights
        x = w["embed"][chunks].reshape(len(chunks), CHUNK // BLOCK, BLOCK * EMBED)
        both = x @ np.concatenate([w["first"], w["second"]], axis=1)
        return x, both[:, :-1, :FILTERS] + both[:, 1:, FILTERS:]

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self.weights
        hidden = np.maximum(pooled @ w["dense"] + w["dense_bias"], 0)
        return hidden, hidden @ w["out"] + w["out_bias"][0]

    def logits(self, chunks: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self.responses(chunks)[1].max(axis=1) + self.weights["bias"], 0)
        return self.head(pooled)[1]

    def gradients(self, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy; ``owner`` is the text (0, 1, ...) of each chunk."""
        w, rows = self.weights, np.arange(len(chunks))[:, None]
        x, conv = self.responses(chunks)
        at = conv.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(conv, at[:, None], axis=1)[:, 0] + w["bias"], 0)
        hidden, logits = self.head(pooled)
        per = np.bincount(owner, minlength=len(labels))
        mean = np.bincount(owner, logits, minlength=len(labels)) / per
        error = ((1 / (1 + np.exp(-mean)) - labels) / len(labels)).astype(np.float32)
        d_logit = error[owner] / per[owner].astype(np.float32)
        d_hidden = np.outer(d_logit, w["out"]) * (hidden > 0)
        d_pool = (d_hidden @ w["dense"].T) * (pooled > 0)
        here, after = x[rows, at], x[rows, at + 1]  # (n, FILTERS, wide)
        d_embed = np.zeros_like(w["embed"])
        for weight, shift in (("first", 0), ("second", 1)):
            d_x = (d_pool[:, :, None] * w[weight].T[None]).reshape(-1, EMBED)
            source = chunks[rows[:, :, None], ((at + shift) * BLOCK)[:, :, None] + np.arange(BLOCK)].reshape(-1)
            for k in range(EMBED):
                d_embed[:, k] += np.bincount(source, d_x[:, k], minlength=256).astype(np.float32)
        return {
            "embed": d_embed, "first": np.einsum("nf,nfk->kf", d_pool, here),
            "second": np.einsum("nf,nfk->kf", d_pool, after), "bias": d_pool.sum(axis=0),
            "dense": pooled.T @ d_hidden, "dense_bias": d_hidden.sum(axis=0),
            "out": hidden.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator,
            epochs: int = EPOCHS, rate: float = RATE, batch: int = 32) -> None:
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(texts))
            for some in np.array_split(order, max(1, len(order) // batch)):
                step += 1
                owner = np.repeat(np.arange(len(some)), [len(texts[i]) for i in some])
                found = self.gradients(np.concatenate([texts[i] for i in some]), owner, labels[some])
                slow = rate * (1 - epoch / epochs)
                for k, g in found.items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    self.weights[k] -= slow * (mean[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-7)

    def score(self, texts: Iterable[str]) -> np.ndarray:
        """The probability of each text; ``SLAB`` chunks at a time."""
        cut = [chunks_of(t) for t in texts]
        per = np.array([len(c) for c in cut])
        sums, owner = np.zeros(len(cut)), np.repeat(np.arange(len(cut)), per)
        waiting, held, done = [], 0, 0

        def run() -> None:
            nonlocal waiting, held, done
            slab = np.concatenate(waiting)
            np.add.at(sums, owner[done:done + len(slab)], self.logits(slab))
            done += len(slab)
            waiting, held = [], 0

        for chunks in cut:
            for at in range(0, len(chunks), SLAB):
                waiting.append(chunks[at:at + SLAB])
                held += len(waiting[-1])
                if held >= SLAB:
                    run()
        if held:
            run()
        return 1 / (1 + np.exp(-(sums / per + self.prior)))


class Constant:
    """Stands in where the labels cannot train a network."""

    def __init__(self, share: float):
        self.share = share

    def score(self, texts: Iterable[str]) -> np.ndarray:
        return np.full(len(list(texts)), self.share)


def held_out(doc_id: Column) -> Column:
    """A third of the ids, by checksum; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _cut(frames: Iterator[pd.DataFrame], most: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for text in frame["text"]:
            chunks = chunks_of(text)
            at = np.unique(np.linspace(0, len(chunks) - 1, most).round().astype(int))
            rows.append(chunks[at].tobytes())
        yield pd.DataFrame({"label": frame["label"].astype("int32"), "id": frame["id"], "chunks": rows})


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE, most: int = CHUNKS) -> ConvNet | Constant:
    """A network from labelled rows that are not held out."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = (n.get(1, 0) + 1) / (n.get(0, 0) + n.get(1, 0) + 2)
    chosen = [known.filter(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(sample) for c in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * sample rows at most
    small_arrow_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).join(chosen, "id")
    kind = texts.schema["id"].dataType.simpleString()
    rows = texts.mapInPandas(partial(_cut, most=most), f"label int, id {kind}, chunks binary")
    # Repeated rows of an id must not pass the bound either; of different texts always the same one counts.
    rows = rows.groupBy("id").agg(F.min(F.struct("chunks", "label")).alias("r")).select("id", "r.label", "r.chunks")
    rows = sorted(rows.collect(), key=lambda r: r["id"])
    truth = np.array([r["label"] for r in rows], np.float32)
    if len(set(truth.tolist())) < 2:
        return Constant(share)
    rng = np.random.default_rng(SEED)
    net = ConvNet(rng)
    net.fit([np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK) for r in rows], truth, rng)
    sampled = truth.mean()
    net.prior = float(np.log(share / (1 - share)) - np.log(sampled / (1 - sampled)))
    return net


def score(docs: DataFrame, model: ConvNet | Constant, text_col: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``to``."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts.tolist()), dtype="float64")

    small_arrow_batches(docs.sparkSession)
    return docs.withColumn(to, scored(text_of(text_col)))

"""Quality scores by logistic regression on hashed word n-grams.

Words and runs of punctuation, and pairs of neighbours, are hashed to a fixed number
of features; a pair of equal neighbours is one feature of its own, whatever the word.
A feature's value is the logarithm of one plus its count, scaled to a fixed length of the vector. Weights
follow the regularised leader, one document at a time, on shards of a bounded sample of
labelled documents; the shards' weights are averaged. A score is the sparse dot product.

Defined results: labels of fold 0 are never read; null and empty texts have no features
and get the score of the bias alone; without labels every score is 0.5; repeated rows
get equal scores; a text's length is not limited. Of rows that repeat a labelled id one is
learnt from. A score at the threshold is predicted 1. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import Workspace, fold, known_labels, training_rows
from tidegauge.llm.workers import once_per_worker

#: Labelled documents the weights are fitted on, at most about.
SAMPLE = 20_000
#: Labelled documents of a shard.
SHARD = 2_500
FEATURES = 1 << 18
EPOCHS = 5
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.01, 1e-4
#: Length of a document's vector of values, next to a bias of one.
LENGTH = 3.0
THRESHOLD = 0.3
REMEMBERED = 250_000

BIAS, REPEATED = 0, 1
TOKEN = re.compile(r"\w+|[^\w\s]+")


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[token] = zlib.crc32(token.lower().encode())
        return h


def features(text: str | None, hashes: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of a text's features, the bias included."""
    tokens = TOKEN.findall(text or "")
    if not tokens:
        return np.array([BIAS]), np.ones(1)
    h = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    pairs = (h[:-1] * np.uint64(0x9E3779B1) ^ h[1:] * np.uint64(0x85EBCA77)) >> np.uint64(11)
    index = np.concatenate((h, pairs)) % np.uint64(FEATURES - 2) + np.uint64(2)
    index[len(h) :][h[:-1] == h[1:]] = REPEATED
    found, counts = np.unique(index.astype(np.int64), return_counts=True)
    value = np.log1p(counts)
    value *= LENGTH / np.sqrt((value * value).sum())
    return np.concatenate(([BIAS], found)), np.concatenate(([1.0], value))


class Leader:
    """Weights that follow the regularised leader, feature by feature."""

    def __init__(self):
        self.z, self.n = np.zeros(FEATURES), np.zeros(FEATURES)

    def weights(self, index: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / rate)

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(index)
        g = (sigmoid(w @ value) - label) * value
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[index] = n + g * g


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(index, weight) of every shard; rows come sorted by shard."""
    shard, rows, hashes = None, [], _Hashes()

    def fitted():
        leader, order = Leader(), np.random.default_rng(7)
        for _ in range(EPOCHS):
            for i in order.permutation(len(rows)):
                leader.learn(*rows[i])
        w = leader.weights(slice(None))
        index = np.flatnonzero(w)
        return pa.RecordBatch.from_arrays([pa.array(index), pa.array(w[index])], names=["index", "weight"])

    for batch in batches:
        for number, text, label in zip(*(batch.column(c).to_pylist() for c in ("shard", "text", "label")), strict=True):
            if number != shard and rows:
                yield fitted()
                rows = []
            shard = number
            rows.append((*features(text, hashes), label))
    if rows:
        yield fitted()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights of all features, from at most about ``sample`` labelled documents outside fold 0."""
    space = Workspace(docs.sparkSession, "quality")
    known = space.keep(known_labels(labels, "quality", sample), "labels")
    shards = max(1, round(known.count() / SHARD))
    rows = training_rows(docs, known)
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard")
    weights = (
        rows.select(shard, "doc_id", "text", "label")
        .repartition("shard")
        .sortWithinPartitions("shard", "doc_id", "text")
        .mapInArrow(_fit_shards, "index long, weight double")
        .groupBy("index")
        .agg(F.sum("weight").alias("weight"))
    )
    w = np.zeros(FEATURES)
    for index, weight in weights.collect():  # one row a feature at most
        w[index] = weight / shards
    return w


def score(docs: DataFrame, weights: np.ndarray) -> Column:
    """Probability of label 1 by a text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w, hashes = shared.value, once_per_worker("quality hashes", 0, _Hashes)
        for texts in batches:
            dots = np.zeros(len(texts))
            for i, text in enumerate(texts.to_pylist()):
                index, value = features(text, hashes)
                dots[i] = w[index] @ value
            yield pa.array(sigmoid(dots))

    return scored(F.col("text"))


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    value = score(docs, fit(docs, labels, sample))
    return docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), value.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )

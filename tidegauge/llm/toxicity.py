"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens are tagged toxic or clean. Labels exist for documents only, so training tokens
are labelled first: in a toxic document a token is toxic if one of its features (the
word, its beginnings and its end) is far more frequent in toxic than in other labelled
documents; all tokens of other documents are clean. A chain is a line, or a stretch of
``CHAIN`` tokens of a longer one; its tag probabilities are the forward-backward
marginals. A document's score is a logistic function of its largest marginal, their sum
and their mean.

Everything is learned from a bounded sample of labelled documents outside fold 0, on
shards whose parameters are averaged.

Defined results: null, empty and blank texts have no tokens and get the score of a text
without suspicion; without labels, or with one class only, every score is 0; repeated
rows get equal scores; lines and texts of any length are read whole. Of rows that repeat a
labelled id one is learnt from. A score at the threshold is predicted 1 and does not stay.
An empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.tables import Workspace, fold, known_labels, training_rows
from tidegauge.llm.workers import once_per_worker, portions, slim

#: Labelled documents everything is fitted on, at most about.
SAMPLE = 10_000
SHARD = 800
FEATURES = 1 << 20
MASK = FEATURES - 1
BEGINNINGS = (4, 5, 6)
EPOCHS = 4
#: Chains of a training step.
STEP = 512
RATE, DECAY = 0.5, 1e-6
#: A toxic token's feature is in so many toxic documents, and its log odds are so large.
SUPPORT, ODDS = 4, 3.0
THRESHOLD = 0.5
#: Marginals from which a token is reported as an offending span.
SPAN = 0.5
#: Tokens a worker remembers the emission of, and the features of; beyond that it starts anew.
REMEMBERED, REMEMBERED_FEATURES = 150_000, 50_000
TOGETHER = 512

#: Most tokens of a chain; a longer line is several chains.
CHAIN = 256
#: Marks taken off both ends of a token.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»„“”‘’…–—|"
TOKEN = re.compile(r"\S+")


def token_features(token: str) -> list[int]:
    """Hashed features of a token: the word, beginnings of 4 to 6 bytes, an end of 4."""
    word = token.lower().strip(MARKS).encode()
    found = [crc32(word) & MASK, crc32(word[-4:], 1) & MASK]
    # the second argument keeps the kinds of features apart
    found += [crc32(word[:n], n) & MASK for n in BEGINNINGS if len(word) >= n]
    return found


class _Features(dict):
    def __missing__(self, token: str) -> list[int]:
        if len(self) >= REMEMBERED_FEATURES:
            self.clear()
        found = self[token] = token_features(token)
        return found


class _Emissions(dict):
    """How much a token speaks for the toxic tag."""

    def __init__(self, weights: np.ndarray):
        self.weights = array("d", weights.tolist())

    def __missing__(self, token: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        weights = self.weights
        x = self[token] = sum([weights[f] for f in token_features(token)])
        return x


def marginals(
    emission: np.ndarray, lengths: np.ndarray, moves: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None]:
    """(p, table): probability of the toxic tag of every token; with ``pairs``, expected moves of all chains.

    Chains lie one after another in ``emission``; ``moves`` is the 2 by 2 table of
    transition scores. All chains advance together, longest first, so the work is one
    array operation per position. Messages are log ratios of toxic to clean.
    """
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    first = (np.cumsum(lengths) - lengths)[order]
    steps = int(sizes[0]) if len(sizes) else 0
    # chains still running at each position
    alive = np.searchsorted(-sizes, -np.arange(steps), side="left")
    forward, backward = np.empty(len(emission)), np.zeros(len(emission))
    ratio = np.zeros(0)
    for t in range(steps):
        at = first[: alive[t]] + t
        if t:
            ratio = ratio[: alive[t]]
            ratio = np.logaddexp(ratio + moves[1, 1], moves[0, 1]) - np.logaddexp(ratio + moves[1, 0], moves[0, 0])
        else:
            ratio = np.zeros(alive[0])
        ratio = ratio + emission[at]
        forward[at] = ratio
    for t in range(steps - 2, -1, -1):
        at = first[: alive[t + 1]] + t
        ahead = backward[at + 1] + emission[at + 1]
        backward[at] = np.logaddexp(ahead + moves[1, 1], moves[1, 0]) - np.logaddexp(ahead + moves[0, 1], moves[0, 0])
    p = 1 / (1 + np.exp(-np.clip(forward + backward, -500, 500)))
    if not pairs:
        return p, None
    # moves between neighbours of one chain
    inner = np.ones(len(emission), bool)
    inner[first] = False
    i = np.flatnonzero(inner)
    table = np.zeros((2, 2))
    if len(i):
        ahead = backward[i] + emission[i]
        scores = np.stack(
            [moves[a, b] + a * forward[i - 1] + b * ahead for a in (0, 1) for b in (0, 1)]
        )
        scores -= scores.max(0)
        weight = np.exp(scores)
        table = (weight / weight.sum(0)).sum(1).reshape(2, 2)
    return p, table


def chains(text: str | None) -> list[list[str]]:
    """Tokens of the lines of a text, in chains."""
    return [
        tokens[at : at + CHAIN]
        for line in (text or "").split("\n")
        if (tokens := line.split())
        for at in range(0, len(tokens), CHAIN)
    ]


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, clean): documents of either label that have a feature."""
    counts, known = np.zeros((2, FEATURES), np.int64), _Features()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            found = {f for token in set((text or "").split()) for f in known[token]}
            counts[label][list(found)] += 1
    feature = np.flatnonzero(counts.any(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(feature), pa.array(counts[1][feature]), pa.array(counts[0][feature])],
        names=["feature", "toxic", "clean"],
    )


def _fit_shards(shared) -> object:
    """For ``mapInArrow``: (index, value) of every shard's parameters; moves come after the features."""

    def fitted(rows: list, telling: np.ndarray) -> pa.RecordBatch:
        # packed, as lists of numbers would take many times the memory
        known, lengths, index, sizes, tags = _Features(), array("i"), array("i"), array("b"), array("b")
        for text, label in rows:
            for tokens in chains(text):
                lengths.append(len(tokens))
                for token in tokens:
                    f = known[token]
                    sizes.append(len(f))
                    index.extend(f)
                    tags.append(1 if label and telling[f].any() else 0)
        lengths, index, sizes, tags = (np.array(x) for x in (lengths, index, sizes, tags))
        owner = np.repeat(np.arange(len(tags), dtype=np.int32), sizes)
        token_ends = np.cumsum(lengths, dtype=np.int64)
        feature_ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        weights, moves = np.zeros(FEATURES), np.zeros((2, 2))
        squares, move_squares = np.full(FEATURES, 1e-2), np.full((2, 2), 1e-2)
        random = np.random.default_rng(7)
        steps = []
        for at in range(0, len(lengths), STEP):
            some = lengths[at : at + STEP]
            a = token_ends[at] - lengths[at]
            b = a + some.sum()
            tag = tags[a:b].astype(float)
            inner = np.ones(b - a, bool)
            inner[np.cumsum(some) - some] = False
            j = np.flatnonzero(inner)
            real = np.bincount((2 * tag[j - 1] + tag[j]).astype(int), minlength=4).reshape(2, 2)
            which, back = np.unique(index[feature_ends[a] : feature_ends[b]], return_inverse=True)
            o = owner[feature_ends[a] : feature_ends[b]] - np.int32(a)
            steps.append((some, tag, real, o, which, back.astype(np.int32)))
        for _ in range(EPOCHS):
            for at in random.permutation(len(steps)):
                some, tag, real, o, which, back = steps[at]
                emission = np.bincount(o, weights[which][back], len(tag))
                p, pairs = marginals(emission, some, moves, pairs=True)
                # toxic tokens are rare: gradients are sums over the step, rates adapt to each parameter
                g = np.bincount(back, (p - tag)[o], len(which)) + DECAY * weights[which]
                squares[which] += g * g
                weights[which] -= RATE * g / np.sqrt(squares[which])
                g = pairs - real
                move_squares += g * g
                moves -= RATE * g / np.sqrt(move_squares)
        some = np.flatnonzero(weights)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((some, FEATURES + np.arange(4)))), pa.array(np.concatenate((weights[some], moves.ravel())))],
            names=["index", "value"],
        )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        telling = np.zeros(FEATURES, bool)
        telling[shared.value] = True
        shard, rows = None, []
        for batch in slim(batches):
            for number, text, label in zip(*(batch.column(c).to_pylist() for c in ("shard", "text", "label")), strict=True):
                if number != shard and rows:
                    yield fitted(rows, telling)
                    rows = []
                shard = number
                rows.append((text, label))
        if rows:
            yield fitted(rows, telling)

    return fit


class Tagger:
    """Learned parameters; of fixed size."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, key: int):
        self.weights, self.moves, self.key = weights, moves, key
        #: of (1, logit of the largest marginal, log of one plus their sum, their mean)
        self.judge = np.zeros(4)

    def emissions(self) -> _Emissions:
        return once_per_worker("toxicity emissions", self.key, lambda: _Emissions(self.weights))

    def summaries(self, texts: list[str | None]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(evidence, marginals) of texts."""
        emission = self.emissions().__getitem__
        found = [chains(x) for x in texts]
        lengths = np.array([len(c) for doc in found for c in doc], np.int64)
        n = int(lengths.sum())
        p, _ = marginals(np.fromiter((emission(t) for doc in found for c in doc for t in c), float, n), lengths, self.moves)
        per_doc = [p[a:b] for a, b in _spans([sum(map(len, doc)) for doc in found])]
        evidence = np.zeros((len(texts), 4))
        evidence[:, 0] = 1
        for row, q in zip(evidence, per_doc, strict=True):
            top = min(max(float(q.max()) if len(q) else 0.0, 1e-6), 1 - 1e-6)
            row[1:] = np.log(top / (1 - top)) / 10, np.log1p(q.sum()), q.mean() * 10 if len(q) else 0.0
        return evidence, per_doc

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        if not self.judge.any():
            return np.zeros(len(evidence))
        return 1 / (1 + np.exp(-np.clip(evidence @ self.judge, -30, 30)))


def _spans(sizes: list[int]) -> Iterator[tuple[int, int]]:
    at = 0
    for n in sizes:
        yield at, at + n
        at += n


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x.T @ (p - y) + ridge * w)
    return w


def _tag(shared, keep: list[str]):
    """For ``mapInArrow``: the columns ``keep`` with evidence, score and offending spans."""

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
        for whole in slim(batches):
            for batch in portions(whole, "text", TOGETHER):
                texts = batch.column("text").to_pylist()
                evidence, per_doc = tagger.summaries(texts)
                spans = [
                    [
                        {"start": m.start(), "end": m.end(), "p": float(x)}
                        for m, x in zip(TOKEN.finditer(text), q, strict=True)
                        if x >= SPAN
                    ]
                    if len(q) and q.max() >= SPAN
                    else []
                    for text, q in zip(texts, per_doc, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c) for c in keep),
                        pa.array(evidence.tolist(), pa.list_(pa.float64())),
                        pa.array(tagger.scores(evidence)),
                        pa.array(spans, kind),
                    ],
                    names=[*keep, "evidence", "score", "spans"],
                )

    return tag


TAGGED = "evidence array<double>, score double, spans array<struct<start: long, end: long, p: double>>"


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Tagger:
    """Parameters from at most about ``sample`` labelled documents outside fold 0."""
    spark = docs.sparkSession
    space = Workspace(spark, "toxicity")
    known = space.keep(known_labels(labels, "toxic", sample), "labels")
    rows = space.keep(training_rows(docs, known), "sample")
    n = dict(rows.groupBy("label").count().collect())
    if not n.get(0) or not n.get(1):
        return Tagger(np.zeros(FEATURES), np.zeros((2, 2)), 0)
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    telling = (
        rows.mapInArrow(_count_features, "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= SUPPORT) & (odds >= ODDS))
        .select("feature")
    )
    shared = spark.sparkContext.broadcast(np.array([r.feature for r in telling.collect()], np.int64))
    shards = max(1, round((n[0] + n[1]) / SHARD))
    found = (
        rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
        .repartition("shard")
        .sortWithinPartitions("shard", "doc_id", "text")
        .mapInArrow(_fit_shards(shared), "index long, value double")
        .groupBy("index")
        .agg(F.sum("value").alias("value"))
    )
    values = np.zeros(FEATURES + 4)
    for index, value in found.collect():  # one row a parameter at most
        values[index] = value / shards
    tagger = Tagger(values[:FEATURES].astype(np.float32), values[FEATURES:].reshape(2, 2), crc32(values.tobytes()))
    judged = rows.mapInArrow(
        _tag(spark.sparkContext.broadcast(tagger), ["label"]), f"label int, {TAGGED}"
    ).select("label", "evidence")
    pairs = judged.collect()  # one row a labelled document, so bounded by the sample
    tagger.judge = _logistic(np.array([r.evidence for r in pairs]), np.array([r.label for r in pairs], float))
    return tagger


def scores(docs: DataFrame, tagger: Tagger, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every row; spans are code point offsets."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    return (
        docs.select("doc_id", "text")
        .mapInArrow(_tag(shared, ["doc_id"]), f"doc_id {dict(docs.dtypes)['doc_id']}, {TAGGED}")
        .select(
            "doc_id",
            F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
            "score",
            (F.col("score") >= threshold).cast("int").alias("predicted"),
            "spans",
        )
    )


def without_toxic(docs: DataFrame, tagger: Tagger, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = shared.value
        for texts in slim(batches):
            whole = pa.RecordBatch.from_arrays([texts], names=["text"])
            found = [
                tagger.scores(tagger.summaries(some.column("text").to_pylist())[0])
                for some in portions(whole, "text", TOGETHER)
            ]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))

    return docs.filter(scored(F.col("text")) < threshold)

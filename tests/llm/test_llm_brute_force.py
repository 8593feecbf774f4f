"""Learners, scores and walks against plain loops over their definitions."""

import math
import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from tidegauge.llm import edit_fingerprints, quality, toxicity


def prose(seed, n=40):
    r = random.Random(seed)
    return " ".join(r.choice(["sea", "tide", "of", "the", "Gauge,", "meer", "über", "!!", "the the"]) for _ in range(n))


# --- quality -----------------------------------------------------------------------


def plain_features(text):
    """Feature to value, from the definition."""
    tokens = quality.TOKEN.findall(text or "")
    if not tokens:
        return {quality.BIAS: 1.0}
    h = [zlib.crc32(t.lower().encode()) for t in tokens]
    room, counts = quality.FEATURES - 2, {}
    for x in h:
        counts[x % room + 2] = counts.get(x % room + 2, 0) + 1
    for a, b in zip(h, h[1:]):
        mixed = ((a * 0x9E3779B1 % 2**64) ^ (b * 0x85EBCA77 % 2**64)) >> 11
        index = quality.REPEATED if a == b else mixed % room + 2
        counts[index] = counts.get(index, 0) + 1
    values = {i: math.log1p(n) for i, n in counts.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    return {quality.BIAS: 1.0, **{i: v * quality.LENGTH / length for i, v in values.items()}}


def plain_ftrl(rows):
    """Weights that follow the regularised leader, one number at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        rate = (quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2
        return (math.copysign(quality.L1, z[i]) - z[i]) / rate

    order = np.random.default_rng(7)
    made = [(plain_features(text), label) for text, label in rows]
    for _ in range(quality.EPOCHS):
        for k in order.permutation(len(made)):
            values, label = made[k]
            w = {i: weight(i) for i in values}
            p = 1 / (1 + math.exp(-max(-30, min(30, sum(w[i] * v for i, v in values.items())))))
            for i, v in values.items():
                g = (p - label) * v
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / quality.ALPHA * w[i]
                n[i] = before + g * g
    return {i: weight(i) for i in z}


@pytest.mark.parametrize("text", [None, "", "one", "the the the", prose(1), prose(2, 300), "!!! ??? über ÜBER"])
def test_features_by_definition(text):
    index, value = quality.features(text, quality._Hashes())
    assert dict(zip(index.tolist(), value.tolist())) == pytest.approx(plain_features(text))


def test_shards_are_fitted_as_the_plain_leader_is():
    shards = {s: [(prose(100 * s + i, 5 + i % 30) + (" $$$" if i % 3 else ""), int(i % 3 == 0)) for i in range(60)] for s in (0, 1)}
    batch = pa.RecordBatch.from_pydict(
        {
            "shard": [s for s, rows in shards.items() for _ in rows],
            "text": [t for rows in shards.values() for t, _ in rows],
            "label": [y for rows in shards.values() for _, y in rows],
        }
    )
    got = [dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())) for b in quality._fit_shards(iter([batch]))]
    for found, rows in zip(got, shards.values(), strict=True):
        wanted = {i: w for i, w in plain_ftrl(rows).items() if w}
        assert found.keys() == wanted.keys() and found == pytest.approx(wanted, rel=1e-9)


def test_scores_are_sparse_dot_products(spark):
    weights = np.random.default_rng(3).normal(size=quality.FEATURES)
    texts = [None, "", prose(1), prose(2, 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = docs.select("doc_id", quality.score(docs, weights).alias("score")).collect()
    for r in got:
        dot = sum(float(np.float32(weights[i])) * v for i, v in plain_features(texts[r.doc_id]).items())
        assert r.score == pytest.approx(1 / (1 + math.exp(-dot)), rel=1e-5)


def test_weights_are_the_mean_of_the_shards(spark, monkeypatch):
    monkeypatch.setattr(quality, "SHARD", 40)
    rows = [(i, prose(i) + (" $$$" if i % 3 else "")) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int")
    got = quality.fit(docs, labels)
    known = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    shards = max(1, round(len(known) / 40))
    place = {r.doc_id: r.s for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {shards}) as s").collect()}
    wanted = np.zeros(quality.FEATURES)
    for s in range(shards):
        for i, w in plain_ftrl([(rows[i][1], int(i % 3 == 0)) for i in known if place[i] == s]).items():
            wanted[i] += w / shards
    assert shards > 1 and np.allclose(got, wanted, atol=1e-9)


# --- toxicity ----------------------------------------------------------------------


def test_a_document_is_judged_by_the_marginals_of_its_chains():
    draw = np.random.default_rng(5)
    tagger = toxicity.Tagger(draw.normal(size=toxicity.FEATURES).astype(np.float32), draw.normal(size=(2, 2)), 77)
    tagger.judge = draw.normal(size=4)
    texts = ["vermin go home\nthe sea", "one", "", None, "a b c d e"]
    evidence, per_doc = tagger.summaries(texts)
    emission = tagger.emissions()
    for text, row, q, score in zip(texts, evidence, per_doc, tagger.scores(evidence), strict=True):
        wanted = []
        for chain in toxicity.chains(text):
            e = [emission[t] for t in chain]
            tags = list(product((0, 1), repeat=len(e)))
            w = np.array([math.exp(sum(x * t for x, t in zip(e, tag)) + sum(tagger.moves[a, b] for a, b in zip(tag, tag[1:]))) for tag in tags])
            w /= w.sum()
            wanted += [sum(x for x, tag in zip(w, tags) if tag[i]) for i in range(len(e))]
        assert q.tolist() == pytest.approx(wanted, abs=1e-9)
        top = min(max(max(wanted, default=0.0), 1e-6), 1 - 1e-6)
        parts = [1, math.log(top / (1 - top)) / 10, math.log1p(sum(wanted)), 10 * sum(wanted) / max(len(wanted), 1)]
        assert row.tolist() == pytest.approx(parts)
        assert score == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(parts, tagger.judge)))))


def test_parameters_are_the_mean_of_the_shards(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 60)
    seen = []
    fit_shards = toxicity._fit_shards
    monkeypatch.setattr(toxicity, "_fit_shards", lambda shared: seen.append(shared) or fit_shards(shared))
    rows = [(i, prose(i) + (" vermin rotten" if i % 4 == 0 else "")) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    tagger = toxicity.fit(docs, labels)
    known = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    shards = max(1, round(len(known) / 60))
    place = {r.doc_id: r.s for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {shards}) as s").collect()}
    ordered = sorted(known, key=lambda i: (place[i], i))
    batch = pa.RecordBatch.from_pydict(
        {"shard": [place[i] for i in ordered], "text": [rows[i][1] for i in ordered], "label": [int(i % 4 == 0) for i in ordered]}
    )
    values = np.zeros(toxicity.FEATURES + 4)
    for part in fit_shards(seen[0])(iter([batch])):
        values[part.column(0).to_numpy()] += part.column(1).to_numpy() / shards
    assert shards > 1
    assert np.allclose(tagger.weights, values[: toxicity.FEATURES], atol=1e-6)
    assert np.allclose(tagger.moves.ravel(), values[toxicity.FEATURES :], atol=1e-9)


# --- edit fingerprints ---------------------------------------------------------------


def plain_fingerprint(text):
    """The walk step by step: repeat the character, and go on where the shared bit says so."""
    f = edit_fingerprints
    if not text:
        return "00"
    points = [ord(c) for c in text]
    one = lambda x: int(f._hash(np.array([x], np.uint64))[0])
    kinds, steps = {p: one(p) % f.CLASSES for p in set(points)}, []
    bits = {}
    for i, p in enumerate(points):
        while True:
            at = kinds[p] * f.PERIOD + len(steps) % f.PERIOD
            steps.append(i)
            if bits.setdefault(at, one(at) & 1):
                break
    level = max(0, (len(steps) // f.SAMPLES).bit_length() - 1)
    digits = []
    for stretch in range(math.ceil(len(steps) / 2**level)):
        at = stretch
        for upper in range(level, 0, -1):
            at = 2 * at + (one(at * 64 + upper) & 1)
        if at >= len(steps):
            digits.append(0)
            continue
        seen = 0
        for k in range(f.WINDOW):
            seen = one((seen * 31 + points[min(steps[at] + k, len(points) - 1)]) % 2**64)
        digits.append(seen % 15 + 1)
    return f"{level:02x}" + "".join(f"{d:x}" for d in digits)


@pytest.mark.parametrize("text", ["", "a", "ab", "aaaa" * 50, prose(1), prose(2, 400), "漢字 über 😀 " * 60])
def test_walk_by_definition(text):
    assert edit_fingerprints.fingerprint(text) == plain_fingerprint(text)

import math
import random
from collections import Counter
from itertools import product
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import backoff_lm, backoff_relational, quality, toxicity
from tidegauge.llm.tables import known_labels

SCHEMA = "doc_id long, text string"


def prose(seed, n=40):
    r = random.Random(seed)
    return " ".join(r.choice(["sea", "tide", "of", "the", "Gauge", "meer", "über"]) + str(r.randrange(9)) for _ in range(n))


def fold(doc_id):
    return crc32(str(doc_id).encode()) % 5


# --- stupid backoff ----------------------------------------------------------------


def brute_scores(docs, size):
    words = [(d, (t or "").lower().split()) for d, t in docs]
    counts = Counter(w for _, x in words for w in x)
    steps = {w: math.floor(math.log2(n) * 32) for w, n in counts.items()}
    known, room = set(), size
    for step in sorted(set(steps.values()), reverse=True):
        some = {w for w, s in steps.items() if s == step}
        if len(some) > room:
            break
        known |= some
        room -= len(some)
    words = [(d, [w if w in known else None for w in x]) for d, x in words]
    alone = Counter(w for _, x in words for w in x)
    alone["<s>"] = sum(bool(x) for _, x in words)
    total = sum(counts.values())
    pairs = [Counter(zip(["<s>", *x], x)) for _, x in words]
    both = sum(pairs, Counter())
    out = {}
    for (doc_id, x), own in zip(words, pairs, strict=True):
        if doc_id is None:
            continue
        score = 0.0
        for (a, b), n in own.items():
            others = both[a, b] - n
            score += n * math.log(others / alone[a] if others else 0.4 * alone[b] / total)
        n, before = out.get(doc_id, (0, 0.0))
        out[doc_id] = n + len(x), before + score
    return out


@pytest.mark.parametrize("size,bucket", [(65_535, 2_000_000), (30, 50), (5, 10)])
def test_backoff_scores_equal_brute_force(spark, monkeypatch, size, bucket):
    monkeypatch.setattr(backoff_lm, "BUCKET", bucket)
    docs = [(i, prose(i % 25, 5 + i)) for i in range(60)] + [(100, None), (101, ""), (102, "the the the the"), (None, prose(1)), (3, "sea0 sea0")]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("word", F.lit("clash")).repartition(3)
    got = {r["doc_id"]: (r["n_words"], r["log_score"]) for r in backoff_lm.scores(df, size).collect()}
    joined = {r["doc_id"]: (r["n_words"], r["log_score"]) for r in backoff_relational.scores(df, size).collect()}
    assert joined == {d: (n, s if s is None else pytest.approx(s)) for d, (n, s) in got.items()}
    want = brute_scores(docs, size)
    assert got.keys() == want.keys()
    for doc_id, (n, score) in want.items():
        assert got[doc_id][0] == n
        if n:
            assert got[doc_id][1] == pytest.approx(score)
        else:
            assert got[doc_id][1] is None


def brute_orders(docs, order):
    """Scores by n-grams up to an order, straight from the definition."""
    words = [(d, (t or "").lower().split()) for d, t in docs]
    total = sum(len(x) for _, x in words)

    def grams(x, n):
        marked = ["<s>", *x]
        return Counter(tuple(marked[i - n + 1 : i + 1]) for i in range(max(1, n - 1), len(marked)))

    counts = {n: sum((grams(x, n) for _, x in words), Counter()) for n in (2, 3)}
    counts[1] = Counter((w,) for _, x in words for w in x)
    counts[1]["<s>",] = sum(bool(x) for _, x in words)
    out = {}
    for doc_id, x in words:
        if doc_id is None:
            continue
        own = {n: grams(x, n) for n in (2, 3)}
        marked, score = ["<s>", *x], 0.0
        for i in range(1, len(marked)):
            factor = 1.0
            for n in range(min(order, i + 1), 1, -1):
                gram = tuple(marked[i - n + 1 : i + 1])
                if others := counts[n][gram] - own[n][gram]:
                    score += math.log(factor * others / counts[n - 1][gram[:-1]])
                    break
                factor *= 0.4
            else:
                score += math.log(factor * counts[1][marked[i],] / total)
        n, before = out.get(doc_id, (0, 0.0))
        out[doc_id] = n + len(x), before + score
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("ids", [0, 8, 65_535])
def test_orders_equal_brute_force(spark, monkeypatch, order, ids):
    monkeypatch.setattr(backoff_lm, "VOCABULARY", ids)
    docs = [(i, prose(i % 25, 5 + i)) for i in range(50)] + [(100, None), (101, ""), (102, "the the the the"), (None, prose(1)), (3, "sea0 sea0"), (104, "alone"), (105, "two words")]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("n", F.lit("clash")).repartition(3)
    got = {r["doc_id"]: (r["n_words"], r["log_score"]) for r in backoff_relational.scores(df, order=order).collect()}
    want = brute_orders(docs, order)
    assert got.keys() == want.keys()
    for doc_id, (n, score) in want.items():
        assert got[doc_id] == (n, pytest.approx(score) if n else None), doc_id


def test_other_orders_are_refused(spark):
    with pytest.raises(ValueError):
        backoff_relational.scores(spark.createDataFrame([], SCHEMA), order=4)


def test_rare_words_have_counts_of_their_own(spark):
    # more words of one count than have ids: they must not become one unknown word
    docs = [(i, " ".join(f"w{j}" for j in range(i * 1000, i * 1000 + 1100))) for i in range(70)]
    docs += [(100, "the w5 w6 the w5 junk"), (101, "junk w3 the the w5"), (None, "w7 w8"), (100, "w7 w8 the")]
    got = {r["doc_id"]: (r["n_words"], r["log_score"]) for r in backoff_lm.scores(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {d: (n, pytest.approx(s)) for d, (n, s) in brute_scores(docs, 10**9).items()}


@pytest.mark.parametrize("ids", [0, 5, 30])
def test_words_without_id_change_nothing(spark, monkeypatch, ids):
    monkeypatch.setattr(backoff_lm, "VOCABULARY", ids)
    monkeypatch.setattr(backoff_lm, "BUCKET", 50)
    docs = [(i, prose(i, 30)) for i in range(40)]
    got = {r["doc_id"]: r["log_score"] for r in backoff_lm.scores(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert all(got[d] == pytest.approx(s) for d, (_, s) in brute_scores(docs, 10**9).items())


def test_few_frequent_bigrams_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(backoff_lm, "FREQUENT", 4)
    docs = [(i, prose(i, 30)) for i in range(40)]
    got = {r["doc_id"]: r["log_score"] for r in backoff_lm.scores(spark.createDataFrame(docs, SCHEMA)).collect()}
    joined = {r["doc_id"]: r["log_score"] for r in backoff_relational.scores(spark.createDataFrame(docs, SCHEMA)).collect()}
    want = brute_scores(docs, 65_535)
    assert all(got[d] == pytest.approx(s) and joined[d] == pytest.approx(s) for d, (_, s) in want.items())


@pytest.mark.parametrize("size", [None, 12])
def test_hot_bigrams_come_to_no_bucket(spark, monkeypatch, size):
    # with four frequent ids, bigrams of other words fill buckets unless they are counted ahead
    monkeypatch.setattr(backoff_lm, "FREQUENT", 4)
    monkeypatch.setattr(backoff_lm, "HOT", 20)
    docs = [(i, prose(i, 30) + (" low water" if i % 2 else "")) for i in range(60)]
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    dealt = []
    whole = backoff_lm._deal

    def deal(shared, buckets):
        dealt.append(shared.value)
        return whole(shared, buckets)

    monkeypatch.setattr(backoff_lm, "_deal", deal)
    got = {r["doc_id"]: r["log_score"] for r in backoff_lm.scores(df, size).collect()}
    want = brute_scores(docs, 10**9 if size is None else size)
    assert all(got[d] == pytest.approx(s) for d, (_, s) in want.items())
    (model,) = dealt
    pairs = Counter()
    for _, text in docs:
        first, second = model.frequent_bigrams([text])
        pairs.update(zip(first.tolist(), second.tolist(), strict=True))
    ahead = {p for p in pairs if model.ahead(np.array([p[0]]), np.array([p[1]]))[0] >= 0}
    assert len(model.hot) > 0 and all(n < 20 for p, n in pairs.items() if p not in ahead and min(p) >= 0)


def test_no_documents(spark):
    assert backoff_lm.scores(spark.createDataFrame([], SCHEMA)).count() == 0
    assert backoff_relational.scores(spark.createDataFrame([], SCHEMA)).count() == 0
    assert backoff_relational.scores(spark.createDataFrame([], SCHEMA), order=3).count() == 0
    (row,) = backoff_lm.scores(spark.createDataFrame([(1, None)], SCHEMA)).collect()
    assert (row["n_words"], row["log_score"]) == (0, None)


# --- classifiers -------------------------------------------------------------------


@pytest.fixture(scope="module")
def marked(spark):
    r, docs, labels = random.Random(2), [], []
    for i in range(400):
        good, toxic = r.random() < 0.7, r.random() < 0.25
        words = prose(i, 40).split()
        if not good:
            words = [w + "$$$" for w in words]
        if toxic:
            for _ in range(3):
                words.insert(r.randrange(len(words)), r.choice(["Rotten!", "vermin", "scoundrel."]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    odd = [(900, None), (901, ""), (902, " \n"), (None, "vermin vermin"), (5, docs[5][1]), (903, "vermin " * 9000)]
    extra = [(None, 1, 1), (7, None, None), (9999, 0, 1)]
    table = spark.createDataFrame(docs + odd, SCHEMA).withColumn("label", F.lit("clash")).withColumn("score", F.lit(5))
    return table, spark.createDataFrame(labels + extra, "doc_id long, quality int, toxic int"), dict(docs), labels


def test_labels_of_fold_0_are_never_read(spark, marked):
    _, labels, _, _ = marked
    ids = {r["doc_id"] for r in known_labels(labels, "toxic", 10_000).collect()}
    assert ids and not any(fold(i) == 0 for i in ids)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.fit(marked[0], labels), quality.fit(marked[0], flipped))


def test_samples_are_bounded(spark):
    labels = spark.range(0, 20_000).selectExpr("id as doc_id", "int(id % 2) as toxic")
    assert 700 < known_labels(labels, "toxic", 1000).count() < 1300


def accuracy(rows, labels, column):
    held = [r for r in rows if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert len(held) > 50
    return sum(r["predicted"] == labels[r["doc_id"]][column] for r in held) / len(held)


def test_quality(spark, marked):
    docs, labels, _, known = marked
    rows = quality.scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and fold(r["doc_id"]) == 0) for r in rows)
    assert accuracy(rows, {d: (q, t) for d, q, t in known}, 0) > 0.95
    assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1


def test_toxicity(spark, marked):
    docs, labels, texts, known = marked
    tagger = toxicity.fit(docs, labels)
    rows = toxicity.scores(docs, tagger).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert accuracy(rows, {d: (q, t) for d, q, t in known}, 1) > 0.95
    spans = {texts[r["doc_id"]][s["start"] : s["end"]].strip("!.$").lower() for r in rows if r["doc_id"] in texts for s in r["spans"]}
    assert {"rotten", "vermin", "scoundrel"} <= spans and len(spans) < 8
    assert all(r["predicted"] == 0 for r in rows if r["doc_id"] in (900, 901, 902))
    kept = toxicity.without_toxic(docs, tagger)
    assert kept.columns == docs.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(repr(r["doc_id"]) for r in rows if not r["predicted"])


def test_no_labels(spark, marked):
    docs, labels, _, _ = marked
    none = labels.limit(0)
    assert {r["score"] for r in quality.scores(docs, none).collect()} == {0.5}
    assert {r["score"] for r in toxicity.scores(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    assert toxicity.scores(docs.limit(0), toxicity.fit(docs, none)).count() == 0


def test_marginals_equal_enumeration():
    r = np.random.default_rng(3)
    for _ in range(20):
        lengths = r.integers(1, 6, 4)
        emission, moves = r.normal(size=lengths.sum()), r.normal(size=(2, 2))
        p, table = toxicity.marginals(emission, lengths, moves, pairs=True)
        want_p, want_table, at = [], np.zeros((2, 2)), 0
        for n in lengths:
            e, at = emission[at : at + n], at + n
            tags = list(product((0, 1), repeat=int(n)))
            w = np.array([math.exp(sum(e[i] * t[i] for i in range(n)) + sum(moves[t[i - 1], t[i]] for i in range(1, n))) for t in tags])
            w /= w.sum()
            want_p += [sum(x for x, t in zip(w, tags) if t[i]) for i in range(n)]
            for x, t in zip(w, tags):
                for i in range(1, n):
                    want_table[t[i - 1], t[i]] += x
        assert np.allclose(p, want_p) and np.allclose(table, want_table)


def test_long_lines_are_several_chains():
    text = "a " * 600 + "\n\n b"
    assert [len(c) for c in toxicity.chains(text)] == [256, 256, 88, 1]
    assert toxicity.chains(None) == []

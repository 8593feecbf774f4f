import math
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidegauge.llm import ranked_search
from tidegauge.llm.oracles import RANKED_SEARCH
from tidegauge.llm.terms import LETTERS, WORDS, pattern, splitter

DOCS = "doc_id long, text string, item_id long, term string"
QUERIES = "item_id long, text string, shard string"


def brute(docs, queries, top):
    found = re.compile(pattern(WORDS))
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    split = [(d, found.findall((t or "").translate(lower))) for d, t in docs]
    split = [(d, w) for d, w in split if w]
    n, total = len(split), sum(len(w) for _, w in split)
    asked = {}
    for item, text in queries:
        if item is not None:
            asked.setdefault(item, set()).update(found.findall((text or "").translate(lower)))
    rows = []
    for item, words in asked.items():
        df = {t: sum(t in w for _, w in split) for t in words}
        scored = []
        for doc, w in split:
            m = 50 + 50 * len(w) * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 20 * m))
                for t in words
                if t in w
            )
            if score > 0 and doc is not None:
                scored.append((doc, score))
        scored.sort(key=lambda x: (-x[1], x[0]))
        rows += [(item, i, d, s) for i, (d, s) in enumerate(scored[:top], 1)]
    return sorted(rows)


def made(seed, n, words=40, length=30):
    draw = np.random.default_rng(seed)
    vocabulary = [f"w{i}" if i % 3 else f"É{i}漢" for i in range(words)]
    share = 1 / np.arange(1, words + 1)
    return [
        (int(i), " ".join(draw.choice(vocabulary, draw.integers(0, length), p=share / share.sum()))) for i in draw.permutation(n)
    ]


HOSTILE = [(None, "w1 w2 w3"), (9001, None), (9002, ""), (9003, " ,;! "), (9004, "W1-w1_W1"), (9004, "W1-w1_W1"), (9005, "w1 " * 5000), (9006, "zz " * 400 + "w2")]


def frames(spark, docs, queries):
    return (
        spark.createDataFrame([(d, t, 1, "x") for d, t in docs], DOCS),
        spark.createDataFrame([(i, t, "x") for i, t in queries], QUERIES),
    )


def found(spark, docs, queries, top=50):
    documents, asked = frames(spark, docs, queries)
    rows = ranked_search.best_documents(ranked_search.Index(documents), asked, top)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("top", [1, 7, 50])
def test_ranking_equals_brute_force(spark, monkeypatch, top):
    # small shards and blocks, so that there are bounds to use
    monkeypatch.setattr(ranked_search, "SHARD", 40)
    docs = made(1, 400) + HOSTILE
    queries = [(i, t) for i, t in made(2, 30, length=9)] + [(500, None), (501, ""), (502, "absent"), (None, "w1"), (503, "w1"), (503, "w4 w1")]
    assert found(spark, docs, queries, top) == brute(docs, queries, top)


def test_ties_and_repeated_rows(spark):
    docs = [(i % 20, "same text") for i in range(60)] + [(100, "other")]
    assert found(spark, docs, [(1, "text")], 25) == brute(docs, [(1, "text")], 25)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "w1")]) == []
    assert found(spark, made(3, 20), []) == []
    assert found(spark, [(1, None)], [(1, "w1")]) == []


def test_queries_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "TOGETHER", 3)
    docs, queries = made(4, 100), made(5, 20, length=6)
    assert found(spark, docs, queries, 5) == brute(docs, queries, 5)


def test_numbers_are_packed_whole():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**31, 2**62], np.int64)
    data, at = ranked_search.pack(values)
    assert ranked_search.unpack(data.tobytes()).tolist() == values.tolist()
    assert at[-1] == len(data) and at[0] == 0


def test_blocks_are_refused_before_they_are_unpacked():
    """A common term's blocks stay packed where their maxima cannot reach the heap."""
    n = 4096
    m = np.full(n, 100, np.int64)
    times = np.ones(n, np.int64)
    times[300] = 50
    docs = np.arange(n)

    def listed(docs, times):
        impact = ranked_search.impacts(times, m[docs])
        begins = np.arange(0, len(docs), ranked_search.BLOCK)
        lasts = docs[np.minimum(begins + ranked_search.BLOCK, len(docs)) - 1]
        step = np.diff(docs, prepend=-1)
        packed = []
        for b in begins:
            part = slice(b, b + ranked_search.BLOCK)
            packed.append(ranked_search.pack(np.column_stack((step[part], times[part])).ravel())[0].tobytes())
        bests = np.maximum.reduceat(impact, begins)
        return ranked_search._List(int(impact.max()), lasts, bests, packed, len(docs))

    common, rare = listed(docs, times), listed(docs[::100], np.ones(41, np.int64))
    best = ranked_search.impacts(times, m)
    scores = 10 * best
    scores[::100] += 1000 * best[1]
    least = int(np.sort(scores)[-1])
    found, got = ranked_search.best_of_shard([(10, common), (1000, rare)], m, np.ones(n, bool), least)
    assert found.tolist() == [300] and got.tolist() == [scores[300]]
    assert common.open.sum() == 1 and common.open[300 // ranked_search.BLOCK]


def test_sql_equals_brute_force():
    docs = made(6, 60) + HOSTILE
    queries = made(7, 10, length=8) + [(None, "w1"), (500, None)]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("benchmark", pd.DataFrame(queries, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    rows = con.execute(RANKED_SEARCH).fetchall()
    assert sorted(rows) == brute(docs, queries, 50)


def test_terms_are_those_of_the_pattern():
    text = "Ab-Cd É12漢字x_y\x00z\x7fq 😀ok" + "".join(map(chr, range(0x250)))
    for separators in (WORDS, LETTERS):
        wanted = re.findall(pattern(separators), text.translate({c: c + 32 for c in range(65, 91)}))
        assert [t.decode() for t in splitter(separators)(text.encode())] == wanted

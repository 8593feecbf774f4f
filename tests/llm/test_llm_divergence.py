import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd

from tidegauge.llm import divergence
from tidegauge.llm.oracles import SOURCE_DIVERGENCE
from tidegauge.llm.terms import LETTERS, pattern

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long"


def brute(docs, least=10, top=10):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    split = [(lang or "", source or "", Counter(re.findall(pattern(LETTERS), (text or "").translate(lower)))) for text, lang, source in docs]
    rows = []
    for lang in {x[0] for x in split}:
        df, counts, whole = Counter(), {}, Counter()
        for of, source, words in split:
            if of == lang:
                df.update(words.keys())
                counts.setdefault(source, Counter()).update(words)
                whole.update(words)
        kept = [t for t, n in df.items() if n >= least]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(whole)
        apart = lambda a, b: (a - b) ** 2 // (a + b)
        for source, mine in p.items():
            parts = {
                "pair": [(sum(apart(mine[t], other[t]) for t in kept), s) for s, other in p.items() if s != source],
                "term": [(apart(mine[t], q[t]), t) for t in kept if counts[source][t] and mine[t] > q[t]],
            }
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                rows += [(lang, source, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= top]
    return sorted(rows)


def made(n=400, seed=3):
    draw = np.random.default_rng(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" if i % 4 else f"É{chr(0x4E00 + i)}" for i in range(60)]
    share = 1 / np.arange(1, 61)
    rows = []
    for i in range(n):
        source = f"s{min(int(draw.integers(0, 12)), 7)}"
        text = " ".join(draw.choice(words, draw.integers(0, 40), p=np.roll(share, len(source) + int(source[1:])) / share.sum()))
        rows.append((text, "en" if i % 3 else "de", source))
    rows += [(None, "en", "s0"), ("", "en", "termless"), ("12 34", "de", None), ("wa Wa WA", None, None), ("x", "xx", "a"), ("y", "xx", "b"), ("y", "yy", "alone")]
    rows += [("rareWord wab " * 3000, "en", "long")] + [("same", "fr", "s1")] * 12 + [("same", "fr", "s2")] * 12
    return rows


def found(spark, rows, **settings):
    docs = spark.createDataFrame([(i % 7, *r, "t", 1) for i, r in enumerate(rows)], SCHEMA)
    out = divergence.audit(docs, **settings)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in out.collect())


def test_audit_equals_brute_force(spark):
    assert found(spark, made()) == brute(made())


def test_many_blocks_and_tiles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 5)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "COUNTED", 50)
    assert found(spark, made()) == brute(made())
    assert found(spark, made(), min_docs=2, top_terms=3) == brute(made(), 2, 3)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_shares_are_exact_for_large_counts():
    n = np.array([0, 1, 7, 10**13, 9 * 10**14], np.int64)
    of = 10**15 + 7
    assert divergence.shares(n, of).tolist() == [1 + 10**9 * (int(x) + 2) // of for x in n]


def test_merge_prices_terms_of_both_one_and_neither():
    a = np.array([1, 4, 9]), np.array([50, 60, 70]), np.int64(5)
    b = np.array([4, 5]), np.array([10, 20]), np.int64(3)
    f = divergence.divergence
    wanted = f(60, 10) + f(50, 3) + f(70, 3) + f(5, 20) + 6 * f(5, 3)
    assert divergence._merge(a, b, 10) == divergence._merge(b, a, 10) == wanted
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.int64(3)
    assert divergence._merge(a, none, 3) == f(50, 3) + f(60, 3) + f(70, 3)


def test_sql_equals_brute_force():
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(made(), columns=["text", "lang", "source"]))
    assert sorted(con.execute(SOURCE_DIVERGENCE).fetchall()) == brute(made())


def test_copies_of_a_hot_source_do_not_meet_in_pairs(spark):
    plan = divergence.source_pairs(divergence.Counts(spark.createDataFrame([(1, "a", "en", "s", "t", 1)], SCHEMA)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text

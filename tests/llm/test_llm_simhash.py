import random

import numpy as np
import pytest
import xxhash

from tidegauge.llm import linking, simhash

SCHEMA = "doc_id long, text string"


def brute(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """Smallest id reachable over fingerprints at most four bits apart, or over a shared id."""
    prints = [brute(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if same_id or bin(prints[i] ^ prints[j]).count("1") <= 4:
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return {(d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))}


def prose(seed, n=60):
    r = random.Random(seed)
    return " ".join(r.choice(["sea", "tide", "Gauge", "über", "мир", "a", "of"]) + str(r.randrange(50)) for _ in range(n))


def got(df):
    return {tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b c", "a  B\tc\x0bd e", prose(1), prose(2, 1) * 3, "É é\xa0x y z w"])
def test_fingerprint_by_definition(text):
    assert simhash.fingerprint(text) % 2**64 == brute(text)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    text = prose(3, 500)
    monkeypatch.setattr(simhash, "SHINGLES", 7)
    assert simhash.fingerprint(text) % 2**64 == brute(text)


def test_segments_differ_by_one_bit_somewhere():
    parts = simhash.segments(4)
    assert len(parts) == 3 and sum(w for _, w in parts) == 64 and parts[0][0] == 0


def rows():
    made = [(i, prose(i % 40, 80)) for i in range(120)]
    made += [(200 + i, prose(i, 80) + f" tail{i}") for i in range(40)]
    made += [(300, None), (301, ""), (302, " "), (None, prose(1, 80)), (None, "alone here once"), (5, prose(5, 80)), (5, "other text of five")]
    return made


def test_classes_equal_brute_force(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).selectExpr("*", "1 as node", "'x' as component_id")
    assert got(simhash.classes(docs.select("doc_id", "text", "node"))) == brute_components(rows())


def test_split_keys_and_dense_groups_give_the_same(spark, monkeypatch):
    base = 0x0123456789ABCDEF
    r = random.Random(5)
    # chains and clouds of fingerprints around a few centres, most of them in one segment bucket
    nodes = {base ^ sum(1 << b for b in r.sample(range(40), r.randrange(6))) for _ in range(400)}
    nodes |= {r.getrandbits(64) for _ in range(50)}
    signed = [n - 2**64 if n >= 2**63 else n for n in nodes]
    df = spark.createDataFrame([(n,) for n in signed], "node long")

    def roots():
        space = simhash.Workspace(spark, "test")
        found = linking.components(simhash.links(df, 4, space), space)
        return {r["node"]: r["root"] for r in found.collect()}

    want, left = {}, sorted(signed)
    while left:
        root, front = left[0], [left.pop(0)]
        members = []
        while front:
            a = front.pop()
            members.append(a)
            near = [b for b in left if bin((a ^ b) % 2**64).count("1") <= 4]
            left = [b for b in left if b not in near]
            front += near
        if len(members) > 1:
            want |= dict.fromkeys(members, root)
    assert roots() == want
    monkeypatch.setattr(linking, "BLOCK", 32)
    assert roots() == want


def test_components_of_a_long_path(spark):
    edges = spark.range(0, 300).selectExpr("id as a", "id + 1 as b")
    found = linking.components(edges, simhash.Workspace(spark, "path"))
    assert {(r["node"], r["root"]) for r in found.collect()} == {(i, 0) for i in range(301)}


def test_one_per_class_keeps_columns_and_repeated_ids_once(spark):
    docs = spark.createDataFrame(rows(), SCHEMA).selectExpr("doc_id", "text", "'s' as source", "7 as fingerprint")
    kept = simhash.one_per_class(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    classes = brute_components(rows())
    assert sorted(i for i in ids if i is not None) == sorted({d for d, _, c in classes if d is not None and d == c})
    assert ids.count(None) == 2


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.classes(empty).count() == 0
    assert simhash.one_per_class(empty).count() == 0
    assert np.array_equal(linking._stars(np.array([1]), None)[0], [])

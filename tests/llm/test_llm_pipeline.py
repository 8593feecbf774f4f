from pathlib import Path

import pytest
from oracle_check import compare, connect

import corpus_pipeline
from tidegauge.llm import simhash
from tidegauge.llm.oracles import ORACLES
from tidegauge.llm.queries import QUERIES


def test_names():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES]
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None


def test_nothing_else_imports_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent / "tidegauge"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "tidegauge.llm" not in path.read_text()


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    root, docs, kept = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    kept.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        path = str(root / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs)
    return kept


def test_stages_take_effect(spark, sf_dir, stages):
    start, clean, lines, distinct, free, ids = stages
    assert all(s.columns == start.columns for s in stages[1:5])
    texts = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert set(texts) == {r["doc_id"] for r in clean.collect()} < {r["doc_id"] for r in start.collect()}
    # one of each class of near copies, by brute force over the stage's input
    prints = {d: simhash.fingerprint(t) for d, t in texts.items()}
    group = {d: d for d in texts}
    for d in sorted(texts):
        for e in sorted(texts):
            if e < d and bin((prints[d] ^ prints[e]) % 2**64).count("1") <= 4:
                a, b = sorted((group[d], group[e]))
                group = {k: a if v == b else v for k, v in group.items()}
    left = {r["doc_id"]: r["text"] for r in distinct.collect()}
    assert set(left) == {d for d in texts if group[d] == d} < set(texts)
    items = [r["text"].lower() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {d for d, t in left.items() if any(i in t.lower() for i in items)}
    remaining = {r["doc_id"] for r in free.collect()}
    assert leaks and not leaks & remaining and len(set(left) - remaining) == len(leaks)
    rows = ids.collect()
    assert {r["doc_id"] for r in rows} == remaining and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_lengths_follow_the_text(stages):
    for docs in stages[1:5]:
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())


def test_odd_rows_pass_all_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(None, None, None, None, None), (9001, "", None, "src0", 0), (9002, None, "en", None, None), (9002, None, "en", None, None),
           (None, "short text", "en", "src0", 10), (9003, "w" * 100_000, "en", "src1", 100_000)]
    both = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(n))
        stage(spark, both, sf_dir).write.parquet(path)
        both = spark.read.parquet(path)
    rows = both.collect()
    assert {9001, 9003} <= {r["doc_id"] for r in rows} and sum(r["doc_id"] is None for r in rows) == 2
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in stages[-1].collect())

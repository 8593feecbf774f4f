"""Hot keys, bounds and odd columns of the training-data operators."""

import random
from collections import Counter
from statistics import median

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import byte_bpe, line_dedup, linking, quality, simhash, tables, token_counts, toxicity
from tidegauge.llm.queries import RANKS


@pytest.fixture
def eager_splits(conf):
    # the thresholds shrink with the data; the mechanism is the same
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_of_a_long_text_are_dealt_to_several_tasks(spark, eager_splits):
    r = random.Random(1)
    other = ["".join(r.choice("abc dé") for _ in range(300)) for _ in range(300)]
    rows = [(i, "hot text, " * 30 if i % 3 else other[i % 300]) for i in range(6000)]
    # something that copies do not share, as long texts themselves lie too far apart to be compressed together
    load = F.concat(*(F.sha2(F.concat("doc_id", F.lit(f"-{i}")), 512) for i in range(8)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("load", load).repartition(8)
    vocabulary = byte_bpe.Vocabulary(spark, RANKS, public_tokenizers.PATTERN)
    found = byte_bpe.encode(docs, vocabulary, 100, 40)
    found = found.withColumn("task", F.spark_partition_id())
    assert "skew=true" in final_plan(found)
    sizes = Counter(r.task for r in found.collect())
    assert sum(sizes.values()) == 6000 and max(sizes.values()) <= 6000 // 4


def test_a_star_of_links_is_dealt_to_several_tasks(spark, eager_splits, tmp_path):
    n = 60_000
    star = spark.range(1, n).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    pairs = spark.range(n, 2 * n, 2).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    seen = []

    class Watched(tables.Workspace):
        def keep(self, df, name):
            kept = super().keep(df, name)
            if name.startswith("large"):
                seen.append(final_plan(df))
            return kept

    found = linking.components(star.unionByName(pairs), Watched(spark, "star"))
    roots = found.agg(F.sum((F.col("root") == 0).cast("int")), F.count("*")).first()
    assert tuple(roots) == (n, 2 * n)
    assert any("skew=true" in plan for plan in seen)


@pytest.mark.parametrize("fit", [quality.fit, toxicity.fit])
def test_an_id_that_repeats_is_learnt_from_once(spark, fit):
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "vermin vermin!") for i in range(200)], "doc_id long, text string")
    many = docs.unionByName(spark.range(0, 20_000).selectExpr("7L as doc_id", "concat('copy ', id) as text"))
    labels = spark.range(0, 200).selectExpr("id as doc_id", "int(id % 2) as quality", "int(1 - id % 2) as toxic")
    known = tables.known_labels(labels, "toxic", 10_000)
    rows = tables.training_rows(many, known)
    assert rows.count() == known.count()
    assert rows.filter("doc_id = 7").count() == 1
    assert fit(many, labels) is not None


def odd(spark):
    rows = [(1, "Header\na b c d", "s"), (1, "Header\na b c d", "s"), (2, None, None), (None, "", "s"), (3, "Header\nx " * 5, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("a.b", "counted", "counted_", "row", "host", "kept", "key", "back`tick"):
        docs = docs.withColumn(name, F.lit(name))
    return docs


def test_columns_with_odd_or_clashing_names_are_kept(spark):
    docs = odd(spark)
    vocabulary = byte_bpe.Vocabulary(spark, RANKS, public_tokenizers.PATTERN)
    found = {
        "counts": (token_counts.with_token_counts(docs, [b"a", b" a"]), ["n_words", "n_tokens"]),
        "lines": (line_dedup.drop_boilerplate(docs), ["lines_dropped"]),
        "classes": (simhash.one_per_class(docs), []),
        "ids": (byte_bpe.encode(docs, vocabulary, 4, 2), ["ids"]),
    }
    for name, (df, added) in found.items():
        assert sorted(df.columns) == sorted([*docs.columns, *added]), name
        rows = df.collect()
        assert {r["a.b"] for r in rows} == {"a.b"} and {r["counted"] for r in rows} == {"counted"}, name
        assert all(r["back`tick"] == "back`tick" for r in rows), name


def test_scratch_tables_can_be_removed(spark, tmp_path):
    space = tables.Workspace(spark, "removed")
    kept = space.keep(spark.range(3), "numbers")
    assert kept.count() == 3
    space.close()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(space.path + "/numbers")

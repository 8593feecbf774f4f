import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidegauge.llm import byte_bpe, token_counts
from tidegauge.llm.queries import RANKS

SCHEMA = "doc_id long, text string"
ODD = [None, "", " ", "a", "don't we'll 'tis", "x" * 3000, " " * 3000, "\n\n\n a\n \n", "12345 ½ ² ٣٤", "日本語テキスト。" * 300,
       "naïve café — «ok» 50€", "​   z", "🙂👍🏽 " * 200, "\x1c\x1d a", "<|endoftext|> <|x|>", "é ́x", "ªº·×÷µ¿¡"]


@pytest.fixture(scope="module")
def vocabulary(spark):
    return byte_bpe.Vocabulary(spark, RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )


def mixed(seed, n):
    r = random.Random(seed)
    return "".join(r.choice(["word", " ", "  ", "\n", "'s", "'re", "12", "é", "!!", " the", "日本", "\t", "x" * 40]) for _ in range(n))


def test_usual_pattern_is_the_public_one():
    assert byte_bpe.USUAL == public_tokenizers.PATTERN


def texts():
    return [*ODD, *(mixed(i, 400) for i in range(30))]


@pytest.mark.parametrize("size,overlap", [(32_768, 512), (64, 16), (50, 50), (7, 3)])
def test_ids_equal_the_reference_at_any_chunk_size(spark, vocabulary, reference, size, overlap):
    rows = list(enumerate(texts())) + [(None, "no id"), (3, "a"), (3, "a")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("clash")).withColumn("ids", F.lit("clash"))
    found = byte_bpe.encode(docs, vocabulary, size, overlap).withColumn("bytes", byte_bpe.decode(F.col("ids"), vocabulary))
    got = sorted((repr(r["doc_id"]), list(r["ids"]), bytes(r["bytes"])) for r in found.collect())
    assert got == sorted((repr(i), reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)


def test_chunks_are_stitched_not_only_encoded_whole(spark, vocabulary):
    long = spark.createDataFrame([("k", "some words, 12 of them\n\nagain: " * 40), ("run", "x" * 500)], "key string, text string")
    found = {r["key"] for r in byte_bpe._long_texts(long, vocabulary, 64, 32).collect()}
    assert found == {"k"}


def test_null_ids_decode_to_null(spark, vocabulary):
    df = spark.createDataFrame([(None,), ([],), ([262],)], "ids array<int>")
    values = [r[0] for r in df.select(byte_bpe.decode(F.col("ids"), vocabulary)).collect()]
    assert values == [None, b"", b" the"]


def test_empty_table(spark, vocabulary):
    empty = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.encode(empty, vocabulary).count() == 0
    assert token_counts.with_token_counts(empty, [b"a"]).count() == 0


def greedy(word, pieces):
    n = 0
    while word:
        k = next((k for k in range(len(word), 0, -1) if word[:k] in pieces), None)
        if k is None:
            return 1
        word, n = word[k:], n + 1
    return n


def test_automaton_counts_what_longest_match_cuts():
    r = random.Random(3)
    for _ in range(200):
        pieces = {bytes(r.choice(b"abc ") for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(1, 12))}
        automaton = token_counts.Automaton(pieces)
        for _ in range(30):
            word = bytes(r.choice(b"abcd") for _ in range(r.randrange(0, 12)))
            assert automaton.count(word) == greedy(b" " + word, pieces), (pieces, word)


def test_counts_of_documents(spark):
    pieces = sorted(byte_bpe.read_ranks(RANKS))
    rows = list(enumerate(texts())) + [(None, "no id"), (3, "a"), (3, "a")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_tokens", F.lit("clash"))
    got = sorted((repr(r["doc_id"]), r["n_words"], r["n_tokens"]) for r in token_counts.with_token_counts(docs, pieces).collect())
    vocabulary = set(pieces)
    assert got == sorted(
        (repr(i), len((t or "").split()), sum(greedy(b" " + w.encode(), vocabulary) for w in (t or "").split())) for i, t in rows
    )

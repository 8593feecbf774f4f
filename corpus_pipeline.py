"""Documents to token ids: toxicity, line dedup, near-dedup, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns
of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import byte_bpe, decontamination, line_dedup, simhash, toxicity
from tidegauge.llm.tables import Workspace, read

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the tagger learns from the labels of ``sf_dir``."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the boilerplate lines of their source."""
    return (
        line_dedup.drop_boilerplate(docs)
        .withColumn("n_chars", F.when(F.col("lines_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars")))
        .select(docs.columns)
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id."""
    return simhash.one_per_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the token ids, their number, and whether they decode to the text."""
    vocabulary = byte_bpe.Vocabulary(spark, RANKS, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(F.col("ids"), vocabulary)
    return byte_bpe.encode(docs, vocabulary).select(
        "doc_id",
        "source",
        "lang",
        "ids",
        F.size("ids").alias("n_tokens"),
        (decoded == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

#: Stages learn, hash and match approximately, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    space = Workspace(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = space.keep(stage(spark, docs, sf_dir), f"stage-{n}")
    return docs

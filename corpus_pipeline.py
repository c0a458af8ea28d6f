"""Corpus pipeline over documents: toxicity, exact and near de-duplication,
mixing and encoding. Each stage is a function of (spark, docs, sf_dir); all but
the last return the columns of documents for the rows they keep.

Shingles of five words and similarity 0.8 decide near copies. A model's fit
sees the labelled rows of the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from shelfwise.llm.common import staged, table
from shelfwise.llm.queries import vocabulary_path

TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below TOXIC."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("toxicity") < TOXIC).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The owner of each distinct text."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return near_dedup.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their targets."""
    return mixing.mix(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with token_ids (little-endian unsigned 32-bit) and n_tokens."""
    return bpe.encode(docs, vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe encoding", encode_texts),
]
#: Training, sketches and byte-pair merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents; each stage's result is written to the
    shared folder and read back, so that no stage is computed twice."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

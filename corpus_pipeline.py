"""A training corpus from raw documents.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
all their columns; the last returns the token ids. ``run`` writes every stage's
result to the shared folder and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logsift.llm.common import read_table
from logsift.llm.decontaminate import drop_contaminated
from logsift.llm.jaccard_join import keep_one_of_each
from logsift.llm.quality import keep_good
from logsift.llm.queries import PIECES
from logsift.llm.sentencepiece_codec import encode_docs
from logsift.session import persist


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the SentencePiece ids of each document."""
    return encode_docs(docs, PIECES)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("encoding", encoding)]

# The classifier and the tokenizer cannot be expressed in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = persist(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""From raw documents to token ids: quality, exact copies, near copies, mixture, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronlens.llm import bpe, exact_dedup, mixing, quality, set_join
from patronlens.llm.common import table
from patronlens.llm.queries import tokenizer
from patronlens.sources.staging import stage

# Every document is drawn once; a further quarter of the tokens is drawn so as to move the mixture to its weights.
MIX_PERCENT = 125
MIX_EPOCHS = 1


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return set_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mixture, once per epoch they are drawn in."""
    return mixing.mix(docs, percent=MIX_PERCENT, min_epochs=MIX_EPOCHS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's text, their number, and the digests of the ids and of the text decoded from them."""
    return bpe.digests(docs, tokenizer())


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixture", mixed),
    ("bpe", encoded),
]

# The classifier and the merges are beyond SQL; the tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what one returns is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

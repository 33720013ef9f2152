"""The corpus pipeline: five stages over documents, each with the columns of documents but the last.

quality: documents that the classifier rejects go. near_copies: of each class of near copies the least doc_id stays.
benchmark: contaminated documents go. secrets: found secrets are replaced by a mark in the text. packing: what is left is
packed in sequences.

In every stage: null texts are empty ones; repeated rows share a fate, but of near copies one row stays; an empty table gives
an empty one; columns besides those of documents are kept whatever their names, up to packing, whose result has its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bitextile.llm import decontam, ngram_join, packing, quality, secrets
from bitextile.llm.common import materialize
from bitextile.llm.queries import table, tokenizer
from bitextile.session import ship


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.7 or more; empty texts are scored too, ties go by that bound."""
    ship(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, one with the least doc_id; texts without words and null doc_ids all stay."""
    ship(spark)
    return ngram_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in 20 lies in a benchmark window; texts without words stay."""
    ship(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mark; null texts stay null."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents; a text without ids is its end id alone."""
    ship(spark)
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("quality", good_quality), ("near_copies", one_of_each), ("benchmark", decontaminated), ("secrets", without_secrets), ("packing", packed)]
#: A trained classifier, a similarity join and a tokenizer are not within SQL; see the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to a token dataset, in stages that each run one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from memberfold.llm import decontaminate, language_id, mixture, ngram_join, token_file
from memberfold.llm.common import table
from memberfold.llm.queries import tokenizer_path
from memberfold.session import shared_folder


# For every stage: a null or empty text counts as a text without words, whatever its length a
# text is handled whole, repeated rows are rows of their own, an empty table stays empty, and
# further columns go along untouched, whatever their names.


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; others go, and those without letters."""
    return language_id.accepted_documents(docs, table(spark, sf_dir, "pages"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each group of near duplicates.

    Texts without words are in no group; rows without a doc_id stay.
    """
    return ngram_join.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; rows without a doc_id stay."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as it takes them, none of them without words.

    A null source is a source of its own.
    """
    return mixture.mixed_documents(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token dataset, read back: a row a document, with the checksum of its ids."""
    folder = token_file.tokenized_dataset(docs, tokenizer_path("byte_bpe_50k.json"))
    return token_file.read_checksums(spark, folder)


STAGES = [
    ("language", identified),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("mixture", mixed),
    ("tokens", tokenized),
]

# Trained likelihoods and hashed rounding are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

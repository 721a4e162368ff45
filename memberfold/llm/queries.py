"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from memberfold.llm import conversation_repair, decontaminate, fill_middle, fingerprints, language_id
from memberfold.llm import mixture, ngram_join, oracles, quality_crf, substring_dedup, token_counts
from memberfold.llm import token_file, top_products, url_reputation
from memberfold.llm.common import table

ALLOW = ("example.net/en/", "org/fr/")
BLOCK = ("net/", "example.com/de/")
# Fill in the middle: seed of the cuts, percent of plain texts and of suffix-first ones among the others.
SEED, PLAIN_PERCENT, SPM_PERCENT = 1, 10, 20
# Search: results of a query, and the divisor of the ids that are queries.
TOP, EVERY = 5, 50


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return mixture.mixture(documents).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    folder = token_file.tokenized_dataset(documents, tokenizer_path("byte_bpe_50k.json"))
    return token_file.read_checksums(spark, folder)


def op3_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The model is of BPE: its pieces are used, its ranks are not.
    names = [piece for piece, _ in token_counts.vocabulary(tokenizer_path("piece_bpe_32k.model"))]
    pieces = token_counts.saved(spark, token_counts.estimated(documents, names))
    return token_counts.count_tokens(documents, pieces).select("doc_id", "n_tokens")


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (F.col("quality") == 1).alias("good"))
    judged = url_reputation.judge_urls(pages, outcomes, BLOCK, ALLOW)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    model = quality_crf.train(documents, labels)
    return quality_crf.score(documents, model).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted"
    )


def op7_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return substring_dedup.without_repeats(documents, digest=True).withColumnRenamed("kept", "kept_sha256")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(documents, table(spark, sf_dir, "pages")).select(
        "doc_id", "language", "posterior", "accepted"
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversation_repair.damaged(conversations))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return fill_middle.fill_in_middle(documents, SEED, PLAIN_PERCENT, SPM_PERCENT, digest=True)


def op13_largest_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products.largest_products(table(spark, sf_dir, "embeddings"), TOP, EVERY, "embedding")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_source_mixture,
        op2_token_file,
        op3_phrase_fingerprints,
        op4_token_counts,
        op5_url_reputation,
        op6_quality_crf,
        op7_benchmark_containment,
        op8_repeated_passages,
        op9_ngram_join,
        op10_language_id,
        op11_conversation_repair,
        op12_fill_in_middle,
        op13_largest_products,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        op5_url_reputation.__name__: oracles.url_reputation(BLOCK, ALLOW),
        op7_benchmark_containment.__name__: oracles.BENCHMARK_CONTAINMENT,
        op8_repeated_passages.__name__: oracles.REPEATED_PASSAGES,
        op9_ngram_join.__name__: oracles.NGRAM_JOIN,
        op11_conversation_repair.__name__: oracles.CONVERSATION_REPAIR,
        op12_fill_in_middle.__name__: oracles.fill_in_middle(SEED, PLAIN_PERCENT, SPM_PERCENT),
        op13_largest_products.__name__: oracles.largest_products(TOP, EVERY, "embedding"),
    }

"""From documents to token files: STAGES in order, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortica.llm.decontaminate import decontaminated
from cohortica.llm.files import new_folder
from cohortica.llm.mixing import mixed_documents
from cohortica.llm.near_duplicates import one_of_each
from cohortica.llm.quality_rules import keep_good
from cohortica.llm.token_files import token_table

# The mix: domains of the labelled table after the quality rules, and their shares of the tokens.
MIX_DOMAINS = {"toxic": "toxic = 1", "clean": "toxic = 0"}
MIX_TARGETS = {"toxic": 0.005, "clean": 0.995}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the policy."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at their rates: left out, once, or repeated.

    The rules have removed the poor ones, so two domains are left; toxic text is lowered to its share
    and never raised to it.
    """
    return mixed_documents(
        docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), domains=MIX_DOMAINS, targets=MIX_TARGETS,
        anchor="clean", limited=["toxic"], nearest=True,
    )


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' account of every document."""
    return token_table(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]
# MinHash, BM25 search, the fitted mix and the tokenizer have no counterpart in SQL; the stages are
# tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

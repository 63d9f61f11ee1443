"""From raw documents to token ids: five stages, each a written table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textpack.llm import bpe, decontam, secrets, simhash, toxicity
from textpack.llm.queries import TOKENIZER, table
from textpack.session import scratch_path
from pyspark.sql import functions as F

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold. The model is learned from the given documents and labels."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates by SimHash, the document of the smallest id."""
    return simhash.keep_one(docs)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def clean_of_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind and ``n_chars`` counted anew where the text changed."""
    redacted = secrets.redact(docs, secrets.learn(docs))
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document."""
    return bpe.digests(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean_of_toxicity), ("near_duplicates", one_of_each_group), ("decontamination", clean_of_benchmarks),
    ("secrets", clean_of_secrets), ("bpe", token_ids)]

#: Learned scores and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

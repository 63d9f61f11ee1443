"""Counts and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textpack.constants import CONTEXT_LENGTH


def reason_counts() -> list[Column]:
    reason = F.col("drop_reason")
    return [
        F.count_if(reason == "kept").alias("kept"),
        F.count_if(reason != "kept").alias("skipped"),
        F.count_if(reason == "empty").alias("empty"),
        F.count_if(reason == "non_english").alias("non_english"),
        F.count_if(reason == "too_long").alias("too_long")]


def filter_report(labelled: DataFrame) -> DataFrame:
    """One row: kept, skipped, empty, non_english, too_long."""
    return labelled.agg(*reason_counts())


def observed(labelled: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, counted as they pass: the report and the kept rows' token sum come from the job that
    writes them, without another pass. On a stream each micro-batch's progress has the counts under ``name``."""
    tokens = F.coalesce(F.sum(F.when(F.col("drop_reason") == "kept", F.col("n_tokens"))), F.lit(0)).cast("long")
    metrics = [*reason_counts(), tokens.alias("tokens")]
    if labelled.isStreaming:
        return labelled.observe(name, *metrics), None
    counts = Observation(name)
    return labelled.observe(counts, *metrics), counts


def report_of(counts: dict[str, int]) -> dict[str, int | float]:
    """Counts as observed, with the mean tokens of what was kept, 0 when nothing was."""
    return counts | {"avg_tokens": counts["tokens"] / counts["kept"] if counts["kept"] else 0.0}


def avg_tokens(kept: DataFrame) -> DataFrame:
    """Mean token count, 0 when nothing was kept."""
    return kept.agg(F.coalesce(F.avg("n_tokens"), F.lit(0.0)).alias("avg_tokens"))


def split_totals(rows: DataFrame) -> DataFrame:
    """Conversations and tokens per split, and over both as ``total``."""
    return rows.rollup("split").agg(
        F.count(F.lit(1)).alias("conversations"), F.sum("n_tokens").alias("tokens")
    ).withColumn("split", F.coalesce("split", F.lit("total")))


def n_sequences(rows: DataFrame, batch_size: int, accum: int = 1, epochs: int = 1,
                context_length: int = CONTEXT_LENGTH) -> DataFrame:
    """Sequences, batches and optimizer steps per split. Input (split, n_tokens)."""
    totals = rows.groupBy("split").agg(F.sum("n_tokens").alias("tokens"))
    sequences = F.greatest(F.lit(0), F.floor((F.col("tokens") - 1) / F.lit(context_length)))
    counted = totals.withColumn("sequences", sequences).withColumn(
        "batches", F.floor(F.col("sequences") / F.lit(batch_size)))
    per_epoch = F.greatest(F.lit(1), F.floor(F.col("batches") / F.lit(max(1, accum))))
    steps = F.when(F.col("batches") == 0, 0).otherwise(per_epoch * epochs)
    return counted.withColumn("steps", steps.cast("long"))


def corpus_count(rows: DataFrame, what: str = "rows") -> DataFrame:
    """One row (n); an empty table is an error."""
    n = F.count(F.lit(1))
    return rows.agg(F.when(n > 0, n).otherwise(
        F.raise_error(F.lit(f"no usable {what} found")).cast("long")).alias("n"))


def dataset_manifest(artifacts: dict[str, DataFrame], vocab_size: int | None = None) -> DataFrame:
    """(artifact, metric, value): row count of each artifact and token count where it has one."""
    parts = []
    for name, df in artifacts.items():
        has_tokens = "n_tokens" in df.columns
        counted = df.agg(F.count(F.lit(1)).alias("rows"), *(
            [F.coalesce(F.sum("n_tokens"), F.lit(0)).cast("long").alias("tokens")]
            if has_tokens else []))
        metrics = ["rows", "tokens"] if has_tokens else ["rows"]
        cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("value"))
                 for m in metrics]
        parts.append(counted.select(F.lit(name).alias("artifact"),
                                    F.explode(F.array(*cells)).alias("c")).select("artifact", "c.*"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    if vocab_size is not None:
        spark = whole.sparkSession
        whole = whole.unionByName(spark.createDataFrame(
            [("vocabulary", "tokens", vocab_size)], "artifact string, metric string, value long"))
    return whole

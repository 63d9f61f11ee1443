"""Next-token statistics over packed blocks, and embedding tables.

These keep the table questions a language model answers: which token follows which, how the next
token is drawn, and how well held-out text is predicted. Counting stands in for a network.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textpack.constants import INIT_STD, SEED
from textpack.operators.ordering import hash_key


def bigram_counts(sequences: DataFrame) -> DataFrame:
    """How often y follows x in the (x, y) sequences; at most vocabulary squared rows."""
    pairs = sequences.select(F.explode(F.arrays_zip("x", "y")).alias("p"))
    return pairs.select("p.x", "p.y").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))


def argmax(counts: DataFrame) -> DataFrame:
    """Most frequent successor of each token; the smallest id wins a tie."""
    return counts.groupBy("x").agg(F.max_by("y", F.struct("n", -F.col("y"))).alias("y"))


def topk_ties(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent successors of each token, keeping all that tie with the k-th.

    A context has at most one row per vocabulary entry, so the ranked group is bounded.
    """
    if k < 1:
        return counts
    window = Window.partitionBy("x").orderBy(F.desc("n"))
    return counts.withColumn("_rank", F.rank().over(window)).where(
        F.col("_rank") <= k).drop("_rank")


def next_token_dist(counts: DataFrame, temperature: float = 0.8, top_k: int = 50,
                    vocab_size: int | None = None) -> DataFrame:
    """Distribution of the next token per context, as (x, y, p).

    The logit is the log count. A temperature of 0 or less is greedy. ``top_k`` of 0, or not below
    the vocabulary size, keeps every candidate.
    """
    if temperature <= 0:
        return argmax(counts).select("x", "y", F.lit(1.0).alias("p"))
    unlimited = not top_k or (vocab_size is not None and top_k >= vocab_size)
    kept = counts if unlimited else topk_ties(counts, top_k)
    logit = F.ln(F.col("n")) / F.lit(float(temperature))
    group = Window.partitionBy("x")
    scaled = kept.withColumn("_logit", logit).withColumn(
        "_e", F.exp(F.col("_logit") - F.max("_logit").over(group)))
    return scaled.select("x", "y", (F.col("_e") / F.sum("_e").over(group)).alias("p"))


def heldout_loss(train_counts: DataFrame, val_sequences: DataFrame, vocab_size: int) -> DataFrame:
    """Mean cross-entropy of held-out sequences under add-one smoothed counts; NaN if none.

    Both sides are reduced to at most vocabulary squared rows before they meet.
    """
    val = bigram_counts(val_sequences).withColumnRenamed("n", "n_val")
    context = train_counts.groupBy("x").agg(F.sum("n").alias("n_x"))
    joined = val.join(train_counts, ["x", "y"], "left").join(context, "x", "left")
    p = (F.coalesce("n", F.lit(0)) + 1) / (F.coalesce("n_x", F.lit(0)) + vocab_size)
    return joined.agg(
        F.coalesce(F.sum(F.col("n_val") * -F.ln(p)) / F.sum("n_val"), F.lit(math.nan))
        .alias("loss"),
        F.coalesce(F.sum("n_val"), F.lit(0)).alias("n_tokens"))


def check_embeddings(embeddings: DataFrame, vocab: DataFrame) -> DataFrame:
    """One row (vocab_size, n_rows, dim); fails unless the table has one row of one length for every id of the vocabulary."""
    ids = vocab.agg(F.max("id") + 1).scalar()
    found = embeddings.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"), F.min("id").alias("low"),
                           F.max("id").alias("high"), F.min(F.size("embedding")).alias("dim"),
                           F.max(F.size("embedding")).alias("longest")).withColumn("vocab_size", ids.cast("long"))
    fits = (F.col("n_rows") == F.col("vocab_size")) & (F.col("n_ids") == F.col("n_rows")) & (F.col("low") == 0) & (
        F.col("high") == F.col("n_rows") - 1) & (F.col("dim") == F.col("longest"))
    size = F.when(fits, F.col("vocab_size")).otherwise(F.raise_error(F.concat(
        F.lit("the vocabulary has "), F.col("vocab_size").cast("string"), F.lit(" ids, the embedding table "),
        F.col("n_rows").cast("string"), F.lit(" rows"))).cast("long"))
    return found.select(size.alias("vocab_size"), "n_rows", F.col("dim").cast("long").alias("dim"))


def resize_embeddings(embeddings: DataFrame, new_size: int, dim: int, seed: int | str = SEED,
                      std: float = INIT_STD) -> DataFrame:
    """(id, embedding) for ids 0..new_size-1: old rows are kept, new rows drawn from N(0, std).

    The draw hashes (seed, id, position), so a recomputed row is the same row.
    """
    spark = embeddings.sparkSession

    def uniform(tag: str, position):
        digits = F.substring(hash_key(f"{seed}:{tag}", F.col("id"), position), 1, 8)
        return (F.conv(digits, 16, 10).cast("double") + 1.0) / F.lit(float(2**32 + 1))

    def normal(position):
        radius = F.sqrt(F.lit(-2.0) * F.ln(uniform("r", position)))
        return F.lit(std) * radius * F.cos(F.lit(2.0 * math.pi) * uniform("a", position))

    drawn = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda j: normal(j).cast("float"))
    ids = spark.range(new_size)
    return ids.join(embeddings.select("id", "embedding"), "id", "left").select(
        "id", F.coalesce("embedding", drawn).alias("embedding"))

"""The tables a data folder holds, in the shapes the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textpack.constants import EOS_TOKEN
from textpack.operators.blocks import pair_turns

# Lines of one turn in the line stream made from a conversation.
LINES_PER_TURN = 1 << 32


#: Session setting with the partitions to deal documents to, for a file of fewer splits than cores.
SPLITS = "textpack.input.splits"


def documents(spark: SparkSession, folder: str, splits: int | None = None) -> DataFrame:
    """Documents as the scan splits them, or dealt to ``splits`` partitions if that is set, here or
    in the session."""
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    splits = splits or int(spark.conf.get(SPLITS, "0"))
    return rows.repartition(splits, "doc_id") if splits else rows


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), "embedding")


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return pair_turns(conversations(spark, folder))


def instruction_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations written as an instruction/story line stream (src, line_no, line).

    A user turn is one summary line. A reply is a story header, its lines and the closing line.
    ``line_no`` is the turn and the place inside it, so no ordering pass is needed.
    """
    turns = conversations(spark, folder).where(F.col("role").isin("user", "assistant"))
    reply = F.concat(F.array(F.lit("Story:")), F.split("text", "\n"), F.array(F.lit(EOS_TOKEN)))
    request = F.array(F.concat(F.lit("Summary: "), F.col("text")))
    written = F.when(F.col("role") == "user", request).otherwise(reply)
    return turns.select(
        F.col("conv_id").alias("src"), "turn", F.posexplode(written).alias("pos", "line")
    ).select("src", (F.col("turn") * F.lit(LINES_PER_TURN) + F.col("pos")).alias("line_no"), "line")

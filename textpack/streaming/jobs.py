"""The batch operators on streams.

Formatting is stateless and runs as it is. Parsing and chat context keep state between micro-batches:
what is still open per source or conversation. That state is kept by key in Spark's state store (``keyed``), so a
micro-batch touches the state of its own keys only.

All new rows of a key are one group there. A key that holds a large share of all rows (``hot_keys``) belongs on the
chunked jobs: each micro-batch runs the batch operator over the carried rows and the new ones, and the rows of such a key are
spread over many tasks just as in batch. The carried rows are written tables, dealt to a fixed number of buckets by a hash of the key. A
micro-batch reads and writes only the buckets that its own keys fall in, so its cost follows its own size
and not the number of keys ever seen. A small index says which batch wrote each bucket last. A
micro-batch that is run again after a failure reads the index of the batch before it and overwrites its
own index, carry and output, so every batch takes effect once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textpack.constants import CONTEXT_LENGTH, MAX_CHAT_TOKENS
from textpack.operators.blocks import assemble_blocks, classify_lines, open_lines
from textpack.operators.clean import Counter, format_pairs, piece_counter
from textpack.operators.context import context_of, place_turns, retained_turns
from textpack.operators.ordering import CHUNK_WIDTH
from textpack.operators.vocabulary import Vocabulary
from textpack.streaming import keyed

Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]

# Buckets of the carried rows, and so the rows of the index; rows from which on a key is hot.
CARRY_BUCKETS = 256
HOT_ROWS = 1_000_000
# Process what is there and stop; pass ``{"processingTime": "1 minute"}`` and the like to go on.
ONCE = {"availableNow": True}


def read_table_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1
                      ) -> DataFrame:
    """A growing folder of Parquet files as a stream, oldest files first."""
    return spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", files_per_batch).parquet(path)


def stream_format(pairs: DataFrame, out: str, checkpoint: str,
                  counter: Counter = piece_counter,
                  max_tokens: int = MAX_CHAT_TOKENS, trigger: dict = ONCE) -> StreamingQuery:
    """Format a stream of pairs into Parquet files."""
    kept = format_pairs(pairs, counter, max_tokens)
    return kept.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint).trigger(**trigger).start()


def check_order(carried: DataFrame, new: DataFrame, key: str, order: str) -> None:
    """Rows of a key must arrive in order; a row behind the carried ones is an error."""
    seen = carried.groupBy(key).agg(F.max(order).alias("_seen"))
    late = new.join(seen, key).where(F.col(order) <= F.col("_seen"))
    if not late.isEmpty():
        raise ValueError(f"rows of a {key} arrived out of {order} order")


def run_with_carry(stream: DataFrame, key: str, step: Step, out: str, checkpoint: str,
                   trigger: dict = ONCE) -> StreamingQuery:
    """Run ``step(carried, new) -> (output, carried)`` on every micro-batch.

    ``carried`` has the rows kept for the keys of the buckets that new rows fall in.
    """
    schema = stream.schema
    bucket = F.pmod(F.xxhash64(key), F.lit(CARRY_BUCKETS)).cast("int")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            index = {}
            if batch_id:
                written = spark.read.schema("bucket int, batch long").parquet(f"{checkpoint}/index/batch={batch_id - 1}")
                index = dict(map(tuple, written.collect()))
            touched = [r[0] for r in batch.select(bucket).distinct().collect()]
            paths = [f"{checkpoint}/carry/batch={index[b]}/bucket={b}" for b in touched if b in index]
            carried = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
            output, kept = step(carried, batch)
            output.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            place = f"{checkpoint}/carry/batch={batch_id}"
            kept.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(place)
            left = [r[0] for r in spark.read.schema(f"{key} string, bucket int").parquet(place).select("bucket").distinct().collect()]
            index = {b: n for b, n in index.items() if b not in touched} | dict.fromkeys(left, batch_id)
            spark.createDataFrame(list(index.items()), "bucket int, batch long").coalesce(1).write.mode(
                "overwrite").parquet(f"{checkpoint}/index/batch={batch_id}")
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(run).option(
        "checkpointLocation", f"{checkpoint}/query").trigger(**trigger).start()


def hot_keys(rows: DataFrame, key: str, least: int = HOT_ROWS) -> list:
    """Keys of at least ``least`` rows, to be sent to the chunked jobs; at most one for each ``least`` rows there are."""
    return [r[0] for r in rows.groupBy(key).count().where(F.col("count") >= least).select(key).collect()]


def write_batches(stream: DataFrame, out: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Each micro-batch as a folder of its own, which a repeated run of the same micro-batch overwrites."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/query").trigger(**trigger).start()


def stream_parse_blocks(lines: DataFrame, out: str, checkpoint: str, idle_ms: int | None = None,
                        trigger: dict = ONCE) -> StreamingQuery:
    """Parse a stream of lines (src, line_no, line); the state of a source is its open block."""
    return write_batches(keyed.parsed(lines, idle_ms), out, checkpoint, trigger)


def stream_chat_context(turns: DataFrame, vocabulary: Vocabulary, out: str, checkpoint: str,
                        context_length: int = CONTEXT_LENGTH, idle_ms: int | None = None,
                        trigger: dict = ONCE) -> StreamingQuery:
    """Context of every user turn in a stream (conv_id, turn, role, text); the state of a conversation is the pairs
    that may still fit, at most C tokens, and a request that waits for its reply."""
    return write_batches(keyed.contexts(turns, vocabulary, context_length, idle_ms), out, checkpoint, trigger)


def stream_parse_blocks_chunked(lines: DataFrame, out: str, checkpoint: str,
                                width: int = CHUNK_WIDTH, trigger: dict = ONCE) -> StreamingQuery:
    """Parse a stream of lines (src, line_no, line); the carried state is the open block."""

    def step(carried: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
        check_order(carried, new, "src", "line_no")
        classified = classify_lines(carried.unionByName(new), width)
        return assemble_blocks(classified), open_lines(classified)

    return run_with_carry(lines.select("src", "line_no", "line"), "src", step, out, checkpoint, trigger)


def stream_chat_context_chunked(turns: DataFrame, vocabulary: Vocabulary, out: str, checkpoint: str,
                                context_length: int = CONTEXT_LENGTH,
                                width: int = CHUNK_WIDTH, trigger: dict = ONCE) -> StreamingQuery:
    """Context of every user turn in a stream (conv_id, turn, role, text).

    The carried state is the pairs that may still fit, at most C tokens per conversation, and the
    last turn, which may be waiting for its reply.
    """
    spoken = turns.where(F.col("role").isin("user", "assistant")).select(
        "conv_id", "turn", "role", "text")

    def step(carried: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
        check_order(carried, new, "conv_id", "turn")
        both = carried.unionByName(new)
        placed = place_turns(both, vocabulary, width)
        fresh = context_of(placed, context_length).join(
            new.select("conv_id", "turn"), ["conv_id", "turn"], "left_semi")
        last = both.groupBy("conv_id").agg(
            F.max("turn").alias("turn"),
            F.max_by(F.struct("role", "text"), "turn").alias("s"))
        kept = retained_turns(placed, context_length).unionByName(
            last.select("conv_id", "turn", "s.role", "s.text"))
        return fresh, kept.dropDuplicates(["conv_id", "turn"])

    return run_with_carry(spoken, "conv_id", step, out, checkpoint, trigger)

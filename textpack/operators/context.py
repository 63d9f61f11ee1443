"""Chat history trimmed to a context window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textpack.constants import CONTEXT_LENGTH, END_TOKEN
from textpack.functions.text import py_strip, render_chat, render_open_prompt
from textpack.functions.tokens import encode_ids
from textpack.operators.ordering import (
    CHUNK_WIDTH,
    chunk_buckets,
    running,
    with_previous,
)
from textpack.operators.vocabulary import Vocabulary
from textpack.session import materialize

# Token positions handled by one task, in context lengths.
CONTEXTS_PER_TASK = 1024


def chat_segments(turns: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """One row per user turn: (conv_id, turn, user, reply_turn, assistant); the last two are null
    when no reply follows. Blank user turns and system turns do not count.
    """
    spoken = turns.where(F.col("role").isin("user", "assistant")).select(
        "conv_id", "turn", "role", py_strip(F.coalesce("text", F.lit(""))).alias("text"))
    # Looking back from the end: negated turns make the reply the previous row.
    flipped = spoken.withColumn("_back", -F.col("turn"))
    linked = with_previous(flipped, "conv_id", "_back", ["turn", "role", "text"], width)
    reply = F.when(F.col("previous.role") == "assistant", F.col("previous"))
    return linked.where((F.col("role") == "user") & (F.col("text") != "")).select(
        "conv_id", "turn", F.col("text").alias("user"), reply["turn"].alias("reply_turn"),
        reply["text"].alias("assistant"))


def place_turns(turns: DataFrame, vocabulary: Vocabulary, width: int = CHUNK_WIDTH) -> DataFrame:
    """Encode each user turn and its pair, and lay the pairs of a conversation end to end.

    Adds pair_ids, prompt_ids, pair_len, start and conv_len to the segments.
    """
    # Control tokens separate the parts, so the ids of a pair are those of its parts in a row.
    end_id = vocabulary.specials[END_TOKEN]
    replied = F.col("assistant").isNotNull()
    encoded = chat_segments(turns, width).withColumns({
        "prompt_ids": encode_ids(render_open_prompt("user"), vocabulary),
        "reply_ids": encode_ids("assistant", vocabulary),
    }).withColumn(
        "pair_ids", F.when(replied, F.concat("prompt_ids", "reply_ids", F.array(F.lit(end_id))))
    ).drop("reply_ids").withColumn(
        "pair_len", F.when(replied, F.size("pair_ids")).otherwise(0))
    # The lengths are read several times, the ids once.
    encoded = materialize(encoded, "turns")
    return running(encoded, "turn", chunk_buckets("turn", width, 1 << 32), ["conv_id"],
                   sums={"start": F.col("pair_len").cast("long")}, totals={"conv_len": "start"})


def with_history(placed: DataFrame, payload: Column,
                 context_length: int = CONTEXT_LENGTH) -> DataFrame:
    """Add ``history``: payloads of the earlier pairs that fit before each prompt, in order.

    Pair i stays for prompt t iff start_t - start_i + len(prompt_t) <= C. The window therefore spans
    at most C token positions, and a conversation can be cut anywhere as long as each cut takes the
    C positions before it along: long conversations are spread over many tasks.
    """
    c = context_length
    span = c * CONTEXTS_PER_TASK
    # Prompts that no reply follows stand at one position, so history belongs to positions: at most
    # one pair starts at each, and any number of prompts is joined to it.
    entry = F.struct(F.col("start").alias("at"), F.col("turn").alias("turn"), payload.alias("item"))
    points = placed.groupBy("conv_id", "start").agg(
        F.max(F.when(F.col("pair_len") > 0, F.struct(F.col("turn").alias("key"), entry.alias("entry"))))["entry"].alias("entry"))
    chunk = F.floor(F.col("start") / F.lit(span))
    # A pair near the end of a chunk is also context for the start of the next.
    reach = F.floor((F.col("start") + c) / F.lit(span))
    rows = points.select("*", chunk.alias("_own"), F.explode(F.sequence(chunk, reach)).alias("_chunk"))
    near = Window.partitionBy("conv_id", "_chunk").orderBy("start").rangeBetween(-c, -1)
    # collect_list skips nulls: a position without a pair leaves none behind.
    seen = rows.withColumn("_seen", F.collect_list("entry").over(near)).where(
        F.col("_own") == F.col("_chunk")).select("conv_id", "start", "_seen")
    framed = placed.join(seen, ["conv_id", "start"])
    room = F.col("start") + F.size("prompt_ids") - c
    kept = F.filter("_seen", lambda e: e["at"] >= room)
    return framed.withColumn(
        "history", F.transform(F.array_sort(kept), lambda e: e["item"])).drop("_seen")


def chat_context(turns: DataFrame, vocabulary: Vocabulary,
                 context_length: int = CONTEXT_LENGTH, width: int = CHUNK_WIDTH) -> DataFrame:
    """Per user turn the ids a model would be shown: (conv_id, turn, n_pairs, ids)."""
    return context_of(place_turns(turns, vocabulary, width), context_length)


def context_of(placed: DataFrame, context_length: int = CONTEXT_LENGTH) -> DataFrame:
    """Contexts of placed turns. The oldest pairs are left out until the rest fits; a prompt that
    is too long on its own keeps its last C ids."""
    framed = with_history(placed, F.col("pair_ids"), context_length)
    prompt = F.when(
        F.size("prompt_ids") > context_length,
        F.slice("prompt_ids", -context_length, context_length)).otherwise(F.col("prompt_ids"))
    return framed.select(
        "conv_id", "turn", F.size("history").alias("n_pairs"),
        F.concat(F.flatten("history"), prompt).alias("ids"))


def render_transcript(turns: DataFrame, vocabulary: Vocabulary,
                      context_length: int = CONTEXT_LENGTH, width: int = CHUNK_WIDTH) -> DataFrame:
    """Per user turn the transcript of the history still held, plus the open prompt, as text."""
    placed = place_turns(turns, vocabulary, width)
    framed = with_history(placed, render_chat("user", "assistant"), context_length)
    return framed.select(
        "conv_id", "turn", F.size("history").alias("n_pairs"),
        F.concat(F.array_join("history", ""), render_open_prompt("user")).alias("transcript"))


def retained_turns(placed: DataFrame, context_length: int = CONTEXT_LENGTH) -> DataFrame:
    """Turns of the pairs that a later prompt of the same conversation could still be shown."""
    recent = placed.where(
        (F.col("pair_len") > 0) & (F.col("conv_len") - F.col("start") <= context_length))
    sides = F.array(
        F.struct(F.col("turn"), F.lit("user").alias("role"), F.col("user").alias("text")),
        F.struct(F.col("reply_turn").alias("turn"), F.lit("assistant").alias("role"),
                 F.col("assistant").alias("text")))
    return recent.select("conv_id", F.explode(sides).alias("s")).select("conv_id", "s.*")

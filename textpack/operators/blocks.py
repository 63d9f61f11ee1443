"""Parsing: line streams into instruction/story pairs, and turns into chat pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpack.constants import EOS_TOKEN, INSTRUCTION_PREFIXES, STORY_PREFIX
from textpack.functions.text import collapse_ws, py_strip
from textpack.operators.ordering import (
    CHUNK_WIDTH,
    chunk_buckets,
    running,
    with_previous,
)


def _starts_with_any(text: Column, prefixes: list[str]) -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | text.startswith(prefix)
    return hit


def classify_lines(lines: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """Per line (src, line_no, line): its block, whether that block is closed, and its part.

    ``part`` is ``user`` or ``assistant`` for text that belongs to the pair, ``end`` for the
    closing line and null for lines that do not count.
    """
    text = F.col("_text")
    is_end, is_story = text == EOS_TOKEN, text.startswith(STORY_PREFIX)
    cleaned = lines.select(
        "src", "line_no", "line", py_strip(F.coalesce(F.col("line"), F.lit(""))).alias("_text"))
    placed = running(
        cleaned, "line_no", chunk_buckets("line_no", width), ["src"],
        sums={"block": is_end.cast("long")},
        maxes={"_last_end": F.when(is_end, F.col("line_no")),
               "_last_story": F.when(is_story, F.col("line_no"))},
        totals={"_blocks": "block"})
    in_story = F.coalesce(
        F.col("_last_story") > F.coalesce(F.col("_last_end"), F.col("_last_story") - 1),
        F.lit(False))
    body = F.when(is_story, py_strip(F.substring(text, len(STORY_PREFIX) + 1, 2**31 - 1))) \
        .otherwise(text)
    part = (
        F.when(is_end, "end")
        .when(is_story, "assistant")
        .when(in_story, F.when(text != "", "assistant"))
        .when(_starts_with_any(text, INSTRUCTION_PREFIXES), "user"))
    return placed.select(
        "src", "line_no", "line", "block", (F.col("block") < F.col("_blocks")).alias("closed"),
        part.alias("part"), body.alias("body"))


def assemble_blocks(classified: DataFrame) -> DataFrame:
    """Closed blocks that have both parts, as (src, end_line, user, assistant).

    Lines that do not count, and the unclosed tail of a source, are gone before the grouping, so
    a group is no larger than the pair it becomes.
    """
    used = classified.where("closed and (part = 'end' or body <> '') and part is not null")
    line = F.struct("line_no", "part", "body")
    grouped = used.groupBy("src", "block").agg(F.array_sort(F.collect_list(line)).alias("lines"))

    def joined(part: str) -> Column:
        own = F.filter("lines", lambda x: x["part"] == part)
        return collapse_ws(F.array_join(F.transform(own, lambda x: x["body"]), " "))

    pairs = grouped.select(
        "src", F.element_at("lines", -1)["line_no"].alias("end_line"),
        joined("user").alias("user"), joined("assistant").alias("assistant"))
    return pairs.where((F.col("user") != "") & (F.col("assistant") != ""))


def parse_blocks(lines: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """Line stream (src, line_no, line) into pairs (src, end_line, user, assistant).

    ``width`` is how many line numbers one task handles at a time.
    """
    return assemble_blocks(classify_lines(lines, width))


def open_lines(classified: DataFrame) -> DataFrame:
    """What a later part of the same sources still needs: the lines of the open block that count,
    and the last line of each source, which tells how far the source has been read."""
    last = classified.groupBy("src").agg(F.max("line_no").alias("_last"))
    return classified.join(last, "src").where(
        (~F.col("closed") & F.col("part").isNotNull()) | (F.col("line_no") == F.col("_last"))
    ).select("src", "line_no", "line")


def pair_turns(turns: DataFrame, width: int = CHUNK_WIDTH) -> DataFrame:
    """A user turn directly followed by an assistant turn becomes a pair.

    Input (conv_id, turn, role, text); output (conv_id, turn, user, assistant) where ``turn`` is
    the user's. System turns do not count.
    """
    spoken = turns.where(F.col("role").isin("user", "assistant")).select(
        "conv_id", "turn", "role", "text")
    linked = with_previous(spoken, "conv_id", "turn", ["turn", "role", "text"], width)
    return linked.where(
        (F.col("role") == "assistant") & (F.col("previous.role") == "user")
    ).select("conv_id", F.col("previous.turn").alias("turn"),
             F.col("previous.text").alias("user"), F.col("text").alias("assistant"))

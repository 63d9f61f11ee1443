"""Row filters on stories and chat pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpack.constants import CHAT_TOKENS, DEFAULT_USER_TURN, EOS_TOKEN, MAX_CHAT_TOKENS
from textpack.functions.text import clean, ellipsis, looks_english, py_strip, render_chat
from textpack.functions.tokens import byte_count, encode_ids, piece_count
from textpack.operators.ordering import limit_n
from textpack.operators.vocabulary import Vocabulary

CONTROLS = [EOS_TOKEN, *CHAT_TOKENS]
Counter = Callable[[Column], Column]


def byte_counter(text: Column) -> Column:
    return byte_count(text, CONTROLS)


def piece_counter(text: Column) -> Column:
    return piece_count(text, CONTROLS)


def bpe_counter(vocabulary: Vocabulary) -> Counter:
    return lambda text: F.size(encode_ids(text, vocabulary))


def computed_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add or replace columns so that a later filter on them reads the result. Added by a plain
    projection, their expressions would be copied into the filter and evaluated again there."""
    others = [c for c in rows.columns if c not in columns]
    cell = F.struct(*[value.alias(name) for name, value in columns.items()])
    return rows.select(*others, F.inline(F.array(cell)))


def usable_stories(rows: DataFrame, key: str, text: str = "text",
                   max_rows: int | None = None) -> DataFrame:
    """Stripped, non-empty stories as (key, text); optionally the first ``max_rows`` of them, in order."""
    kept = rows.select(key, py_strip(F.coalesce(F.col(text), F.lit(""))).alias("text")).where(
        "text <> ''")
    return kept if max_rows is None else limit_n(kept, key, max_rows).orderBy(key)


def synth_user_turn(rows: DataFrame, key: str, text: str = "text",
                    max_rows: int | None = None) -> DataFrame:
    """Stories without an instruction get the default user turn."""
    pairs = rows.select(key, F.lit(DEFAULT_USER_TURN).alias("user"),
                        clean(text).alias("assistant")).where("assistant <> ''")
    return pairs if max_rows is None else limit_n(pairs, key, max_rows).orderBy(key)


def clean_pairs(pairs: DataFrame) -> DataFrame:
    """Collapse whitespace in both turns; null becomes empty."""
    return computed_once(pairs, {"user": clean("user"), "assistant": clean("assistant")})


def drop_empty_turns(pairs: DataFrame) -> DataFrame:
    return clean_pairs(pairs).where((F.col("user") != "") & (F.col("assistant") != ""))


def token_length_filter(rows: DataFrame, max_tokens: int = MAX_CHAT_TOKENS) -> DataFrame:
    return rows.where(F.col("n_tokens") <= max_tokens)


def with_drop_reason(pairs: DataFrame, counter: Counter = piece_counter,
                     max_tokens: int = MAX_CHAT_TOKENS) -> DataFrame:
    """Add line, n_tokens and drop_reason; the first matching reason wins.

    Tokens are counted last and only for rows that passed the cheaper tests.
    """
    rendered = clean_pairs(pairs).withColumn("line", render_chat("user", "assistant"))
    early = (
        F.when((F.col("user") == "") | (F.col("assistant") == ""), "empty")
        .when(~looks_english("line"), "non_english"))
    counted = rendered.withColumn("_early", early).withColumn(
        "n_tokens", F.when(F.col("_early").isNull(), counter(F.col("line"))))
    return counted.withColumn(
        "drop_reason",
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(F.col("n_tokens") > max_tokens, "too_long").otherwise("kept")).drop("_early")


def english_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with two non-empty turns that look English, rendered as ``line``."""
    rendered = computed_once(drop_empty_turns(pairs), {"line": render_chat("user", "assistant")})
    return rendered.where(looks_english("line")).drop("user", "assistant")


def format_pairs(pairs: DataFrame, counter: Counter = piece_counter,
                 max_tokens: int = MAX_CHAT_TOKENS) -> DataFrame:
    """Kept conversations with their rendered line and token count. Also valid on a stream."""
    counted = computed_once(english_pairs(pairs), {"n_tokens": counter(F.col("line"))})
    return token_length_filter(counted, max_tokens)


def preview_lines(lines: DataFrame, key: str, n: int = 3, width: int = 240) -> DataFrame:
    return lines.orderBy(key).limit(n).select(key, ellipsis("line", width).alias("line"))


def preview_pairs(pairs: DataFrame, keys: list[str], n: int = 3, width: int = 220) -> DataFrame:
    return pairs.orderBy(*keys).limit(n).select(
        *keys, ellipsis("user", width, mark=False).alias("user"),
        ellipsis("assistant", width).alias("assistant"))

"""Chat pairs to formatted conversations and packed blocks per split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.constants import CONTEXT_LENGTH, MAX_CHAT_TOKENS, SEED, VAL_FRACTION
from textpack.functions.tokens import encode_ids
from textpack.operators.clean import computed_once, english_pairs, token_length_filter
from textpack.operators.ordering import split_and_place
from textpack.operators.pack import pack_blocks
from textpack.operators.vocabulary import Vocabulary
from textpack.session import dealt, materialize, materialize_by


def encode_chat(pairs: DataFrame, vocabulary: Vocabulary, max_tokens: int = MAX_CHAT_TOKENS,
                row_id: list[str] | None = None) -> DataFrame:
    """Kept conversations (ids, n_tokens) from a written table, in buckets of ``row_id`` if that is given, so
    that their ids aren't shuffled to meet their places.

    Cheap filters run first, each remaining line is encoded once, and lines that are too long are
    dropped before the write.
    """
    kept = english_pairs(pairs)
    encoded = computed_once(dealt(kept, row_id) if row_id else kept, {"ids": encode_ids("line", vocabulary)}).drop("line")
    counted = token_length_filter(encoded.withColumn("n_tokens", F.size("ids")), max_tokens)
    return materialize_by(counted, "chat", row_id) if row_id else materialize(counted, "chat")


def pack_chat(encoded: DataFrame, row_id: list[str], context_length: int = CONTEXT_LENGTH,
              fraction: float = VAL_FRACTION, seed: int | str = SEED) -> DataFrame:
    """Encoded conversations, shuffled and split, as blocks (split, block_id, tokens)."""
    placed = split_and_place(encoded, row_id, fraction, seed)
    return pack_blocks(placed, context_length, ["split"])

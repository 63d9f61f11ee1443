"""Stories to packed training blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textpack.constants import CONTEXT_LENGTH
from textpack.operators.clean import usable_stories
from textpack.operators.encode import encode_rows
from textpack.operators.ordering import in_ranges, range_buckets
from textpack.operators.pack import pack_blocks, place_in_stream
from textpack.operators.vocabulary import Vocabulary
from textpack.session import dealt, materialize, materialize_by


def place_corpus(rows: DataFrame, key: str, vocabulary: Vocabulary,
                 max_rows: int | None = None) -> DataFrame:
    """Usable stories as (key, ids, start), each closed by EOS, placed in key order.

    Texts are dealt by key and encoded once, into a table in buckets of the key. Only keys and lengths are
    ordered; the ids meet their places where they lie and are never shuffled for it.
    """
    stories = dealt(usable_stories(rows, key, max_rows=max_rows), [key])
    encoded = materialize_by(encode_rows(stories, vocabulary, append_eos=True), "encoded", [key])
    lengths = in_ranges(encoded.select(key, "n_tokens"), key)
    places = materialize(place_in_stream(lengths, key, range_buckets()).select(key, "start"), "places")
    return encoded.join(places, key)


def pack_corpus(rows: DataFrame, key: str, vocabulary: Vocabulary,
                context_length: int = CONTEXT_LENGTH, max_rows: int | None = None) -> DataFrame:
    """Stories in key order as blocks (block_id, tokens)."""
    return pack_blocks(place_corpus(rows, key, vocabulary, max_rows), context_length)

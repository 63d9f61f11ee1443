"""Encoding tables of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textpack.functions.tokens import encode_ids, round_trip
from textpack.operators.vocabulary import Vocabulary


def encode_rows(rows: DataFrame, vocabulary: Vocabulary, text: str = "text",
                append_eos: bool = False) -> DataFrame:
    """Replace the text by ``ids`` and ``n_tokens``; optionally close each row with EOS.

    Stories get an EOS; chat lines do not, they end in their own control token.
    """
    ids = encode_ids(text, vocabulary)
    if append_eos:
        ids = F.array_append(ids, F.lit(vocabulary.eos_id))
    others = [c for c in rows.columns if c != text]
    return rows.select(*others, ids.alias("ids")).withColumn("n_tokens", F.size("ids"))


def roundtrip_check(rows: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """How many rows there are, and how many do not decode to what was encoded."""
    back = rows.select(F.col(text).alias("original"), round_trip(text, vocabulary).alias("decoded"))
    return back.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("original") != F.col("decoded")).alias("n_bad"))


def special_token_check(vocabulary: Vocabulary, rows: DataFrame, text: str = "text") -> DataFrame:
    """How often each control token occurs in the texts and how often its id was produced."""
    def produced(token_id: int) -> Column:
        return F.sum(F.size(F.filter("ids", lambda x: x == token_id))).alias(f"i{token_id}")

    ids = encode_ids(text, vocabulary)
    spelled = [F.sum(F.regexp_count(text, F.lit(r"\Q" + t + r"\E"))).alias(f"t{i}")
               for t, i in vocabulary.specials.items()]
    sums = rows.select(text, ids.alias("ids")).agg(
        *spelled, *[produced(i) for i in vocabulary.specials.values()])
    cells = [F.struct(F.lit(t).alias("token"), F.col(f"t{i}").alias("n_text"),
                      F.col(f"i{i}").alias("n_ids")) for t, i in vocabulary.specials.items()]
    return sums.select(F.explode(F.array(*cells)).alias("c")).select("c.*")

"""The vocabulary: bounded by a two-byte id, so it may live on the driver and in literals."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textpack.constants import (
    CHAT_TOKENS,
    EOS_TOKEN,
    MAX_VOCAB_SIZE,
    SYMBOL_BASE,
    byte_alphabet,
)

VOCAB_SCHEMA = "id int, token string, special boolean"
MERGES_SCHEMA = "rank int, lhs string, rhs string"


@dataclass(frozen=True)
class Vocabulary:
    """Id 0 is EOS, ids 1..256 are the bytes, then learned tokens, then added control tokens.

    ``merges`` holds (left id, right id, merged id) in rank order.
    """

    merges: tuple[tuple[int, int, int], ...] = ()
    specials: dict[str, int] = field(default_factory=lambda: {EOS_TOKEN: 0})

    def __post_init__(self):
        if self.size > MAX_VOCAB_SIZE:
            raise ValueError(f"vocabulary of {self.size} tokens does not fit in two bytes")

    @property
    def size(self) -> int:
        learned = {m for _, _, m in self.merges}
        added = [i for i in self.specials.values() if i > 0]
        return 257 + len(learned) + len(added)

    @property
    def eos_id(self) -> int:
        if EOS_TOKEN not in self.specials:
            raise ValueError(f"{EOS_TOKEN} is missing from the vocabulary")
        return self.specials[EOS_TOKEN]

    def with_chat_tokens(self) -> Vocabulary:
        """Add the chat control tokens behind the last id; those already present stay."""
        specials = dict(self.specials)
        for token in CHAT_TOKENS:
            if token not in specials:
                specials[token] = self.size + len(specials) - len(self.specials)
        return Vocabulary(self.merges, specials)

    def special_ids(self) -> list[int]:
        return sorted(self.specials.values())

    def tokens(self) -> list[str]:
        """Written form of each id, in the printable byte alphabet."""
        by_id = {i + 1: c for i, c in enumerate(sorted(byte_alphabet()))}
        by_id[0] = EOS_TOKEN
        for left, right, merged in self.merges:
            by_id[merged] = by_id[left] + by_id[right]
        by_id.update({i: t for t, i in self.specials.items()})
        return [by_id[i] for i in range(self.size)]

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        special = set(self.specials.values())
        rows = [(i, token, i in special) for i, token in enumerate(self.tokens())]
        return spark.createDataFrame(rows, VOCAB_SCHEMA)

    def merges_table(self, spark: SparkSession) -> DataFrame:
        written = self.tokens()
        rows = [(r, written[a], written[b]) for r, (a, b, _) in enumerate(self.merges)]
        return spark.createDataFrame(rows, MERGES_SCHEMA)

    @staticmethod
    def from_tables(vocab: DataFrame, merges: DataFrame) -> Vocabulary:
        """Rebuild from the two tables; both are checked to be within the two-byte bound."""
        vocab_rows = vocab.limit(MAX_VOCAB_SIZE + 1).collect()
        merge_rows = merges.orderBy("rank").limit(MAX_VOCAB_SIZE + 1).collect()
        if len(vocab_rows) > MAX_VOCAB_SIZE or len(merge_rows) > MAX_VOCAB_SIZE:
            raise ValueError("the tables hold more tokens than fit in two bytes")
        ids = {r.token: r.id for r in vocab_rows}
        return Vocabulary(
            tuple((ids[r.lhs], ids[r.rhs], ids[r.lhs + r.rhs]) for r in merge_rows),
            {r.token: r.id for r in vocab_rows if r.special})


def add_special_tokens(vocab: DataFrame, tokens: list[str] = CHAT_TOKENS) -> DataFrame:
    """Append tokens the table lacks, with the ids after its last one."""
    spark = vocab.sparkSession
    wanted = spark.createDataFrame(list(enumerate(tokens)), "pos int, token string")
    # The window runs over the handful of added tokens only.
    missing = (
        wanted.join(vocab, "token", "left_anti")
        .withColumn("id", F.row_number().over(Window.orderBy("pos"))
                    + vocab.agg(F.max("id")).scalar())
        .select(F.col("id").cast("int"), "token", F.lit(True).alias("special")))
    return vocab.select("id", "token", "special").unionByName(missing)


def token_ids(vocab: DataFrame, tokens: list[str]) -> DataFrame:
    """Ids of the given tokens; a token the vocabulary lacks is an error."""
    wanted = vocab.sparkSession.createDataFrame([(t,) for t in tokens], "token string")
    found = F.when(F.col("id").isNull(),
                   F.raise_error(F.concat(F.lit("token missing from the vocabulary: "),
                                          F.col("token"))).cast("int")).otherwise(F.col("id"))
    return wanted.join(vocab.select("id", "token"), "token", "left").select(
        "token", found.alias("id"))


def assert_vocab_fits(vocab: DataFrame, limit: int = MAX_VOCAB_SIZE) -> DataFrame:
    """One row (vocab_size); fails when an id does not fit in two bytes."""
    size: Column = F.max("id") + 1
    return vocab.agg(
        F.when(size > limit, F.raise_error(F.lit(f"vocabulary exceeds {limit} tokens"))
               .cast("int")).otherwise(size).alias("vocab_size"))

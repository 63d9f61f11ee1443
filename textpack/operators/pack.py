"""Packing token streams into fixed-length blocks, and planning batches over them."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textpack.constants import CONTEXT_LENGTH, SEED
from textpack.operators.ordering import (
    global_offset,
    hash_buckets,
    hash_key,
    running,
)

# Rounds of the permutation of an epoch.
SWAP_ROUNDS = 48


def place_in_stream(encoded: DataFrame, order: Column | str, buckets: list[Column],
                    partition: list[str] | None = None) -> DataFrame:
    """Add ``start``, the stream position of each row's first token. Needs ids and n_tokens.

    ``n_tokens`` is a column of its own so that the totals pass need not read or build the ids.
    """
    return global_offset(encoded, "n_tokens", order, buckets, partition, out="start")


def pack_blocks(placed: DataFrame, context_length: int = CONTEXT_LENGTH,
                partition: list[str] | None = None) -> DataFrame:
    """Stream rows (ids, start) into blocks (partition..., block_id, tokens).

    Block i holds tokens [i*C, i*C+C], so a token at a multiple of C is in two blocks. Blocks that lie within one row
    are cut where it is. Only a row's shares of the blocks that reach beyond it, at most four, are exchanged; a group
    is then at most C+1 tokens. The incomplete last block is dropped.
    """
    partition, c = partition or [], context_length
    n = F.size("ids")
    last = F.col("start") + n - 1
    first_block = F.greatest(F.lit(0), F.ceil((F.col("start") - c) / F.lit(c))).cast("long")
    last_block = F.floor(last / F.lit(c)).cast("long")
    first_whole = F.ceil(F.col("start") / F.lit(c)).cast("long")
    last_whole = (last_block - 1).cast("long")

    def cut(lo: Column, hi: Column) -> Column:
        return F.slice("ids", (lo - F.col("start") + 1).cast("int"), (hi - lo + 1).cast("int"))

    def share(block: Column) -> Column:
        lo = F.greatest(F.col("start"), block * c)
        hi = F.least(last, block * c + c)
        return F.struct(block.alias("block_id"), lo.alias("lo"), cut(lo, hi).alias("ids"))

    whole = placed.where((n > c) & (first_whole <= last_whole)).select(
        *partition, F.explode(F.sequence(first_whole, last_whole)).alias("block_id"), "ids", "start").select(
        *partition, "block_id", cut(F.col("block_id") * c, F.col("block_id") * c + c).alias("tokens"))
    beyond = F.when(first_whole <= last_whole, F.filter(F.array(first_whole - 1, last_block), lambda b: b >= 0)) \
        .otherwise(F.sequence(first_block, last_block))
    shares = placed.where(n > 0).select(*partition, F.explode(F.transform(beyond, share)).alias("s"))
    grouped = shares.select(
        *partition, "s.block_id", F.struct("s.lo", "s.ids").alias("s"), F.size("s.ids").alias("n")
    ).groupBy(*partition, "block_id").agg(
        F.array_sort(F.collect_list("s")).alias("shares"), F.sum("n").alias("n"))
    tokens = F.flatten(F.transform("shares", lambda s: s["ids"]))
    return whole.unionByName(grouped.where(F.col("n") == c + 1).select(
        *partition, "block_id", tokens.alias("tokens")))


def xy_shift(blocks: DataFrame, context_length: int = CONTEXT_LENGTH) -> DataFrame:
    """Input and target sequences of each block: the target is the input moved by one."""
    others = [c for c in blocks.columns if c != "tokens"]
    return blocks.select(
        *others, F.slice("tokens", 1, context_length).alias("x"),
        F.slice("tokens", 2, context_length).alias("y"))


def block_count(lengths: DataFrame, context_length: int = CONTEXT_LENGTH) -> int:
    """How many blocks texts of the given ``n_tokens`` pack into, without packing them."""
    tokens = lengths.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    return max(0, (tokens - 1) // context_length)


def numbered_blocks(spark: SparkSession, n_blocks: int, batch_size: int = 1) -> DataFrame:
    """Block ids to plan over; an error if they don't make one batch."""
    if n_blocks < batch_size:
        raise ValueError(f"{n_blocks} sequences are too few for a batch of {batch_size}")
    return spark.range(n_blocks).withColumnRenamed("id", "block_id")


def batch_plan(blocks: DataFrame, batch_size: int, epochs: int = 1, accum: int = 1,
               seed: int | str = SEED) -> DataFrame:
    """Which block goes into which batch and optimizer step of each epoch.

    Input (block_id); output (epoch, block_id, position, batch, step). Blocks are shuffled anew in
    every epoch. The tail short of a full batch is left out, as are batches beyond the last full
    group of ``accum``; when there is not even one such group, one short step is made.
    """
    accum = max(1, accum)
    epoch_rows = blocks.select("block_id", F.explode(F.sequence(F.lit(1), F.lit(epochs)))
                               .alias("epoch"))
    keyed = epoch_rows.withColumn("_key", hash_key(seed, "epoch", "block_id"))
    placed = running(keyed, F.struct("_key", "block_id"), hash_buckets("_key"), ["epoch"],
                     sums={"position": F.lit(1).cast("long")}, totals={"_n": "position"})
    batch = F.floor(F.col("position") / F.lit(batch_size))
    full = F.floor(F.col("_n") / F.lit(batch_size))
    usable = F.greatest(F.lit(1), F.floor(full / F.lit(accum))) * accum
    return placed.where(batch < F.least(full, usable)).select(
        "epoch", "block_id", "position", batch.alias("batch"),
        F.floor(batch / F.lit(accum)).alias("step"))


def permuted(block_id: Column, epoch: Column, n_blocks: int, epochs: int, seed: int | str = SEED) -> Column:
    """Place of a block among ``n_blocks`` in a permutation of its own for every epoch, computed from its id alone.

    A swap-or-not shuffle: each round pairs every place x with (k - x) mod n, for a k of that round, and a hash of the larger of the two
    decides whether both swap. Every round is a permutation of 0..n-1 for any n, so all of them are.
    """
    def drawn(e: int, i: int) -> int:
        return int(hashlib.md5(f"{seed}:{e}:{i}".encode()).hexdigest()[:15], 16) % n_blocks

    keys = F.array(*[F.array(*[F.lit(drawn(e, i)).cast("long") for i in range(SWAP_ROUNDS)]) for e in range(1, epochs + 1)])

    def round_(place: Column, i: Column) -> Column:
        partner = F.pmod(F.element_at(F.element_at(keys, epoch.cast("int")), i + 1) - place, F.lit(n_blocks))
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), i.cast("string"),
                                   F.greatest(place, partner).cast("string")))
        return F.when(F.substring(digest, 1, 1) >= "8", partner).otherwise(place)

    return F.aggregate(F.sequence(F.lit(0), F.lit(SWAP_ROUNDS - 1)), block_id.cast("long"), round_)


def batch_plan_permuted(spark: SparkSession, n_blocks: int, batch_size: int, epochs: int = 1, accum: int = 1,
                        seed: int | str = SEED) -> DataFrame:
    """The batch plan of so many blocks, without a sort, a shuffle or a total: each row of (epoch, block_id, position, batch,
    step) is computed by itself, for any number of blocks. The tail is left out as by ``batch_plan``."""
    accum = max(1, accum)
    full = n_blocks // batch_size
    usable = min(full, max(1, full // accum) * accum)
    rows = numbered_blocks(spark, n_blocks, batch_size).select(F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"), "block_id")
    place = permuted(F.col("block_id"), F.col("epoch"), n_blocks, epochs, seed)
    placed = rows.select("epoch", "block_id", F.inline(F.array(F.struct(place.alias("position")))))
    return placed.where(F.col("position") < usable * batch_size).select(
        "epoch", "block_id", "position", F.floor(F.col("position") / batch_size).alias("batch"),
        F.floor(F.col("position") / (batch_size * accum)).alias("step"))


def eval_plan(blocks: DataFrame, batch_size: int, max_batches: int) -> DataFrame:
    """Sequential validation batches (block_id, batch): at most ``max_batches``, tail left out."""
    n = blocks.agg(F.count(F.lit(1))).scalar()
    size = F.greatest(F.lit(1), F.least(F.lit(batch_size), n))
    batch = F.floor(F.col("block_id") / size)
    limit = F.least(F.floor(n / size), F.lit(max_batches))
    return blocks.select("block_id", batch.alias("batch")).where(F.col("batch") < limit)

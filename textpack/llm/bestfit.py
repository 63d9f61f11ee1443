"""Best-fit packing of token sequences, certified by lower bounds.

A text is its ids and an end id. Texts longer than a sequence are cut into whole sequences, the first piece being
shorter; whole pieces have a sequence of their own. All others are dealt to partitions of bounded size, and each is
packed by best-fit decreasing. Dual-feasible functions then bound from below how many sequences the pieces of a
partition can need at all: where the bound equals the count, nothing can be saved. Partitions with a gap give up
their sequences that aren't full; these pieces are dealt anew, so that pieces of different partitions meet, and
packed again, until no partition has a gap or a round saves nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.llm.bpe import coder
from textpack.llm.words import schema_with, slices
from textpack.session import materialize

CAPACITY, END_ID = 1024, 2
#: Pieces that one task packs, and most rounds of exchange.
PART_PIECES, ROUNDS = 100_000, 8


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id",
        text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of the encoded texts, a written table: ``piece_id, key, piece, start, length, ids_crc32`` (and ``ids``).

    A null or empty text is its end id alone. Every row is cut by itself, repeated rows and equal or null keys
    too; ``piece_id`` tells all pieces apart.
    """
    fields = "piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    schema = schema_with(docs.select(F.col(key).cast("long").alias(key)), fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokenizer)
        for batch in batches:
            for first, last in slices(batch.column(1)):
                ids, counts = own.encode(batch.column(1).slice(first, last - first))
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<i4")
                lengths = counts + 1
                n = -(-lengths // capacity)
                row = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                head = lengths - (n - 1) * capacity
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[row], capacity)
                ends = np.cumsum(length)
                raw = ids.tobytes()
                crcs = [zlib.crc32(raw[4 * (e - m):4 * e]) for e, m in zip(ends.tolist(), length.tolist())]
                made = [batch.column(0).slice(first, last - first).take(pa.array(row)), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crcs, pa.int64())]
                if with_ids:
                    made.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(made, names=schema.names)

    rows = docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, schema)
    return materialize(rows.withColumn("piece_id", F.monotonically_increasing_id()), "pieces")


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item and where it lies there: items by falling length, each into the fullest bin that has room."""
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0  # a bit for each room that some bin has left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, made
            made += 1
        bins[i], offsets[i] = at, capacity - room
        if room > size:
            by_room[room - size].append(at)
            rooms |= 1 << room - size
    return bins, offsets


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Fewest bins that so many items of these sizes can need, as far as dual-feasible functions tell.

    A dual-feasible function maps sizes so that what fits one bin still sums up to its value of a whole bin at most; the sum of
    all items over that value is then a bound. Three families are tried with all their parameters: those that drop small items and
    count large ones as whole bins, those that round down to multiples of a part, and those that count parts of a
    given size.
    """
    best = -(-int((sizes * counts).sum()) // capacity)
    for least in range(1, capacity // 2 + 1):
        kept = np.where(sizes > capacity - least, capacity, np.where(sizes >= least, sizes, 0))
        best = max(best, -(-int((kept * counts).sum()) // capacity))
        parts = capacity // least
        small, large = 2 * (sizes // least), 2 * (parts - (capacity - sizes) // least)
        counted = np.where(2 * sizes > capacity, large, np.where(2 * sizes == capacity, parts, small))
        best = max(best, -(-int((counted * counts).sum()) // (2 * parts)))
    for parts in range(2, 101):
        scaled = sizes * parts
        # Multiples of a part stay as they are, all else is rounded down, both as shares of parts - 1 times the capacity.
        rounded = np.where(scaled % capacity == 0, sizes * (parts - 1), scaled // capacity * capacity)
        best = max(best, -(-int((rounded * counts).sum()) // ((parts - 1) * capacity)))
    return best


def pack_part(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """One partition, packed: its sequences, named by their first piece, and by how many they exceed the bound."""
    rows = rows.sort_values("piece_id", ignore_index=True)
    lengths, names = rows["length"].to_numpy(), rows["piece_id"].to_numpy()
    bins, offsets = best_fit_decreasing(lengths, capacity)
    n = int(bins.max()) + 1
    first = np.empty(n, dtype=np.int64)
    first[bins[offsets == 0]] = names[offsets == 0]
    filled = np.bincount(bins, weights=lengths, minlength=n).astype(np.int64)
    return pd.DataFrame({"piece_id": names, "length": lengths, "sequence_id": first[bins], "offset": offsets,
                         "filled": filled[bins], "gap": n - lower_bound(*np.unique(lengths, return_counts=True), capacity)})


def place(pieces: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``piece_id, sequence_id, offset`` of all rows ``(piece_id, length)``, lengths from 1 to ``capacity``.

    A sequence bears the id of its first piece. No order among pieces is kept. Only ids and lengths are shuffled.
    """
    schema = "piece_id long, length long, sequence_id long, offset long, filled long, gap long"

    def packed(rows: DataFrame, n: int, number: int) -> DataFrame:
        parts = max(1, -(-n // part_pieces))
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("piece_id", F.lit(number)), F.lit(parts)))
        made = dealt.groupBy("part").applyInPandas(
            lambda group: pack_part(group[["piece_id", "length"]], capacity), schema)
        return materialize(made, "packed")

    whole = F.col("length") == capacity
    done = pieces.where(whole).select("piece_id", F.col("piece_id").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(~whole).select("piece_id", "length")
    placed = packed(rest, rest.count(), 0)
    for number in range(1, rounds + 1):
        open_ = (F.col("gap") > 0) & (F.col("filled") < capacity)
        pool = placed.where(open_)
        n, before = pool.agg(F.count("*"), F.count_if(F.col("offset") == 0)).first()
        if n == 0:
            break
        again = packed(pool.select("piece_id", "length"), n, number)
        if again.where("offset = 0").count() >= before:
            break  # nothing saved: what was there stays
        done = done.unionByName(placed.where(~open_).select(done.columns))
        placed = again
    return done.unionByName(placed.select(done.columns))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every row."""
    pieces = cut(docs, tokenizer, capacity, end_id, key, text)
    return pieces.join(place(pieces, capacity), "piece_id").drop("piece_id")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of pieces cut ``with_ids``; a group is one sequence, so at most its capacity."""
    part = F.struct("offset", "ids")
    whole = pieces.select("piece_id", "ids").join(placed, "piece_id").groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(part)).alias("parts"))
    return whole.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def certificate(pieces: DataFrame, placed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """How many sequences were made, and how many the pieces need at least; counts of lengths are all that is collected."""
    counts = pieces.groupBy("length").agg(F.count("*")).collect()  # at most ``capacity`` rows
    sizes, numbers = np.array(counts, dtype=np.int64).reshape(-1, 2).T
    return placed.where("offset = 0").count(), lower_bound(sizes, numbers, capacity)

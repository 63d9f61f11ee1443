"""Two tokenizers over the same texts, aligned by bytes.

Tokens of both sides are laid over the bytes of a text. Where tokens of both end they cut it into groups; between two
neighbouring ends of either side exactly one token of each side overlaps, and that is a link. Most groups are one
token against the token of the same bytes. Which id that is on the other side is known beforehand for every id, so such links
are counted in one vector as long as the vocabulary, per task and then added up. Only other links, which
come from irregular groups, are counted by pair in a shuffle.

To judge a text, the counts of its links are needed. The vector and the most frequent pairs, up to a fixed number,
go to every task; rarer pairs are few in the texts and are joined to their counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.llm.bpe import SpeculativeEncoder
from textpack.llm.pieces import PieceCoder, Vocabulary, gather
from textpack.llm.words import buffers_of, hash_runs, schema_with, slices
from textpack.session import materialize

#: Bits of the second id in a pair, and the most pairs that every task gets.
B_BITS = 16
HEAD_PAIRS = 1 << 18
#: Slots of the table of known chunks, and the ids it may hold before it starts anew.
SLOT_BITS, STORE_IDS = 19, 1 << 22


class ChunkCoder:
    """Ids of texts under a piece model. Every chunk, from one run of spaces to the next, is encoded once and kept in a
    table of bounded size.

    No piece of the model has a space after anything else, so no merge crosses the start of a chunk and the ids of
    a text are those of its chunks. A model of which that isn't true gets whole texts.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)]
        self.table = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)
        self.lengths = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        inside = any(a != "▁" and b == "▁" for p in pieces for a, b in zip(p, p[1:]))
        keeps_spaces = b"".join(self.bytes[i] for i in self.model.encode("  a ")) == b"   a "
        self.by_chunk = keeps_spaces and not inside
        self.renew()

    def renew(self) -> None:
        self.slot_hash = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
        self.slot_start, self.slot_length = (np.zeros(1 << SLOT_BITS, dtype=np.int32) for _ in range(2))
        self.store, self.stored = np.zeros(1 << 16, dtype=np.int32), 0

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.table, self.starts[ids], self.lengths[ids])

    def _encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that start with a space, which the model adds itself."""
        made = self.model.encode([t[1:].decode() for t in texts], num_threads=1)
        sizes = np.array([len(m) for m in made], dtype=np.int64)
        return np.fromiter((i for m in made for i in m), dtype=np.int32, count=int(sizes.sum())), sizes

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of rows of bytes that start with a space or are empty: all in a row, and how many each has."""
        heads = bounds[:-1][bounds[:-1] < bounds[1:]]
        if not len(heads):
            return np.zeros(0, dtype=np.int32), np.zeros(len(bounds) - 1, dtype=np.int64)
        if self.by_chunk:
            cut = raw == 0x20
            cut[1:] &= raw[:-1] != 0x20
            cut[heads] = True
            starts = np.flatnonzero(cut)
        else:
            starts = heads
        lengths = np.diff(np.append(starts, len(raw)))
        hashes = hash_runs(raw, starts, lengths)
        if self.stored > STORE_IDS:
            self.renew()
        slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        missing = np.flatnonzero(self.slot_hash[slot] != hashes)
        spot, sizes = self.slot_start[slot].astype(np.int64), self.slot_length[slot].astype(np.int64)
        if len(missing):
            _, example, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            example = missing[example]
            whole = raw.tobytes()
            made, made_sizes = self._encode_all(
                [whole[s:s + n] for s, n in zip(starts[example].tolist(), lengths[example].tolist())])
            while self.stored + len(made) > len(self.store):
                self.store = np.concatenate([self.store, np.zeros_like(self.store)])
            self.store[self.stored:self.stored + len(made)] = made
            begin = self.stored + np.cumsum(made_sizes) - made_sizes
            self.stored += len(made)
            spot[missing], sizes[missing] = begin[which], made_sizes[which]
            self.slot_hash[slot[example]] = hashes[example]
            self.slot_start[slot[example]], self.slot_length[slot[example]] = begin, made_sizes
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return gather(self.store, spot, sizes), np.diff(ends[np.searchsorted(starts, bounds)])


@dataclass
class Alignment:
    """Rows of texts, aligned. Tokens, links and groups lie in a row; ``*_at`` says where each row's begin."""

    a: np.ndarray
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    #: Group of each token, numbered over all rows.
    a_group: np.ndarray
    b_group: np.ndarray
    group_at: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_at: np.ndarray


class Aligner:
    def __init__(self, tokenizer: str, model: str):
        vocabulary = Vocabulary(tokenizer)
        vocabulary.special = {}  # their strings in a text are plain text
        self.a_coder = PieceCoder(vocabulary, SpeculativeEncoder(vocabulary).encode_new)
        self.b_coder = ChunkCoder(model)
        self.vocabulary = vocabulary
        by_bytes = {token: i for i, token in reversed(list(enumerate(self.b_coder.bytes)))
                    if not (self.b_coder.model.is_control(i) or self.b_coder.model.is_unknown(i))}
        # A byte may be a piece of its own as well; the piece is what texts are encoded with.
        by_bytes |= {token: i for i, token in reversed(list(enumerate(self.b_coder.bytes)))
                     if not (self.b_coder.model.is_byte(i) or self.b_coder.model.is_control(i) or self.b_coder.model.is_unknown(i))}
        self.same = np.full(vocabulary.size, -1, dtype=np.int64)
        for token, i in vocabulary.ids.items():
            self.same[i] = by_bytes.get(token, -1)

    def align(self, column: pa.Array) -> Alignment:
        text = column.fill_null("")
        spaced = pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise(" ", text, ""))
        raw, bounds = buffers_of(spaced)
        a, a_counts = self.a_coder.encode(spaced)
        b, b_counts = self.b_coder.encode(raw, bounds)
        a, a_counts, good_a = agreeing(a, a_counts, self.vocabulary.token_lengths, self.vocabulary.decode, raw, bounds)
        b, b_counts, good_b = agreeing(b, b_counts, self.b_coder.lengths, self.b_coder.decode, raw, bounds)
        for k in np.flatnonzero(good_a & ~good_b).tolist():  # two chunks of one hash, or a text that the model changes
            row = raw[bounds[k]:bounds[k + 1]]
            alone, size = self.b_coder._encode_all([row.tobytes()])
            alone, size, good = agreeing(alone, size, self.b_coder.lengths, self.b_coder.decode, row, np.array([0, len(row)]))
            if good[0]:
                at = int(b_counts[:k].sum())
                b = np.concatenate([b[:at], alone, b[at:]])
                b_counts[k], good_b[k] = size[0], True
        good = good_a & good_b
        if not good.all():
            a, b = a[np.repeat(good, a_counts)], b[np.repeat(good, b_counts)]
            a_counts, b_counts = a_counts * good, b_counts * good
        sizes = np.where(good, np.diff(bounds), 0)
        row_ends = np.concatenate([[0], np.cumsum(sizes)])
        mark = np.zeros(row_ends[-1] + 1, dtype=np.uint8)
        mark[np.cumsum(self.vocabulary.token_lengths[a])] |= 1
        mark[np.cumsum(self.b_coder.lengths[b])] |= 2
        mark[0] = 0
        ends = np.flatnonzero(mark)
        of_a, of_b = mark[ends] & 1 > 0, mark[ends] & 2 > 0
        both = of_a & of_b
        group = np.cumsum(both) - both
        link_at = np.searchsorted(ends, row_ends, side="right")
        group_at = np.concatenate([[0], np.cumsum(both)])[link_at]
        return Alignment(
            a, b, np.concatenate([[0], np.cumsum(a_counts)]), np.concatenate([[0], np.cumsum(b_counts)]),
            group[of_a], group[of_b], group_at, a[np.cumsum(of_a) - of_a], b[np.cumsum(of_b) - of_b], link_at)


def agreeing(ids: np.ndarray, counts: np.ndarray, lengths: np.ndarray, decode: Callable, raw: np.ndarray,
             bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the rows whose bytes they spell, with counts, and which rows these are; others have none."""
    spelled = decode(ids)
    if np.array_equal(spelled, raw) and np.array_equal(
            np.concatenate([[0], np.cumsum(lengths[ids])])[np.cumsum(counts)], bounds[1:]):
        return ids, counts, np.ones(len(counts), dtype=bool)
    at = np.concatenate([[0], np.cumsum(lengths[ids])])[np.concatenate([[0], np.cumsum(counts)])]
    good = np.array([np.array_equal(spelled[s:e], raw[x:y]) for s, e, x, y in zip(at, at[1:], bounds, bounds[1:])], dtype=bool)
    return ids[np.repeat(good, counts)], counts * good, good


def spelled_groups(found: Alignment, digits: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All groups as bytes ``a1,a2|b1;...``, each group with a semicolon behind it, and where each row begins."""
    table, starts, lengths = digits
    groups = int(found.group_at[-1])
    n_a, n_b = np.bincount(found.a_group, minlength=groups), np.bincount(found.b_group, minlength=groups)
    place_a = np.arange(len(found.a)) + (np.cumsum(n_b) - n_b)[found.a_group]
    place_b = np.arange(len(found.b)) + np.cumsum(n_a)[found.b_group]
    tokens = np.empty(len(found.a) + len(found.b), dtype=np.int64)
    tokens[place_a], tokens[place_b] = found.a, found.b
    written = gather(table, starts[tokens], lengths[tokens]).copy()
    ends = np.concatenate([[0], np.cumsum(lengths[tokens])])
    written[ends[np.cumsum(n_a) + np.cumsum(n_b) - n_b] - 1] = ord("|")
    group_ends = ends[np.cumsum(n_a + n_b)]
    written[group_ends - 1] = ord(";")
    return written, np.concatenate([[0], group_ends])[found.group_at]


def digits_of(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal spelling of every id with one byte after it: bytes, starts and lengths."""
    spelled = [f"{i},".encode() for i in range(size)]
    lengths = np.array([len(s) for s in spelled], dtype=np.int64)
    return np.frombuffer(b"".join(spelled), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


def lists(values: np.ndarray, rows: np.ndarray, n_rows: int, kind: pa.DataType) -> pa.ListArray:
    """One list per row of values that are in order of their rows."""
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(rows, np.arange(n_rows + 1)), pa.int32()), pa.array(values, kind))


_aligners: dict[tuple[str, str], tuple[Aligner, tuple]] = {}


def aligner(tokenizer: str, model: str) -> tuple[Aligner, tuple]:
    """Aligner and digits of a pair of files, built once in each Python worker."""
    if (tokenizer, model) not in _aligners:
        own = Aligner(tokenizer, model)
        _aligners[tokenizer, model] = own, digits_of(max(own.vocabulary.size, len(own.b_coder.bytes)))
    return _aligners[tokenizer, model]


def groups(docs: DataFrame, tokenizer: str, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, groups``: the groups of every row, each with the ids of both sides. A null or empty text has none, nor
    has one that the ids of either side don't spell byte by byte."""
    schema = schema_with(docs.select(key), "groups array<struct<a:array<int>,b:array<int>>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = aligner(tokenizer, model)
        for batch in batches:
            for start, end in slices(batch.column(1)):
                found = own.align(batch.column(1).slice(start, end - start))
                n = int(found.group_at[-1])
                pairs = pa.StructArray.from_arrays(
                    [lists(found.a, found.a_group, n, pa.int32()), lists(found.b, found.b_group, n, pa.int32())], names=["a", "b"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start),
                     pa.ListArray.from_arrays(pa.array(found.group_at, pa.int32()), pairs)], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def linked(docs: DataFrame, tokenizer: str, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes and digest of every row's groups and its distinct links, a written table.

    ``same`` has the ids linked to the id of the same bytes, ``pairs`` all other links as one number each, with how often
    in ``same_n`` and ``pairs_n``.
    """
    schema = schema_with(
        docs.select(key), "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same array<int>, "
                          "same_n array<int>, pairs array<long>, pairs_n array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digits = aligner(tokenizer, model)
        for batch in batches:
            for start, end in slices(batch.column(1)):
                n = end - start
                found = own.align(batch.column(1).slice(start, n))
                written, at = spelled_groups(found, digits)
                digests = [hashlib.sha256(written[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(at, at[1:])]
                row = np.repeat(np.arange(n), np.diff(found.link_at))
                same = own.same[found.link_a] == found.link_b
                ids, ids_n = np.unique(row[same] << B_BITS | found.link_a[same], return_counts=True)
                rest = ~same
                pair = found.link_a[rest].astype(np.int64) << B_BITS | found.link_b[rest]
                pairs, pairs_n = np.unique(row[rest] << 2 * B_BITS | pair, return_counts=True)
                in_row, in_pair_row = ids >> B_BITS, pairs >> 2 * B_BITS
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n),
                     *(pa.array(np.diff(x), pa.int64()) for x in (found.a_at, found.b_at, found.group_at, found.link_at)),
                     pa.array(digests, pa.string()),
                     lists(ids & (1 << B_BITS) - 1, in_row, n, pa.int32()), lists(ids_n, in_row, n, pa.int32()),
                     lists(pairs & (1 << 2 * B_BITS) - 1, in_pair_row, n, pa.int64()),
                     lists(pairs_n, in_pair_row, n, pa.int32())], names=schema.names)

    rows = docs.select(key, text).mapInArrow(run, schema)
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "links")


def same_counts(links: DataFrame, size: int) -> np.ndarray:
    """In how many texts each id is linked to the id of the same bytes; one vector per task, added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids])], names=["a", "n"])

    rows = links.select("same").mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, dtype=np.int64)
    counts[rows.column("a").to_numpy()] = rows.column("n").to_numpy()
    return counts


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, n``: in how many texts each other pair is linked, a written table."""
    return materialize(links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")


def head_threshold(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs are as frequent."""
    sizes = counts.groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count("*").alias("pairs")).collect()
    above, k = 0, 1 + max((r.k for r in sizes), default=0)
    by_size = {r.k: r.pairs for r in sizes}
    while k > 0 and above + by_size.get(k - 1, 0) <= most:
        above += by_size.get(k - 1, 0)
        k -= 1
    return 1 << k


def align(docs: DataFrame, tokenizer: str, model: str, key: str = "doc_id", text: str = "text",
          head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Per row ``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    The count of a pair of ids is the number of rows of ``docs`` that hold it linked. ``n_best`` counts the links whose
    pair is the most frequent of its first id, ties included, ``count_sum`` adds the counts of all links. Texts without
    tokens (see ``groups``) have zeros and an empty digest. Null and equal keys are rows of their own.
    """
    spark = docs.sparkSession
    size = Vocabulary(tokenizer).size
    links = linked(docs, tokenizer, model, key, text)
    same = same_counts(links, size)
    counts = pair_counts(links)
    most = counts.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("n").alias("n")).toArrow()  # a row per id at most
    best = same.copy()
    np.maximum.at(best, most.column("a").to_numpy(), most.column("n").to_numpy())
    least = head_threshold(counts, head_pairs)
    head = counts.where(F.col("n") >= least).orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(
        (same, best, head.column("pair").to_numpy(), head.column("n").to_numpy()))
    kept = [key, "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = schema_with(links.select(*kept), "n_best long, count_sum long, rare array<long>, rare_n array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, best, pairs, pair_n = shared.value

        def per_row(values: np.ndarray, of: pa.ListArray) -> np.ndarray:
            ends = np.concatenate([[0], np.cumsum(values)])
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(of).to_numpy())])
            return np.diff(ends[at])

        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            ids, ids_n, other, other_n = (column[c].flatten().to_numpy() for c in ("same", "same_n", "pairs", "pairs_n"))
            at = np.minimum(np.searchsorted(pairs, other), max(0, len(pairs) - 1))
            known = pairs[at] == other if len(pairs) else np.zeros(len(other), dtype=bool)
            n = np.where(known, pair_n[at], 0) if len(pairs) else np.zeros(len(other), dtype=np.int64)
            is_best = known & (n == best[other >> B_BITS])
            n_best = per_row(ids_n * (same[ids] == best[ids]), column["same"]) + per_row(other_n * is_best, column["pairs"])
            total = per_row(ids_n * same[ids], column["same"]) + per_row(other_n * n, column["pairs"])
            in_row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(column["pairs"]).to_numpy())[~known]
            yield pa.RecordBatch.from_arrays(
                [*(column[c] for c in kept), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()),
                 lists(other[~known], in_row, batch.num_rows, pa.int64()),
                 lists(other_n[~known], in_row, batch.num_rows, pa.int32())], names=schema.names)

    judged = materialize(links.mapInArrow(run, schema), "judged")
    rare = judged.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select(
        "row", F.col("r.rare").alias("pair"), F.col("r.rare_n").alias("times"))
    tops = spark.createDataFrame(pa.table({"a": np.arange(size), "top": best}))  # as long as the vocabulary
    rare_counts = counts.where(F.col("n") < least).withColumn("a", F.shiftright("pair", B_BITS)).join(F.broadcast(tops), "a")
    more = rare.join(rare_counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more"))
    return judged.join(more, "row", "left").select(
        key, "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")

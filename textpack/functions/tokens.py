"""Column functions that turn text into token pieces and ids, and back.

Cutting text into pieces is a native regular expression. Ids are made by an Arrow UDF on whole
batches: measured against a chain of native replaces it needs a fifth of the time at eight merges,
and the chain grows with the number of merges while the UDF does not.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from textpack.constants import PIECE_RE, SYMBOL_BASE, byte_alphabet, byte_ids
from textpack.functions.text import _col
from textpack.operators.vocabulary import Vocabulary

LATIN1 = "".join(chr(b) for b in range(256))
# The rank of every pair of tokens up to this id is kept in one table.
DENSE_VOCAB = 1024
# Bytes of text, or ids, that are worked on at once; NumPy needs many times as much for them. A longer text is a slice of its own.
SLICE = 1 << 20


def _latin1(text: Column) -> Column:
    """One character per UTF-8 byte."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def byte_text(text: Column | str) -> Column:
    """UTF-8 bytes of the text written in the printable 256-letter alphabet."""
    return F.translate(_latin1(_col(text)), LATIN1, "".join(byte_alphabet()))


def byte_symbols(text: Column | str) -> Column:
    """UTF-8 bytes of the text as one symbol each."""
    return F.translate(_latin1(_col(text)), LATIN1,
                       "".join(chr(SYMBOL_BASE + i) for i in byte_ids()))


def control_pattern(controls: list[str]) -> str:
    return "|".join(re.escape(c) for c in sorted(controls, key=len, reverse=True))


def _has_control(text: Column, controls: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in controls])


def split_controls(text: Column | str, controls: list[str]) -> Column:
    """Cut control tokens out of the text; both they and the stretches between are kept."""
    text = _col(text)
    if not controls:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.array(text))
    any_control = control_pattern(controls)
    parts = F.regexp_extract_all(
        text, F.lit(rf"(?:{any_control})|(?s:.+?)(?=(?:{any_control})|\z)"), F.lit(0))
    return F.when(_has_control(text, controls), parts) \
        .when(text == "", F.array().cast("array<string>")) \
        .otherwise(F.array(text))


def pretokenize(text: Column | str) -> Column:
    """Split text into pieces; a piece keeps its leading space."""
    return F.regexp_extract_all(_col(text), F.lit(PIECE_RE), F.lit(0))


def pieces(text: Column | str, controls: list[str]) -> Column:
    """Pieces of the text in order, each control token being a piece of its own."""
    text = _col(text)
    if not controls:
        return pretokenize(text)
    cut = F.flatten(F.transform(
        split_controls(text, controls),
        lambda part: F.when(part.isin(controls), F.array(part)).otherwise(pretokenize(part))))
    return F.when(_has_control(text, controls), cut).otherwise(pretokenize(text))


def byte_count(text: Column | str, controls: list[str]) -> Column:
    """Tokens when each byte is a token and each control token counts one."""
    text = _col(text)
    if not controls:
        return F.octet_length(text)
    any_control = control_pattern(controls)
    return (F.octet_length(F.regexp_replace(text, any_control, ""))
            + F.regexp_count(text, F.lit(any_control)))


def piece_count(text: Column | str, controls: list[str]) -> Column:
    """Tokens when each piece and each control token counts one."""
    return F.size(pieces(text, controls))


def _take_runs(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[start:start + length]`` of each run, one after the other."""
    ends = np.cumsum(lengths)
    if len(ends) == 0 or ends[-1] == 0:
        return values[:0]
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1])]


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)


def _list_lengths(batch: pa.Array) -> np.ndarray:
    return pc.list_value_length(batch).to_numpy(zero_copy_only=False)


def string_bytes(flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all strings in a row, and the length of each."""
    flat = flat.cast(pa.string())
    offsets = np.frombuffer(flat.buffers()[1], dtype=np.int32)[
        flat.offset:flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, dtype=np.int32)
    data = flat.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], np.diff(offsets)


def _slices(batch: pa.Array) -> Iterator[pa.Array]:
    """A batch of lists of strings or ids in slices of at most SLICE bytes or ids, or of one row."""
    bounds = np.concatenate([[0], np.cumsum(_list_lengths(batch), dtype=np.int64)])
    flat = batch.flatten()
    if not pa.types.is_integer(flat.type) and len(flat):
        flat = flat.cast(pa.string())
        bounds = np.frombuffer(flat.buffers()[1], dtype=np.int32)[flat.offset + bounds].astype(np.int64)
    row = 0
    while row < len(batch):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + SLICE, side="right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def _by_slice(work: Callable[[pa.Array], pa.Array]) -> Callable[[pa.Array], pa.Array]:
    """``work`` on slices of a batch, so that its memory doesn't grow with the batch."""
    def run(batch: pa.Array) -> pa.Array:
        made = [work(part) for part in _slices(batch)]
        return pa.concat_arrays(made) if made else work(batch)

    return run


def _streamed(work: Callable[[pa.Array], pa.Array]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """``work`` for an Arrow UDF that hands on the result of each slice, so that no task holds that of a batch."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in _slices(batch):
                yield work(part)

    return run


def _with_controls(ids: np.ndarray, lengths: np.ndarray, at: np.ndarray, control_ids: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Replace the bytes of the strings at the given places by one control id each."""
    starts = (np.cumsum(lengths) - lengths)[at]
    ids = ids.copy()
    ids[starts] = control_ids
    keep = np.ones(len(ids), dtype=bool)
    keep[_take_runs(np.arange(len(ids)), starts + 1, lengths[at] - 1)] = False
    lengths = lengths.copy()
    lengths[at] = 1
    return ids[keep], lengths


def _byte_encoder(vocabulary: Vocabulary) -> Callable[[pa.Array], pa.Array]:
    """Ids of texts cut at control tokens, when no merge has been learned: one id per byte."""
    table = np.array(byte_ids(), dtype=np.int32)
    controls = pa.array(list(vocabulary.specials), type=pa.string())
    control_ids = np.array(list(vocabulary.specials.values()), dtype=np.int32)

    def encode(batch: pa.Array) -> pa.Array:
        flat = batch.flatten()
        raw, lengths = string_bytes(flat)
        ids = table[raw]
        which = pc.fill_null(pc.index_in(flat, controls), -1).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(which >= 0)
        if len(at):
            ids, lengths = _with_controls(ids, lengths, at, control_ids[which[at]])
        per_part = _offsets(lengths)
        per_row = _offsets(_list_lengths(batch))
        return pa.ListArray.from_arrays(pa.array(per_part[per_row]), pa.array(ids))

    return _by_slice(encode)


class _Merger:
    """Applies merges to many pieces at once: in each round every piece merges its lowest-ranked
    pair, until no piece has one left."""

    def __init__(self, vocabulary: Vocabulary):
        self.size = vocabulary.size
        merges = np.array(vocabulary.merges, dtype=np.int64).reshape(-1, 3)
        keys = merges[:, 0] * self.size + merges[:, 1]
        self.merged = merges[:, 2].astype(np.int32)
        # A merge that is a second way to write a token may enable earlier merges, so it is applied
        # one place at a time, leftmost first.
        first_rank = np.full(self.size, len(merges), dtype=np.int64)
        np.minimum.at(first_rank, self.merged, np.arange(len(merges)))
        self.again = first_rank[self.merged] < np.arange(len(merges))
        self.none = len(merges)
        self.order = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.order]
        self.dense = min(self.size, DENSE_VOCAB)
        self.table = np.full((self.dense, self.dense), self.none, dtype=np.int32)
        near = np.flatnonzero((merges[:, :2] < self.dense).all(axis=1))
        self.table[merges[near, 0], merges[near, 1]] = near

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        far = np.flatnonzero((left >= self.dense) | (right >= self.dense))
        if not len(far):
            return self.table[left, right]
        found = self.table[np.minimum(left, self.dense - 1), np.minimum(right, self.dense - 1)]
        keys = left[far].astype(np.int64) * self.size + right[far]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found[far] = np.where(self.keys[at] == keys, self.order[at], self.none)
        return found

    def __call__(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        piece = np.arange(len(lengths))
        ids = ids.astype(np.int32)
        rank = np.full(len(ids), self.none, dtype=np.int32)
        rank[:-1] = self.ranks(ids[:-1], ids[1:])
        rank[np.cumsum(lengths) - 1] = self.none
        while len(ids):
            starts = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(rank, starts)
            active = best < self.none
            if not active.all():
                inside = np.repeat(active, lengths)
                done.append((piece[~active], lengths[~active], ids[~inside]))
                ids, rank, lengths, piece, best = (
                    ids[inside], rank[inside], lengths[active], piece[active], best[active])
                if not len(ids):
                    break
                starts = np.cumsum(lengths) - lengths
            hit = rank == np.repeat(best, lengths)
            # In a run of overlapping hits every other one counts, from the left.
            if (hit[1:] & hit[:-1]).any():
                place = np.arange(len(ids))
                begins = hit & ~np.concatenate([[False], hit[:-1]])
                run = np.maximum.accumulate(np.where(begins, place, 0))
                hit &= (place - run) % 2 == 0
            if self.again[best].any():
                place = np.arange(len(ids))
                first = np.minimum.reduceat(np.where(hit, place, len(ids)), starts)
                hit &= ~np.repeat(self.again[best], lengths) | (place == np.repeat(first, lengths))
            at = np.flatnonzero(hit)
            ids[at] = self.merged[rank[at]]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            lengths = lengths - np.add.reduceat(hit, starts, dtype=lengths.dtype)
            ids, rank = ids[keep], rank[keep]
            # Only pairs beside a merge are others now.
            at -= np.arange(len(at))
            for changed in (at, at[at > 0] - 1):
                rank[changed] = self.ranks(ids[changed], ids[np.minimum(changed + 1, len(ids) - 1)])
            rank[np.cumsum(lengths) - 1] = self.none
        order = np.argsort(np.concatenate([d[0] for d in done]), kind="stable")
        sizes = np.concatenate([d[1] for d in done])
        flat = np.concatenate([d[2] for d in done])
        return _take_runs(flat, (np.cumsum(sizes) - sizes)[order], sizes[order]), sizes[order]


def _piece_encoder(vocabulary: Vocabulary) -> Callable[[pa.Array], pa.Array]:
    """Ids of texts cut into pieces; each distinct piece of a slice is encoded once, and SLICE bytes of pieces once a task."""
    controls = pa.array(list(vocabulary.specials), type=pa.string())
    control_ids = np.array(list(vocabulary.specials.values()), dtype=np.int32)
    base = np.array(byte_ids(), dtype=np.int32)
    merger = _Merger(vocabulary)
    known = pa.array([], type=pa.string())
    known_ids, known_lengths = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)

    def encode_pieces(own: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        which = pc.fill_null(pc.index_in(own, controls), -1).to_numpy(zero_copy_only=False)
        raw, lengths = string_bytes(own)
        ids, lengths = base[raw], lengths.astype(np.int64)
        at = np.flatnonzero(which >= 0)
        if len(at):
            ids, lengths = _with_controls(ids, lengths, at, control_ids[which[at]])
        return merger(ids, lengths)

    def encode(batch: pa.Array) -> pa.Array:
        nonlocal known, known_ids, known_lengths
        flat = batch.flatten().dictionary_encode()
        if len(flat) == 0:
            return pa.array([[]] * len(batch), type=pa.list_(pa.int32()))
        pieces_ = flat.dictionary.cast(pa.string())
        place = pc.fill_null(pc.index_in(pieces_, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(place < 0)
        ids, lengths = known_ids, known_lengths
        if len(new):
            place[new] = len(known) + np.arange(len(new))
            own = pieces_.take(pa.array(new))
            ids, lengths = (np.concatenate(x) for x in zip((ids, lengths), encode_pieces(own)))
            if known.nbytes + own.nbytes <= SLICE:
                known, known_ids, known_lengths = pa.concat_arrays([known, own]), ids, lengths
        codes = place[flat.indices.to_numpy(zero_copy_only=False)]
        out = _take_runs(ids, (np.cumsum(lengths) - lengths)[codes], lengths[codes])
        per_row = _offsets(_list_lengths(batch))
        return pa.ListArray.from_arrays(pa.array(_offsets(lengths[codes])[per_row]), pa.array(out))

    return _by_slice(encode)


def _encoder(text: Column | str, vocabulary: Vocabulary) -> tuple[Callable[[pa.Array], pa.Array], Column]:
    """What makes the ids of texts, and the texts cut as it takes them."""
    text = F.coalesce(_col(text), F.lit(""))
    controls = list(vocabulary.specials)
    if vocabulary.merges:
        return _piece_encoder(vocabulary), pieces(text, controls)
    return _byte_encoder(vocabulary), split_controls(text, controls)


def encode_ids(text: Column | str, vocabulary: Vocabulary) -> Column:
    """Token ids of each text; row by row, so it never shuffles."""
    encode, cut = _encoder(text, vocabulary)
    return F.arrow_udf(_streamed(encode), "array<int>")(cut)


def _decoder(vocabulary: Vocabulary, skip_special: bool) -> Callable[[pa.Array], pa.Array]:
    """UTF-8 bytes of lists of ids."""
    to_byte = {c: b for b, c in enumerate(byte_alphabet())}
    special = set(vocabulary.special_ids())
    spelled = [b"" if skip_special and i in special else
               token.encode() if i in special else bytes(to_byte[c] for c in token)
               for i, token in enumerate(vocabulary.tokens())]
    table = np.frombuffer(b"".join(spelled), dtype=np.uint8)
    widths = np.array([len(t) for t in spelled], dtype=np.int64)
    starts = np.cumsum(widths) - widths

    def decode(batch: pa.Array) -> pa.Array:
        codes = batch.flatten().to_numpy(zero_copy_only=False)
        raw = _take_runs(table, starts[codes], widths[codes])
        per_row = _offsets(_list_lengths(batch))
        offsets = _offsets(widths[codes])[per_row]
        return pa.Array.from_buffers(
            pa.binary(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])

    return _by_slice(decode)


def decode_ids(ids: Column | str, vocabulary: Vocabulary, skip_special: bool = True) -> Column:
    """Text of the ids; broken UTF-8 becomes U+FFFD."""
    ids = F.coalesce(_col(ids), F.array().cast("array<int>"))
    return F.make_valid_utf8(F.arrow_udf(_streamed(_decoder(vocabulary, skip_special)), "binary")(ids).cast("string"))


def round_trip(text: Column | str, vocabulary: Vocabulary) -> Column:
    """What the ids of each text decode to: ``decode_ids`` of ``encode_ids``, control tokens included.

    Spark runs these two one after the other in workers of their own; here a worker decodes the ids that it made.
    """
    encode, cut = _encoder(text, vocabulary)
    decode = _decoder(vocabulary, skip_special=False)
    return F.make_valid_utf8(F.arrow_udf(_streamed(lambda batch: decode(encode(batch))), "binary")(cut).cast("string"))

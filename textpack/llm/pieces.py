"""Byte-level pieces of texts and their token ids, many at a time.

The pattern of the public vocabulary splits a text into contractions, letters, digits, other
characters (each with one leading space) and white space. Here whole slices of texts are split with
array operations on code points; each distinct piece is encoded once per slice and kept in a
direct-mapped table of bounded size.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

from textpack.llm.words import buffers_of, hash_runs

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3
#: Slots of the table of known pieces, and the most ids it may hold before it starts anew.
SLOT_BITS, STORE_IDS = 20, 1 << 22
SLOTS = 1 << SLOT_BITS


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{White_Space}+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", DIGIT)):
        for run in regex.finditer(pattern, every):
            first, last = ord(run[0][0]), ord(run[0][-1])
            if first < 0xD800 <= last:
                table[first:0xD800] = table[0xE000:last + 1] = kind
            else:
                table[first:last + 1] = kind
    return table


def piece_starts(points: np.ndarray, heads: np.ndarray, atoms: np.ndarray) -> np.ndarray:
    """Where pieces start in the code points of several texts; ``heads`` has where texts start.

    ``atoms`` marks the code points of texts that stay whole, such as control tokens.
    """
    n = len(points)
    kind = classes()[points]
    space = kind == SPACE
    head = np.zeros(n + 1, dtype=bool)
    head[heads] = True
    head[n] = True
    starts = head[:n].copy()
    starts[1:] |= kind[1:] != kind[:-1]
    # The last of several white-space characters before anything else stands alone or leads it.
    last_space = space.copy()
    last_space[:-1] &= ~space[1:]
    last_space &= ~head[1:]
    starts |= last_space
    # A plain space leads what follows it.
    led = np.flatnonzero(last_space & (points == 0x20)) + 1
    starts[led] = False
    # A contraction starts where a piece starts; the letters after it start anew.
    for i in np.flatnonzero((points == 0x27) & starts):
        tail = points[i + 1:i + 3].tolist()
        inside = head[i + 1:i + 3].tolist()
        if not tail or inside[0]:
            continue
        if tail[0] in (115, 116, 109, 100):
            size = 2
        elif len(tail) == 2 and not inside[1] and tuple(tail) in ((114, 101), (118, 101), (108, 108)):
            size = 3
        else:
            continue
        starts[i + 1:i + size] = False
        if i + size < n:
            starts[i + size] |= kind[i + size] == LETTER or head[i + size]
    if atoms.any():
        starts[atoms] = head[:n][atoms]
    return np.flatnonzero(starts)


class Vocabulary:
    """Tokens as bytes, merges by rank and control tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        self.ids = {bytes(letters[c] for c in token): i
                    for token, i in content["model"]["vocab"].items()}
        self.special = {t["content"].encode(): t["id"] for t in content["added_tokens"]}
        self.merges = []
        for merge in content["model"]["merges"]:
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            left, right = (bytes(letters[c] for c in side) for side in (left, right))
            self.merges.append((self.ids[left], self.ids[right], self.ids[left + right]))
        self.size = 1 + max(*self.ids.values(), *self.special.values())
        tokens = [b""] * self.size
        for token, i in (*self.ids.items(), *self.special.items()):
            tokens[i] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.token_lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """UTF-8 bytes of the tokens, one after the other."""
        return gather(self.token_bytes, self.token_starts[ids], self.token_lengths[ids])


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[start:start + length]`` of every pair, put together."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return values[:0]
    return values[np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)]


class PieceCoder:
    """Encodes Arrow text columns with ``encode_new``, which gets each distinct unknown piece."""

    def __init__(self, vocabulary: Vocabulary,
                 encode_new: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.vocabulary, self.encode_new = vocabulary, encode_new
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("|".join(regex.escape(s.decode()) for s in special)) if special else None
        self.renew()

    def renew(self) -> None:
        self.slot_hash = np.zeros(SLOTS, dtype=np.uint64)
        self.slot_start = np.zeros(SLOTS, dtype=np.int32)
        self.slot_length = np.zeros(SLOTS, dtype=np.int32)
        self.store = np.zeros(1 << 16, dtype=np.int32)
        self.stored = 0

    def keep(self, ids: np.ndarray) -> int:
        """Append ids to the store; where they start."""
        start = self.stored
        while start + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[start:start + len(ids)] = ids
        self.stored += len(ids)
        return start

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and how many each row has.

        The ids are decoded again and compared with the text, so that two pieces of the same hash
        can't pass for each other; a slice that differs is encoded row by row without the table.
        """
        ids, counts = self._encode(column)
        raw, _ = buffers_of(column)
        if not np.array_equal(self.vocabulary.decode(ids), raw):
            ids, counts = self._encode(column, exact=True)
        return ids, counts

    def _encode(self, column: pa.Array, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        raw, bounds = buffers_of(column)
        text = raw.tobytes().decode()
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        if not len(points):
            return np.zeros(0, dtype=np.int32), np.zeros(len(column), dtype=np.int64)
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        at = np.zeros(len(points) + 1, dtype=np.int64)
        np.cumsum(width, out=at[1:])
        rows = np.searchsorted(at, bounds)
        heads = rows[:-1][rows[:-1] < rows[1:]]
        atoms = np.zeros(len(points), dtype=bool)
        if self.special and any(s in text for s in map(bytes.decode, self.vocabulary.special)):
            cuts = [(m.start() + rows[k], m.end() + rows[k])
                    for k in range(len(column)) if rows[k] < rows[k + 1]
                    for m in self.special.finditer(text[rows[k]:rows[k + 1]])]
            for a, b in cuts:
                atoms[a:b] = True
            heads = np.unique(np.append(heads, [x for x in np.ravel(cuts) if x < len(points)])) if cuts else heads
            heads = heads.astype(np.int64)
        starts = piece_starts(points, heads, atoms)
        lengths = np.diff(np.append(starts, len(points)))
        first_piece = np.searchsorted(starts, rows)
        if exact:
            parts = self._encode_all([text[s:s + n].encode() for s, n in zip(starts, lengths)])
            flat, sizes = parts
        else:
            hashes = hash_runs(points, starts, lengths)
            if self.stored > STORE_IDS:
                self.renew()
            slot = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            missing = np.flatnonzero(self.slot_hash[slot] != hashes)
            spot, sizes = self.slot_start[slot], self.slot_length[slot]
            if len(missing):
                _, example, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
                example = missing[example]
                new = [text[s:s + n].encode() for s, n in zip(starts[example].tolist(), lengths[example].tolist())]
                made, made_sizes = self._encode_all(new)
                begin = self.keep(made) + np.cumsum(made_sizes) - made_sizes
                spot[missing], sizes[missing] = begin[which], made_sizes[which]
                self.slot_hash[slot[example]] = hashes[example]
                self.slot_start[slot[example]], self.slot_length[slot[example]] = begin, made_sizes
            flat = gather(self.store, spot, sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return flat, np.diff(ends[first_piece])

    def _encode_all(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        special = self.vocabulary.special
        if not any(p in special for p in new):
            return self.encode_new(new)
        parts = [(np.array([special[p]], dtype=np.int32), 1) if p in special
                 else (lambda made: (made[0], len(made[0])))(self.encode_new([p])) for p in new]
        return np.concatenate([p for p, _ in parts]), np.array([n for _, n in parts])

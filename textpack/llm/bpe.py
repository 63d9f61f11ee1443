"""BPE encoding by speculation and verification, and decoding.

A piece is first cut greedily into the longest tokens. Such a cut is what merging gives if every
token is what merging gives for its own bytes and no merge would ever cross a border between two
neighbours. The second is checked for all distinct neighbours at once: while a token is put together, its
outermost symbol changes; a border breaks if some outer symbol of the left token and some outer
symbol of the right token form a merge that comes before either of them is merged inwards. Only
pieces with a broken border are merged exactly.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textpack.llm.pieces import PieceCoder, Vocabulary, gather
from textpack.llm.words import schema_with, slices

NEVER = np.int64(1 << 40)
#: Slots of the table of neighbours already checked.
PAIR_SLOTS = 1 << 18
#: Bytes of the longest piece that is merged in step with others; a longer one has a queue of its own.
TOGETHER = 48
#: Bytes of the longest piece that is cut by speculation; longer ones, which are rare, are merged exactly.
ALONE = 256


class SpeculativeEncoder:
    """Ids of pieces under the merges of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        size = vocabulary.size
        self.rank = {(a, b): (i, c) for i, (a, b, c) in enumerate(vocabulary.merges)}
        self.byte_id = np.array([vocabulary.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        table = np.array(vocabulary.merges, dtype=np.int64).reshape(-1, 3)
        self.left, self.right = (np.full(size, -1, dtype=np.int64) for _ in range(2))
        self.born = np.full(size, -1, dtype=np.int64)
        self.left[table[:, 2]], self.right[table[:, 2]] = table[:, 0], table[:, 1]
        self.born[table[:, 2]] = np.arange(len(table))
        order = np.argsort(table[:, 0] * size + table[:, 1])
        self.pair_keys = (table[:, 0] * size + table[:, 1])[order]
        self.pair_ranks = order.astype(np.int64)
        self.size = size
        self.pair_slot = np.full(PAIR_SLOTS, -1, dtype=np.int64)
        self.pair_fits = np.zeros(PAIR_SLOTS, dtype=bool)
        # A token may be proposed only if merging its own bytes gives it.
        stable = np.ones(size, dtype=bool)
        merged = table[:, 2]
        stable[merged] = self.unbroken(table[:, 0], table[:, 1], self.born[merged])
        for a, b, c in vocabulary.merges:  # by rank, so parts come before what they make
            stable[c] &= stable[a] and stable[b]
        self.edges, self.edge_to, self.node_token = prefix_tree(
            {token: i for token, i in vocabulary.ids.items() if stable[i]})
        self.made = table[:, 2].copy()

    def unbroken(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | np.int64 = NEVER) -> np.ndarray:
        """Whether no merge of a rank under ``before`` crosses the border of each pair."""
        broken = np.zeros(len(a), dtype=bool)
        x, x_until = a, np.full(len(a), NEVER)
        while len(a) and (x >= 0).any():
            y, y_until = b, np.full(len(b), NEVER)
            while (y >= 0).any():
                rank = self.ranks(x, y)
                # Of two equal merges the left one is made first.
                broken |= (rank < x_until) & (rank <= y_until) & (rank < before)
                y_until, y = np.where(y >= 0, self.born[y], -1), np.where(y >= 0, self.left[y], -1)
            x_until, x = np.where(x >= 0, self.born[x], -1), np.where(x >= 0, self.right[x], -1)
        return ~broken

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether neighbours keep their border, from the table of known ones where possible."""
        key = a * self.size + b
        slot = (key * 0x9E3779B1 >> 7) & (PAIR_SLOTS - 1)
        fits = self.pair_fits[slot]
        unknown = np.flatnonzero(self.pair_slot[slot] != key)
        if len(unknown):
            new, which = np.unique(key[unknown], return_inverse=True)
            found = self.unbroken(new // self.size, new % self.size)
            fits[unknown] = found[which]
            self.pair_slot[slot[unknown]] = key[unknown]
            self.pair_fits[slot[unknown]] = fits[unknown]
        return fits

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or NEVER; symbols under 0 stand for none."""
        key = np.where((a >= 0) & (b >= 0), a * self.size + b, -1)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def propose(self, data: np.ndarray, ends: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token at each position of the pieces: ids in order, and the piece of each."""
        at = np.concatenate([[0], ends[:-1]])[piece]
        tokens, owners = [piece[:0]], [piece[:0]]
        while len(piece):
            node = np.zeros(len(piece), dtype=np.int64)
            best, size = np.full(len(piece), -1, dtype=np.int64), np.zeros(len(piece), dtype=np.int64)
            going, depth = np.arange(len(piece)), 0
            while len(going):
                going = going[at[going] + depth < ends[piece[going]]]
                edge = (node[going] << 8) | data[at[going] + depth]
                found = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
                hit = self.edges[found] == edge
                going, found = going[hit], found[hit]
                depth += 1
                node[going] = self.edge_to[found]
                token = self.node_token[node[going]]
                named = token >= 0
                best[going[named]], size[going[named]] = token[named], depth
            tokens.append(best)
            owners.append(piece)
            at = at + size
            left = at < ends[piece]
            at, piece = at[left], piece[left]
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        order = np.argsort(owner, kind="stable")
        return token[order], owner[order]

    def merge_many(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exact merges of several short pieces, one merge of each at a time."""
        symbol = self.byte_id[data]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        out_symbols, out_owners = [], []
        rank = np.full(len(symbol), NEVER)
        rank[:-1] = np.where(owner[:-1] == owner[1:], self.ranks(symbol[:-1], symbol[1:]), NEVER)
        while len(symbol):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(symbol)))
            done = np.repeat(lowest == NEVER, counts)
            if done.any():
                out_symbols.append(symbol[done])
                out_owners.append(owner[done])
                symbol, owner, rank = symbol[~done], owner[~done], rank[~done]
                counts, lowest = counts[lowest < NEVER], lowest[lowest < NEVER]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, counts))
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]
            symbol[at] = self.made[rank[at]]
            keep = np.ones(len(symbol), dtype=bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            for i in (at, at[at > 0] - 1):
                j = np.minimum(i + 1, len(symbol) - 1)
                joined = (owner[i] == owner[j]) & (i < j)
                rank[i] = np.where(joined, self.ranks(symbol[i], symbol[j]), NEVER)
        symbol, owner = np.concatenate(out_symbols), np.concatenate(out_owners)
        return symbol[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(sizes))

    def merge(self, piece: bytes) -> list[int]:
        """The exact merges of one piece, lowest rank first and leftmost among equals."""
        symbols = self.byte_id[list(piece)].tolist()
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        rank = self.rank
        heap = [(r[0], i, symbols[i], symbols[i + 1]) for i in range(n - 1)
                if (r := rank.get((symbols[i], symbols[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i] = rank[a, b][1]
            alive[j] = False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if r := rank.get((symbols[i], symbols[k])):
                    heapq.heappush(heap, (r[0], i, symbols[i], symbols[k]))
            if (h := before[i]) >= 0 and (r := rank.get((symbols[h], symbols[i]))):
                heapq.heappush(heap, (r[0], h, symbols[h], symbols[i]))
        return [s for s, live in zip(symbols, alive) if live]

    def encode_new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and the number of ids of each."""
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        ends = np.cumsum(lengths)
        wrong = lengths > ALONE
        token, owner = self.propose(data, ends, np.flatnonzero(~wrong))
        border = np.flatnonzero(owner[:-1] == owner[1:])
        wrong[owner[border[~self.fits(token[border], token[border + 1])]]] = True
        short = np.flatnonzero(wrong & (lengths <= TOGETHER))
        parts = [(token[~wrong[owner]], owner[~wrong[owner]])]
        if len(short):
            made, sizes = self.merge_many(gather(data, (ends - lengths)[short], lengths[short]), lengths[short])
            parts.append((made, np.repeat(short, sizes)))
        for k in np.flatnonzero(wrong & (lengths > TOGETHER)).tolist():
            made = np.array(self.merge(pieces[k]), dtype=np.int64)
            parts.append((made, np.full(len(made), k)))
        token, owner = (np.concatenate(side) for side in zip(*parts))
        order = np.argsort(owner, kind="stable")
        return token[order].astype(np.int32), np.bincount(owner, minlength=len(pieces))


def prefix_tree(tokens: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted edges ``node * 256 + byte``, the node each leads to, and the token of each node or -1."""
    edges: dict[int, int] = {}
    named = [-1]
    for token, i in tokens.items():
        node = 0
        for byte in token:
            edge = node << 8 | byte
            if edge not in edges:
                edges[edge] = len(named)
                named.append(-1)
            node = edges[edge]
        named[node] = i
    keys, nodes = np.array(list(edges)), np.array(list(edges.values()))
    order = np.argsort(keys)
    return keys[order], nodes[order], np.array(named)


_coders: dict[str, PieceCoder] = {}


def coder(path: str) -> PieceCoder:
    """The encoder of a tokenizer file, built once in each Python worker."""
    if path not in _coders:
        vocabulary = Vocabulary(path)
        _coders[path] = PieceCoder(vocabulary, SpeculativeEncoder(vocabulary).encode_new)
    return _coders[path]


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of each text as ``(key, ids)``; a null or empty text has no ids.

    ``tokenizer`` is the path of a byte-level BPE file in the public JSON format that every
    executor can read. Rows keep their order within a partition; repeated rows are encoded each.
    Strings of control tokens in a text become those tokens, as with the public library.
    """
    schema = schema_with(docs.select(key), "ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokenizer)
        for batch in batches:
            for start, end in slices(batch.column(1)):
                ids, counts = own.encode(batch.column(1).slice(start, end - start))
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), lists], names=[key, "ids"])

    return docs.select(key, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of token ids as ``(key, text)``; bytes that aren't UTF-8 become U+FFFD."""
    schema = schema_with(encoded.select(key), "text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = coder(tokenizer).vocabulary
        for batch in batches:
            texts = [None if row is None else
                     vocabulary.decode(np.array(row, dtype=np.int64)).tobytes().decode(errors="replace")
                     for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return encoded.select(key, ids).mapInArrow(run, schema)


def comma_joined(vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal spelling of every id with a comma after it: bytes, starts and lengths."""
    spelled = [f"{i},".encode() for i in range(vocabulary.size)]
    lengths = np.array([len(s) for s in spelled], dtype=np.int64)
    return np.frombuffer(b"".join(spelled), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


def digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode each text, and return digests of both: ``n_tokens, ids_sha256,
    decoded_sha256``. Ids never leave the task, so the result is small whatever the texts are."""
    schema = schema_with(docs.select(key), "n_tokens bigint, ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokenizer)
        digits, digit_starts, digit_lengths = comma_joined(own.vocabulary)
        token_lengths = own.vocabulary.token_lengths
        for batch in batches:
            for start, end in slices(batch.column(1)):
                ids, counts = own.encode(batch.column(1).slice(start, end - start))
                decoded = own.vocabulary.decode(ids)
                spelled = gather(digits, digit_starts[ids], digit_lengths[ids])
                bounds = np.concatenate([[0], np.cumsum(counts)])
                text_at = np.concatenate([[0], np.cumsum(token_lengths[ids])])[bounds]
                spelled_at = np.concatenate([[0], np.cumsum(digit_lengths[ids])])[bounds]
                of_ids = [hashlib.sha256(spelled[a:max(a, b - 1)]).hexdigest()
                          for a, b in zip(spelled_at[:-1], spelled_at[1:])]
                # A text is valid UTF-8, and its tokens are its bytes again.
                of_text = [hashlib.sha256(decoded[a:b]).hexdigest()
                           for a, b in zip(text_at[:-1], text_at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(counts, pa.int64()),
                     pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)

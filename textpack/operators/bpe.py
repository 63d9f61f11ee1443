"""Learning a byte-level vocabulary from the table of distinct pieces.

Each merge depends on the counts that the last one left behind, so learning one merge per job takes thousands of jobs, and
recounting all pairs for each is the whole corpus every time. Here the driver proposes a run of merges, guessed
from the most frequent pieces. One job makes them on all pieces and returns what each does to the counts of
pairs, from those pieces alone that hold it. With these exact changes the driver replays the run and accepts merges for as long as the
most frequent pair of the whole corpus is among them. A wrong guess costs a shorter run, never another result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.constants import BASE_VOCAB_SIZE, MAX_VOCAB_SIZE, SYMBOL_BASE
from textpack.functions.tokens import byte_symbols, pretokenize, string_bytes
from textpack.operators.speculation import Predictor, Replay, Step
from textpack.operators.vocabulary import Vocabulary
from textpack.session import buckets, materialize

# Pairs whose exact counts the driver follows, merges proposed per round, and pieces that proposals are drawn
# from. They set how long a round's proposal holds, never what is learned.
TOP_PAIRS = 20_000
PROPOSED = 512
SAMPLE_PIECES = 100_000
# The piece table is rewritten after this many merges.
REWRITE_EVERY = 512


def piece_counts(rows: DataFrame, text: str = "text") -> DataFrame:
    """Distinct pieces with their frequency; counted map-side before the shuffle."""
    return rows.select(F.explode(pretokenize(text)).alias("piece")).groupBy("piece").agg(
        F.count(F.lit(1)).alias("n"))


def with_symbols(counts: DataFrame) -> DataFrame:
    return counts.select("piece", "n", byte_symbols("piece").alias("symbols"))


def symbol_pair_counts(symbols: DataFrame) -> DataFrame:
    """Frequency of each two neighbouring symbols, weighted by the piece counts, as (pair, n).

    A symbol is four bytes of UTF-8, so a pair is cut out of the bytes at a known place; the whole
    step up to the map-side counts is one generated stage.
    """
    width = len(chr(SYMBOL_BASE).encode("utf-8"))
    raw = F.col("symbols").cast("binary")
    places = F.sequence(F.lit(0), F.char_length("symbols") - 2)
    return symbols.where(F.char_length("symbols") > 1).select(
        raw.alias("raw"), "n", F.explode(places).alias("i")
    ).groupBy(F.substring("raw", F.col("i") * width + 1, F.lit(2 * width)).alias("pair")).agg(
        F.sum("n").alias("n")).select(F.col("pair").cast("string").alias("pair"), "n")


def pair_counts(symbols: DataFrame) -> DataFrame:
    """Frequency of each neighbouring pair as (lhs, rhs, n), with token ids."""
    return symbol_pair_counts(symbols).select(
        (F.ascii(F.substring("pair", 1, 1)) - SYMBOL_BASE).alias("lhs"),
        (F.ascii(F.substring("pair", 2, 1)) - SYMBOL_BASE).alias("rhs"), "n")


def in_runs(merges: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The merges in runs in which no token is made that an earlier merge of the run knows.

    What a merge of such a run makes can only be merged by later ones, so making the run one merge after the other on all
    pieces is the same as giving each piece its first one until it has none.
    """
    runs: list[list[tuple[int, int, int]]] = []
    known: set[int] = set()
    for merge in merges:
        if not runs or merge[2] in known:
            runs.append([])
            known = set()
        runs[-1].append(merge)
        known.update(merge)
    return runs


class _Run:
    """A run of merges, looked up by the key of their pair."""

    def __init__(self, merges: list[tuple[int, int, int]]):
        table = np.array(merges, dtype=np.int64).reshape(-1, 3)
        self.keys, self.order = np.unique(table[:, 0] * MAX_VOCAB_SIZE + table[:, 1], return_index=True)
        self.merged = table[:, 2]
        self.starts = np.zeros(MAX_VOCAB_SIZE, dtype=bool)
        self.starts[table[:, 0]] = True

    def ranks(self, symbols: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Which merge each symbol starts with the next, if that is ``inside`` the piece; their number if none."""
        found = np.full(len(symbols), len(self.merged), dtype=np.int64)
        at = np.flatnonzero(self.starts[symbols[:-1]] & inside)
        pair = symbols[at] * MAX_VOCAB_SIZE + symbols[at + 1]
        place = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        known = self.keys[place] == pair
        found[at[known]] = self.order[place[known]]
        return found


def _symbols_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all symbol strings in a row, and how many each has. A symbol is four bytes of UTF-8."""
    raw, lengths = string_bytes(column)
    b = raw.reshape(-1, 4).astype(np.int64)
    return ((b[:, 0] & 7) << 18 | (b[:, 1] & 63) << 12 | (b[:, 2] & 63) << 6 | b[:, 3] & 63) - SYMBOL_BASE, lengths // 4


def _symbol_strings(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The symbol strings of token ids in a row."""
    points = ids + SYMBOL_BASE
    raw = np.stack([points >> 18 | 0xF0, points >> 12 & 63 | 0x80, points >> 6 & 63 | 0x80, points & 63 | 0x80], axis=1)
    offsets = np.append(0, np.cumsum(lengths) * 4).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(raw.astype(np.uint8).tobytes()))


class _Pieces:
    """Symbols of many pieces in one array, changed run by run of merges."""

    def __init__(self, batch: pa.RecordBatch):
        self.symbols, lengths = _symbols_of(batch.column(0))
        self.owner = np.repeat(np.arange(len(lengths)), lengths)
        self.n = batch.column(1).to_numpy()

    def merge(self, run: _Run, changes: list[tuple[np.ndarray, np.ndarray]] | None = None) -> None:
        """Give every piece the first merge of the run that it has, of overlapping places every other one from the left, until
        it has none. ``changes`` receives (key of merge and pair, by how much the pair's count changes)."""
        none = len(run.merged)
        symbols, owner = self.symbols, self.owner
        done = []
        while len(symbols):
            inside = owner[1:] == owner[:-1]
            rank = run.ranks(symbols, inside)
            starts = np.flatnonzero(np.concatenate([[True], ~inside]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.repeat(best, sizes)
            active = best < none
            done.append((symbols[~active], owner[~active]))
            symbols, owner, rank, best = symbols[active], owner[active], rank[active], best[active]
            if not len(symbols):
                break
            hit = rank == best
            place = np.arange(len(symbols))
            begins = hit & ~np.concatenate([[False], hit[:-1]])
            hit &= (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0
            second = np.concatenate([[False], hit[:-1]])
            if changes is not None:
                changes.append(self.pairs_at(hit | second, symbols, owner, best, -1))
            symbols = np.where(hit, run.merged[best], symbols)[~second]
            owner, best, hit = owner[~second], best[~second], hit[~second]
            if changes is not None:
                changes.append(self.pairs_at(hit, symbols, owner, best, 1))
        self.symbols = np.concatenate([d[0] for d in done]) if done else symbols
        self.owner = np.concatenate([d[1] for d in done]) if done else owner

    def pairs_at(self, touched: np.ndarray, symbols: np.ndarray, owner: np.ndarray, merge: np.ndarray, sign: int
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Keys of merge and pair where one of the two neighbours is touched, and their counts."""
        at = np.flatnonzero((touched[:-1] | touched[1:]) & (owner[:-1] == owner[1:]))
        return (merge[at] * MAX_VOCAB_SIZE ** 2 + symbols[at] * MAX_VOCAB_SIZE + symbols[at + 1], sign * self.n[owner[at]])

    def texts(self) -> pa.Array:
        order = np.argsort(self.owner, kind="stable")
        return _symbol_strings(self.symbols[order], np.bincount(self.owner, minlength=len(self.n)))


def _summed(changes: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its changes, if that is not zero."""
    keys, by = (np.concatenate(c) for c in zip(*changes))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    total = np.add.reduceat(by[order], first) if len(keys) else by
    return keys[first][total != 0], total[total != 0]


def count_changes(state: DataFrame, pending: list[tuple[int, int, int]], steps: list[Step]) -> DataFrame:
    """What each of the steps, made one after the other, changes: (step, pair, change), summed over all pieces.

    ``state`` holds (symbols, n); ``pending`` are merges that it hasn't gone through yet. Each run of merges is made
    at once, so a task's work doesn't grow with their number.
    """
    before = [_Run(run) for run in in_runs(pending)]
    now = [_Run(run) for run in in_runs([(s.a, s.b, s.merged) for s in steps])]
    first = np.cumsum([0] + [len(run.merged) for run in now]).tolist()
    most = 1 << 20

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        changes: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            pieces = _Pieces(batch)
            for run in before:
                pieces.merge(run)
            for run, shift in zip(now, first):
                made: list[tuple[np.ndarray, np.ndarray]] = []
                pieces.merge(run, made)
                changes += [(key + shift * MAX_VOCAB_SIZE ** 2, by) for key, by in made]
            if sum(len(key) for key, _ in changes) > most:
                changes = [_summed(changes)]
        if changes:
            key, change = _summed(changes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key // MAX_VOCAB_SIZE ** 2, pa.int32()), pa.array(key % MAX_VOCAB_SIZE ** 2), pa.array(change)],
                names=["step", "pair", "change"])

    made = state.mapInArrow(run_all, "step int, pair long, change long")
    return made.groupBy("step", "pair").agg(F.sum("change").alias("change")).where("change <> 0")


def merged_pieces(state: DataFrame, merges: list[tuple[int, int, int]]) -> DataFrame:
    """Pieces (symbols, n) after the merges; those that became one symbol have no pair left and go. Different pieces never
    become alike, as a token is written in one way."""
    runs = [_Run(run) for run in in_runs(merges)]

    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = _Pieces(batch)
            for run in runs:
                pieces.merge(run)
            yield pa.RecordBatch.from_arrays([pieces.texts(), batch.column(1)], names=["symbols", "n"])

    return state.mapInArrow(run_all, "symbols string, n long").where(F.char_length("symbols") > 1)


def sampled_pieces(state: DataFrame, size: int) -> tuple[pa.Array, np.ndarray]:
    """At most ``size`` pieces and their weights, whose sums over any pieces are those of all counts on average.

    Priority sampling: pieces are taken by count over a hash of their own in (0, 1], and those whose count lies
    under the smallest priority taken weigh as much as that.
    """
    part = (F.xxhash64("symbols").bitwiseAND(F.lit((1 << 52) - 1)) + 1) / F.lit(float(1 << 52))
    taken = state.select("symbols", "n", (F.col("n") / part).alias("priority")).orderBy(
        F.desc("priority"), "symbols").limit(size).toArrow()
    weights = taken.column("n").to_numpy().astype(np.float64)
    if 0 < len(weights) == size:
        weights = np.maximum(weights, taken.column("priority").to_numpy().min())
    return taken.column("symbols").combine_chunks(), weights


def _ids(symbols: str) -> list[int]:
    return [ord(c) - SYMBOL_BASE for c in symbols]


def train_vocabulary(counts: DataFrame, vocab_size: int = BASE_VOCAB_SIZE, rounds: list[int] | None = None) -> Vocabulary:
    """Learn merges from (piece, n) until ``vocab_size`` tokens exist or no pair is left.

    The most frequent pair is merged first, ties going to the smallest (left id, right id). The driver holds at most TOP_PAIRS
    counts read, of those that come with merges the leading ones, SAMPLE_PIECES pieces and the changes that PROPOSED merges make to pairs of tokens; the piece
    table stays distributed, and the current state is a written table that survives the loss of executors.
    ``rounds`` receives the number of merges accepted in each round.
    """
    vocabulary = Vocabulary()
    tokens = vocabulary.tokens()
    written = {token: i for i, token in enumerate(tokens)}
    merges: list[tuple[int, int, int]] = []
    pending: list[tuple[int, int, int]] = []
    # Every round reads the state again, so it is dealt to files for all cores.
    files = max(buckets(counts.sparkSession), 2 * counts.sparkSession.sparkContext.defaultParallelism)
    state = with_symbols(counts).where(F.char_length("symbols") > 1).select("symbols", "n")
    state = materialize(state.repartition(files, "symbols"), "pieces")
    sample, weights = sampled_pieces(state, SAMPLE_PIECES)
    predictor = Predictor(*_symbols_of(sample), weights)
    del sample, weights
    replay = None
    while len(tokens) < vocab_size:
        if replay is None:
            if pending:
                state, pending = materialize(merged_pieces(state, pending), "pieces"), []
            top = symbol_pair_counts(state).orderBy(F.desc("n"), "pair").limit(TOP_PAIRS).collect()
            if not top:
                break
            floor = top[-1]["n"] if len(top) == TOP_PAIRS else 0
            replay = Replay({tuple(_ids(r["pair"])): r["n"] for r in top}, floor)
        steps = predictor.propose(replay.counts, replay.floor, tokens, written, min(PROPOSED, vocab_size - len(tokens)))
        if not steps:  # what is left lies under the floor
            replay = None
            continue
        found = count_changes(state, pending, steps).toArrow()
        accepted, complete = replay.accept(steps, found, tokens, written)
        merges.extend(accepted)
        pending.extend(accepted)
        predictor.merge(accepted)
        predictor.tell(steps, replay.left, tokens)
        replay.left = []
        if rounds is not None:
            rounds.append(len(accepted))
        if not complete:
            replay = None
        elif len(pending) >= REWRITE_EVERY:
            state, pending = materialize(merged_pieces(state, pending), "pieces"), []
    return Vocabulary(tuple(merges))

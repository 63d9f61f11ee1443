"""Benchmark decontamination by a random-walk embedding of edit distance.

The CGK embedding walks over a word sequence: at step j it writes the word it stands on, and a random
bit drawn for (step, word) decides whether it moves on. Sequences of few edits walk together
for most steps, so their edit distance becomes a small Hamming distance. Bit sampling takes a few steps of the
embedding as a key; repetitions with fresh walks and steps raise the recall to a stated target, and
every hit is verified by exact edit distance.

Windows have the size of the items: an item of m words, up to e of them edited, is embedded through all its windows of the
largest power of two up to m - e (64 at most), so that some window is left whatever the edits are, and texts through all windows of the
same sizes. Each window size has repetitions of its own, until edited items of every length that it serves, drawn from all of
them and set in other words, are found. Windows of a text are embedded
together, and a key is compared step by step, so most windows are done after the first step sampled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textpack.llm.words import buffers_of, by_slice, hash_runs, mix, schema_with, slices, word_spans

#: Words of items that one pass over the texts holds; a larger benchmark takes several passes.
PASS_WORDS = 2_000_000
#: Steps in a key, share of edited words of an item, recall aimed at, most repetitions tried.
SAMPLED, MAX_EDIT_SHARE, RECALL, MOST_REPETITIONS = 3, 0.15, 0.95, 32
#: Trials that recall is measured on for items of about one size, and words that a trial lies between.
TRIALS, AROUND = 200, 80
LONGEST_WINDOW = 64
_FILTER_BITS = 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def folded_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words with A-Z lower-cased, and the number of the first word of each row."""
    raw, bounds = buffers_of(column)
    starts, lengths, first = word_spans(raw, bounds)
    return hash_runs(_LOWER[raw], starts, lengths), first


def window_size(m: int, edits: int) -> int:
    """Of an item of ``m`` words; with that many edits at least one window of it stays within a text."""
    return min(LONGEST_WINDOW, 1 << ((m - edits).bit_length() - 1))


class Repetition:
    """Keys of all windows of one size of some items under one walk."""

    def __init__(self, items: list[np.ndarray], chosen: list[int], c: int, number: int, sampled: int):
        self.c = c
        self.seeds = mix(np.arange(1, 4, dtype=np.uint64) + np.uint64(1000 * number + 1))
        random = np.random.default_rng([number, c, sampled])
        # The first step is an early one, so that most windows are done after few steps; the
        # others are drawn from equal shares of the rest.
        shares = np.linspace(min(4, c), 2 * c, sampled).astype(int)
        self.steps = [int(random.integers(shares[0])), *(int(random.integers(a, max(b, a + 1))) for a, b in zip(shares[:-1], shares[1:]))]
        sizes = np.array([len(items[k]) for k in chosen])
        words = np.concatenate([items[k] for k in chosen])
        windows = sizes - c + 1
        item = np.repeat(np.array(chosen), windows)
        offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        starts = offset + np.repeat(np.cumsum(sizes) - sizes, windows)
        keys, at, walked = None, starts, 0
        self.filters = []
        bits = self.bits(words, 2 * c)
        for step in self.steps:
            at = self.walk(bits, at, starts, c, walked, step)
            keys = self.extend(keys, words, at)
            walked = step
            known = np.zeros(1 << _FILTER_BITS, dtype=bool)
            known[keys >> np.uint64(64 - _FILTER_BITS)] = True
            self.filters.append(known)
        order = np.argsort(keys, kind="stable")
        self.keys, self.items, self.offsets = keys[order], item[order], offset[order]

    def bits(self, words: np.ndarray, steps: int) -> list[np.ndarray]:
        """Random bits of each word for steps 0 to 63, 64 to 127, ..."""
        return [mix(words ^ seed) for seed in self.seeds[:-(-steps // 64)]]

    @staticmethod
    def walk(bits: list[np.ndarray], at: np.ndarray, starts: np.ndarray, c: int, first: int, last: int) -> np.ndarray:
        """Positions after steps ``first`` to ``last - 1`` of walks that end where their window ends."""
        limit = starts + c - 1
        for step in range(first, last):
            move = (bits[step >> 6][at] >> np.uint64(step & 63)) & np.uint64(1)
            at = at + move.astype(np.int64)
            if step + 1 >= c:
                at = np.minimum(at, limit)
        return at

    @staticmethod
    def extend(keys: np.ndarray | None, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Keys with the word that each walk stands on put in."""
        return words[at] if keys is None else mix(keys * np.uint64(0x9E3779B97F4A7C15) + words[at])

    def hits(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of all windows (given by their starts) of equal keys: the start, the start minus the offset in the item, the item."""
        bits = self.bits(words, 2 * self.c)
        at, made, walked = starts, None, 0
        for step, known in zip(self.steps, self.filters):
            at = self.walk(bits, at, starts, self.c, walked, step)
            made, walked = self.extend(made, words, at), step
            left = np.flatnonzero(known[made >> np.uint64(64 - _FILTER_BITS)])
            at, made, starts = at[left], made[left], starts[left]
        low, high = np.searchsorted(self.keys, made), np.searchsorted(self.keys, made, side="right")
        counts = high - low
        which = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(starts, counts)
        return starts, starts - self.offsets[which], self.items[which]


def windows_of(first: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Starts of the windows of each size that lie within one row."""
    lengths, made = np.diff(first), {}
    for c in sizes:
        fits = np.maximum(lengths - c + 1, 0)
        ends = np.cumsum(fits)
        made[c] = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[:-1] - (ends - fits), fits)
    return made


def best_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """Fewest edits that turn ``item`` into some stretch of ``text``, and the end of the first such stretch."""
    m = len(item)
    places: dict[int, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, word in enumerate(text, 1):
        equal = places.get(word, 0)
        across = (((equal & up) + up) ^ up) | equal
        rise, fall = (down | ~(across | up)) & full, up & across
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        reach = equal | down
        up, down = (fall | ~(reach | rise)) & full, rise & reach
        if score < best:
            best, end = score, j
    return best, end


class Searcher:
    """Finds items in texts, with as many repetitions of each window size as the target recall takes.

    Where MOST_REPETITIONS don't reach it, keys of fewer steps do, at the cost of more candidates to verify. ``recall`` has the
    share of trials found, by window size, of the length that is found least.
    """

    def __init__(self, items: list[np.ndarray], share: float, recall: float, sampled: int):
        self.items, self.share = items, share
        self.lists = [w.tolist() for w in items]
        self.edits = [int(len(w) * share) for w in items]
        by_size: dict[int, list[int]] = {}
        for k, words in enumerate(items):
            by_size.setdefault(window_size(len(words), self.edits[k]), []).append(k)
        self.sizes = sorted(by_size)
        self.repetitions: list[Repetition] = []
        self.recall: dict[int, float] = {}
        for c in self.sizes:
            trials = self.edited(c, by_size[c], np.random.default_rng([7, c]))
            total = Counter(length for length, *_ in trials)
            for steps in range(min(sampled, 2 * c), 0, -1):
                made, missed = [], trials
                while len(made) < MOST_REPETITIONS and (not made or self.worst(missed, total) < recall):
                    made.append(Repetition(items, by_size[c], c, len(made), steps))
                    missed = [(length, k, words) for length, k, words in missed if not any(
                        item == k for _, item, *_ in self.find(words, np.array([0, len(words)]), made[-1:]))]
                self.recall[c] = self.worst(missed, total)
                if self.recall[c] >= recall:
                    break
            self.repetitions += made

    @staticmethod
    def worst(missed: list[tuple], total: Counter) -> float:
        """Least share of trials found among lengths."""
        left = Counter(length for length, *_ in missed)
        return min(1 - left[length] / n for length, n in total.items())

    def edited(self, c: int, chosen: list[int], random: np.random.Generator) -> list[tuple[int, int, np.ndarray]]:
        """Trials: length in eighths of a window, item, and its words with as many random edits as are still to be found, between
        other words. Each length has its trials, spread evenly over its items."""
        by_length: dict[int, list[int]] = {}
        for k in chosen:
            by_length.setdefault(min(8 * len(self.lists[k]) // c, 24), []).append(k)
        made = []
        for length, own in sorted(by_length.items()):
            for trial in range(TRIALS):
                k = own[trial * len(own) // TRIALS if len(own) > TRIALS else trial % len(own)]
                words = self.lists[k][:]
                for _ in range(self.edits[k]):
                    kind, at = int(random.integers(3)), int(random.integers(len(words)))
                    fresh = int(random.integers(1 << 62))
                    words[at:at + (kind != 1)] = [] if kind == 2 and len(words) > 1 else [fresh]
                before, after = random.integers(1 << 62, size=(2, AROUND), dtype=np.uint64)
                made.append((length, k, np.concatenate([before, np.array(words, dtype=np.uint64), after])))
        return made

    def find(self, words: np.ndarray, first: np.ndarray,
             repetitions: list[Repetition] | None = None) -> list[tuple[int, int, int, int, int]]:
        """``(row, item, start, end, edits)`` of the best stretch of each row and item, word numbers in the row."""
        used = repetitions or self.repetitions
        windows = windows_of(first, sorted({r.c for r in used}))
        found = [r.hits(words, windows[r.c]) for r in used if len(windows[r.c])]
        if not found:
            return []
        starts, diagonal, item = (np.concatenate(side) for side in zip(*found))
        rows = np.searchsorted(first, starts, side="right") - 1
        near = np.unique(np.stack([rows, item, diagonal], axis=1), axis=0).tolist()
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        at = 0
        while at < len(near):
            row, k, low = near[at]
            high, edits = low, self.edits[k]
            at += 1
            while at < len(near) and near[at][:2] == [row, k] and near[at][2] <= high + edits:
                high = near[at][2]
                at += 1
            begin = max(int(first[row]), low - edits)
            text = words[begin:min(int(first[row + 1]), high + len(self.lists[k]) + edits)].tolist()
            score, end = best_match(self.lists[k], text)
            if score > edits:
                continue
            _, back = best_match(self.lists[k][::-1], text[:end][::-1])
            start = begin - int(first[row]) + end - back
            match = (score, start, begin - int(first[row]) + end)
            best[row, k] = min(best.get((row, k), match), match)
        return [(row, k, start, end, score) for (row, k), (score, start, end) in sorted(best.items())]


def _searchers(benchmark: DataFrame, item: str, text: str, share: float, recall: float,
               sampled: int) -> Iterator[tuple[list, Searcher]]:
    """Item keys and searcher of each pass; items are dealt to passes by a hash of key and text."""
    long = benchmark.select(F.col(item), F.col(text)).where(F.col(item).isNotNull() & F.col(text).isNotNull()).distinct()
    words = long.agg(F.sum(F.size(F.split(text, "[ \\t-\\r]+")))).first()[0] or 0
    passes = -(-words // PASS_WORDS)
    for k in range(passes):
        rows = long.where(F.pmod(F.xxhash64(item, text), F.lit(passes)) == k).orderBy(item, text).toArrow()
        hashes, first = folded_words(rows.column(1).combine_chunks())
        keep = [i for i in range(rows.num_rows) if first[i + 1] > first[i]]
        if keep:
            yield ([rows.column(0)[i].as_py() for i in keep],
                   Searcher([hashes[first[i]:first[i + 1]] for i in keep], share, recall, sampled))


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
               item: str = "item_id", item_text: str = "text", share: float = MAX_EDIT_SHARE,
               recall: float = RECALL, sampled: int = SAMPLED) -> DataFrame:
    """Stretches of texts within ``share`` edited words of a benchmark item, A-Z in either case.

    One row for each row of ``docs`` and item found: ``key, item, start, end, edits``, the stretch of
    fewest edits, in words of the text. Null and empty texts have none, items without key or words are not searched
    for. Items too short for an edit (under 7 words at 15 %) are found word for word. Texts aren't shuffled: each pass broadcasts the
    keys of at most about ``PASS_WORDS`` words of items, however many there are.
    """
    kind = benchmark.schema[item].dataType
    schema = schema_with(docs.select(key), f"item_id {kind.simpleString()}, start bigint, end bigint, edits int")
    rows = docs.select(key, text)
    found = None
    for names, searcher in _searchers(benchmark, item, item_text, share, recall, sampled):
        shared = docs.sparkSession.sparkContext.broadcast((names, searcher))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, searcher = shared.value
            for batch in batches:
                for start, end in slices(batch.column(1)):
                    keys, texts = (c.slice(start, end - start) for c in batch.columns)
                    matches = searcher.find(*folded_words(texts))
                    if matches:
                        row, k, begin, stop, edits = zip(*matches)
                        yield pa.RecordBatch.from_arrays(
                            [keys.take(pa.array(row)), pa.array([names[i] for i in k], to_arrow_type(kind)),
                             pa.array(begin, pa.int64()), pa.array(stop, pa.int64()), pa.array(edits, pa.int32())],
                            names=schema.names)

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                  share: float = MAX_EDIT_SHARE, recall: float = RECALL, sampled: int = SAMPLED) -> DataFrame:
    """Rows of ``docs`` in whose text no benchmark item is found, all columns as they are.

    Every row is judged by its own text, in the pass that finds; nothing is shuffled.
    """
    at = docs.columns.index(text)
    for _, searcher in _searchers(benchmark, item, item_text, share, recall, sampled):
        shared = docs.sparkSession.sparkContext.broadcast(searcher)

        def work(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[[row for row, *_ in shared.value.find(*folded_words(batch.column(at)))]] = False
            return batch.filter(pa.array(clean))

        docs = docs.mapInArrow(by_slice(work, text), docs.schema)
    return docs

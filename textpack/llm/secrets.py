"""Secrets in texts: fixed patterns, and formats inferred from what the patterns find.

Strings that the patterns find are labelled credentials. A prefix tree of their character classes is generalised by
merging states whose observed futures don't differ significantly (Hoeffding bound), which gives
one probabilistic automaton for each kind, and one for ordinary long words. Every other long word of every
text is scored by its log likelihood ratio per character between the best kind and ordinary words.

Words without a label are not all ordinary: bare credentials lie among them. Those that fit a kind as its own
strings do, and better than the classes of the other words, are left out of what ordinary words are learned from.

Every distinct string of all texts counts. Jobs count by prefix and by state; the driver has only the tree of the
prefixes that enough strings share, whose size doesn't follow the corpus, and merges it. The strings, whole and all of
them, are then read by the merged automaton, and its probabilities are those of this reading.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from statistics import median

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textpack.llm.words import by_slice, schema_with
from textpack.operators.ordering import RANGE, global_offset, in_ranges, range_buckets
from textpack.session import materialize

KINDS = ("assign", "access", "hex")
FORMAT = "format"
# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}")
LEAST_VALUE = 12
#: A prefix is a state before merging if one in so many distinct strings of its kind, or more, have it, and up to this
#: length. What strings read beyond such prefixes is counted once the states are merged, from the first state on.
PREFIX_SHARE, MAX_PREFIX = 2000, 128
#: Significance of a merge, visits below which a state says nothing, and added count of every symbol.
ALPHA, LEAST_VISITS, ADDED = 0.05, 8, 0.05
#: Log likelihood ratio per character from which a word is a secret.
THRESHOLD = 1.0
#: Share of a kind's strings that may fit it worse than a word which is not learned from as ordinary.
LEAST_FIT = 0.05
#: Rounds in which ordinary words are told from words that are like a kind, at most.
ROUNDS = 10
# Character classes: digits, a-f, g-z, A-F, G-Z, joiners, base64 signs, padding.
_CLASS_OF = {c: k for k, group in enumerate((
    "0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "_.-", "+/", "=")) for c in group}
_TO_CLASSES = str.maketrans({c: str(k) for c, k in _CLASS_OF.items()})
N_CLASSES, END = 8, 8
#: Strings of a kind by their place in hash order: all, those at even places, those at odd ones.
WHOLE, EVEN, ODD = "whole", "even", "odd"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, value)`` of the fixed patterns, by start and then kind as listed."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k], v) for a, b, k, v in sorted(found, key=lambda f: (f[0], f[2]))]


def candidates(text: str, spans: list[tuple[int, int, str, str]]) -> Iterator[re.Match]:
    """Long words that no span overlaps."""
    k = 0
    ordered = sorted((a, b) for a, b, *_ in spans)
    for m in CANDIDATE.finditer(text):
        while k < len(ordered) and ordered[k][1] <= m.start():
            k += 1
        if not any(a < m.end() and m.start() < b for a, b in ordered[max(0, k - 3):k + 3]):
            yield m


def log_shares(seen: list[int]) -> list[float]:
    """Log probabilities of symbols seen so often."""
    total = math.log(sum(seen) + ADDED * len(seen))
    return [math.log(n + ADDED) - total for n in seen]


class Automaton:
    """A deterministic automaton with counts: visits, ends and moves of each state."""

    def __init__(self, strings: list[str]):
        self.visits, self.ends, self.moves = [0], [0], [{}]
        for string in sorted(strings):
            state = 0
            self.visits[0] += 1
            for c in map(int, string):
                if c not in self.moves[state]:
                    self.moves[state][c] = len(self.visits)
                    self.visits.append(0)
                    self.ends.append(0)
                    self.moves.append({})
                state = self.moves[state][c]
                self.visits[state] += 1
            self.ends[state] += 1
        self.passes: list[dict[int, int]] = [{c: self.visits[t] for c, t in m.items()} for m in self.moves]
        self.merge_states()

    @classmethod
    def of_tree(cls, moves: list[list[int]], counts: list[list[int]]) -> Automaton:
        """Of a tree of prefixes, its moves (-1: to none of them) and how often each symbol is read there."""
        made = cls.__new__(cls)
        made.moves = [{c: t for c, t in enumerate(m) if t >= 0} for m in moves]
        made.kept = list(range(len(moves)))
        made.visits, made.ends, made.passes = [0] * len(moves), [0] * len(moves), [{} for _ in moves]
        made.count(counts)
        made.merge_states()
        return made

    def count(self, counts: list[list[int]]) -> None:
        """Take how often each class, and the end, is read in the kept states."""
        for state, seen in zip(self.kept, counts):
            self.visits[state], self.ends[state] = sum(seen), seen[END]
            self.passes[state] = {c: n for c, n in enumerate(seen[:END]) if n}

    def machine(self) -> list[list[int]]:
        """The next states by number of the kept state; what leads to no known prefix goes on from the first."""
        number = {state: i for i, state in enumerate(self.kept)}
        return [[number[self.moves[state].get(c, 0)] for c in range(N_CLASSES)] for state in self.kept]

    def differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
        return abs(f1 / n1 - f2 / n2) > bound

    def compatible(self, a: int, b: int) -> bool:
        """Whether the futures seen from two states agree as far as they are seen often enough."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n1, n2 = self.visits[a], self.visits[b]
            if min(n1, n2) < LEAST_VISITS:
                continue
            if self.differ(self.ends[a], n1, self.ends[b], n2):
                return False
            for c in range(N_CLASSES):
                f1, f2 = self.passes[a].get(c, 0), self.passes[b].get(c, 0)
                if (f1 or f2) and self.differ(f1, n1, f2, n2):
                    return False
                if c in self.moves[a] and c in self.moves[b] and self.moves[a][c] != self.moves[b][c]:
                    todo.append((self.moves[a][c], self.moves[b][c]))
        return True

    def fold(self, into: int, state: int) -> None:
        """Add the counts of the tree below ``state`` to the states from ``into`` on."""
        todo = [(into, state)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for c, n in self.passes[b].items():
                self.passes[a][c] = self.passes[a].get(c, 0) + n
            for c, target in list(self.moves[b].items()):
                if c in self.moves[a]:
                    todo.append((self.moves[a][c], target))
                else:
                    self.moves[a][c] = target

    def merge_states(self) -> None:
        """Take states in order of their shortest path: each is merged with the first kept state that it
        is compatible with, or else kept."""
        kept, at = [0], 0
        while at < len(kept):
            for c in sorted(self.moves[kept[at]]):
                state = self.moves[kept[at]][c]
                if state in kept:
                    continue
                for other in kept:
                    if self.compatible(other, state):
                        self.moves[kept[at]][c] = other
                        self.fold(other, state)
                        break
                else:
                    kept.append(state)
            # A merge may have added moves to states seen before.
            at = 0 if any(t not in kept for k in kept[:at + 1] for t in self.moves[k].values()) else at + 1
        self.kept = kept

    def table(self) -> list[tuple[list[float], list[int]]]:
        """Log probabilities of the classes and of the end, and the next states; the last state is for what was never
        seen, where symbols are as likely as in all strings."""
        number = {state: i for i, state in enumerate(self.kept)}
        rows = []
        for state in self.kept:
            total = math.log(self.visits[state] + ADDED * (N_CLASSES + 1))
            logs = [math.log(self.passes[state].get(c, 0) + ADDED) - total for c in range(N_CLASSES)]
            rows.append((logs + [math.log(self.ends[state] + ADDED) - total],
                         [number[self.moves[state].get(c, 0)] if c in self.passes[state] else len(number)
                          for c in range(N_CLASSES)]))
        logs = log_shares([sum(self.passes[s].get(c, 0) for s in self.kept) for c in range(N_CLASSES)]
                          + [sum(self.ends[s] for s in self.kept)])
        rows.append((logs, [len(number)] * N_CLASSES))
        return rows


def log_likelihood(table: list[tuple[list[float], list[int]]], classes: str) -> float:
    state, total = 0, 0.0
    for c in map(int, classes):
        logs, moves = table[state]
        total += logs[c]
        state = moves[c]
    return total + table[state][0][END]


def one_state(strings: list[str]) -> list[tuple[list[float], list[int]]]:
    """The table of an automaton with a single state; without strings all symbols are alike."""
    seen = [sum(s.count(str(c)) for s in strings) for c in range(N_CLASSES)] + [len(strings)]
    return [(log_shares(seen), [0] * N_CLASSES)]


def ordinary_of(words: list[str], kinds: list[tuple[list[str], list[tuple[list[float], list[int]]]]]) -> list[str]:
    """The words that are not like a kind, given as its strings and their table.

    A word is like a kind if its likelihood per character is that of the kind's own strings where those are not
    learned from (all but the LEAST_FIT lowest), and higher than by the classes of all words that are like none.
    """
    found: dict[str, float] = {}
    for strings, table in kinds:
        halves = (strings[::2], strings[1::2]) if len(strings) > 1 else (strings, strings)
        own = sorted(log_likelihood(t, s) / len(s) for t, other in zip([Automaton(h).table() for h in halves], halves[::-1])
                     for s in other)
        least = own[int(LEAST_FIT * len(own))]
        for w in set(words):
            if (fit := log_likelihood(table, w) / len(w)) >= least:
                found[w] = max(fit, found.get(w, fit))
    plain = words
    for _ in range(ROUNDS):
        table, last = one_state(plain), plain
        gains = {w: fit - log_likelihood(table, w) / len(w) for w, fit in found.items()}
        # At first all words are the measure, credentials too, so only the half that stands out least is kept.
        most = median(gains.values()) if gains and last is words else 0.0
        plain = [w for w in words if w not in gains or gains[w] <= most]
        if plain == last:
            break
    return plain


class Formats:
    """Automata of all kinds and of ordinary words."""

    def __init__(self, labelled: dict[str, list[str]]):
        classes = {kind: [v.translate(_TO_CLASSES) for v in values] for kind, values in sorted(labelled.items())}
        words = classes.pop(FORMAT, [])
        kinds = [(values, Automaton(values).table()) for values in classes.values() if values]
        self.tables = [table for _, table in kinds]
        plain = ordinary_of(words, kinds)
        self.ordinary = Automaton(plain).table() if plain else one_state([]) if words else None
        self.threshold = THRESHOLD
        self.ratio = lru_cache(maxsize=1 << 16)(self._ratio)

    @classmethod
    def of_tables(cls, tables: list, ordinary: list | None) -> Formats:
        made = cls.__new__(cls)
        made.__setstate__((ordinary, tables, THRESHOLD))
        return made

    def __getstate__(self):
        return self.ordinary, self.tables, self.threshold

    def __setstate__(self, state):
        self.ordinary, self.tables, self.threshold = state
        self.ratio = lru_cache(maxsize=1 << 16)(self._ratio)

    def _ratio(self, classes: str) -> float:
        """Log likelihood ratio per character of a word's classes."""
        if not self.tables or self.ordinary is None:
            return float("-inf")
        plain = log_likelihood(self.ordinary, classes)
        return max(log_likelihood(t, classes) - plain for t in self.tables) / len(classes)

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Base spans and those that the formats add, by start and then kind as listed."""
        base = base_spans(text)
        added = [(m.start(), m.end(), FORMAT) for m in candidates(text, base)
                 if self.ratio(m[0].translate(_TO_CLASSES)) >= self.threshold]
        order = {k: i for i, k in enumerate((*KINDS, FORMAT))}
        return sorted([(a, b, k) for a, b, k, _ in base] + added, key=lambda s: (s[0], order[s[2]]))


def labelled_strings(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(kind, classes, even, odd)``, a written table: how many distinct strings of each kind, and ordinary words as a kind
    of their own, have these character classes.

    Strings of a kind are counted by their places in hash order, even and odd ones apart; words are all even.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = set()
        for value in batch.column(0):
            body = value.as_py() or ""
            spans = base_spans(body)
            found.update((kind, v) for _, _, kind, v in spans)
            found.update((FORMAT, m[0]) for m in candidates(body, spans))
        kinds, values = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array([xxhash.xxh64_intdigest(v) >> 1 for v in values], pa.int64()),
             pa.array(values, pa.string())], names=["kind", "rank", "value"])

    found = materialize(docs.select(F.col(text).alias("text")).mapInArrow(
        by_slice(run), "kind string, rank long, value string").distinct(), "labelled")
    ranged = in_ranges(found.where(F.col("kind") != FORMAT), "kind", "rank", "value")
    placed = global_offset(ranged, F.lit(1), F.struct("rank", "value"), range_buckets(), ["kind"], out="place")
    halves = placed.select("kind", "value", F.pmod("place", F.lit(2)).alias("odd")).unionByName(
        found.where(F.col("kind") == FORMAT).select("kind", "value", F.lit(0).cast("long").alias("odd")))
    classes = F.translate("value", "".join(_CLASS_OF), "".join(map(str, _CLASS_OF.values())))
    return materialize(halves.groupBy("kind", classes.alias("classes")).agg(
        F.sum(1 - F.col("odd")).alias("even"), F.sum("odd").alias("odd")), "classes")


def sizes(strings: DataFrame) -> dict[str, int]:
    """How many strings each kind has."""
    return dict(map(tuple, strings.groupBy("kind").agg(F.sum(F.col("even") + F.col("odd"))).collect()))


def readings(strings: DataFrame, machines: dict[tuple[str, str], list[list[int]]]) -> dict[tuple[str, str], list[list[int]]]:
    """How often each class, and the end, is read in each state, over all strings of a kind and part.

    A machine is given as the next states by class, from the first state on; at -1 no more is read.
    """
    keys = list(machines)
    shared = strings.sparkSession.sparkContext.broadcast([(*k, machines[k]) for k in keys])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[dict[tuple[int, int], int]] = [{} for _ in shared.value]
        for batch in batches:
            for kind, classes, even, odd in zip(*(column.to_pylist() for column in batch.columns)):
                symbols = [int(c) for c in classes]
                n_of = {WHOLE: even + odd, EVEN: even, ODD: odd}
                for (of, part, moves), seen in zip(shared.value, counts):
                    n = n_of[part]
                    if of != kind or not n:
                        continue
                    state = 0
                    for c in symbols:
                        seen[state, c] = seen.get((state, c), 0) + n
                        state = moves[state][c]
                        if state < 0:
                            break
                    else:
                        seen[state, END] = seen.get((state, END), 0) + n
        rows = [(k, state, c, n) for k, seen in enumerate(counts) for (state, c), n in seen.items()]
        columns = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                         names=["machine", "state", "symbol", "n"])

    totals = {k: [[0] * (END + 1) for _ in machines[k]] for k in keys}
    found = strings.select("kind", "classes", "even", "odd").mapInArrow(run, "machine int, state int, symbol int, n long")
    for k, state, c, n in found.groupBy("machine", "state", "symbol").agg(F.sum("n")).collect():
        totals[keys[k]][state][c] = n
    return totals


def automata(strings: DataFrame, total: dict[str, int], parts: list[tuple[str, str]]) -> dict[tuple[str, str], Automaton]:
    """The automata of all strings of each kind and part; ``total`` tells how many strings a kind has.

    As long as no kind has more than PREFIX_SHARE strings, and none longer than MAX_PREFIX, these are the automata of the lists.
    """
    enough = F.lit(False)
    for kind, _ in parts:
        enough |= (F.col("kind") == kind) & ((F.col("even") + F.col("odd")) * PREFIX_SHARE >= total[kind])
    heads = strings.select("kind", F.left("classes", F.lit(MAX_PREFIX)).alias("head"), "even", "odd")
    prefixes = (heads.withColumn("size", F.explode(F.sequence(F.lit(0), F.length("head"))))
                .groupBy("kind", F.left("head", F.col("size")).alias("prefix")).agg(F.sum("even").alias("even"), F.sum("odd").alias("odd"))
                .where(enough).collect())
    trees = {}
    for kind, part in parts:
        known = {}
        for r in sorted(prefixes, key=lambda r: r["prefix"]):
            n = r["even"] + r["odd"] if part == WHOLE else r[part]
            if r["kind"] == kind and n and n * PREFIX_SHARE >= total[kind]:
                known[r["prefix"]] = len(known)
        trees[kind, part] = [[known.get(f"{p}{c}", -1) for c in range(N_CLASSES)] for p in known]
    made = {k: Automaton.of_tree(trees[k], counts) for k, counts in readings(strings, trees).items()}
    for k, counts in readings(strings, {k: a.machine() for k, a in made.items()}).items():
        made[k].count(counts)
    return made


def values_at(rows: DataFrame, places: list[tuple[str, int]]) -> list[float]:
    """For each kind and place (from 0) the value there, of rows ``(kind, value, n)`` in the order of values, each ``n`` times."""
    ranged = in_ranges(rows.groupBy("kind", "value").agg(F.sum("n").alias("n")), "kind", "value")
    counts = sorted(map(tuple, ranged.groupBy("kind", RANGE).agg(F.sum("n")).collect()))  # a row per shuffle partition and kind
    found = []
    for kind, place in places:
        for number, n in ((r, n) for of, r, n in counts if of == kind):
            if place < n:
                found.append((F.col("kind") == kind) & (F.col(RANGE) == number) & (F.col("upto") > place))
                break
            place -= n
    upto = Window.partitionBy("kind", RANGE).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return list(ranged.withColumn("upto", F.sum("n").over(upto)).agg(*[F.min(F.when(at, F.col("value"))) for at in found]).first())


def least_fits(strings: DataFrame, total: dict[str, int], halves: dict[str, tuple[list, list]]) -> dict[str, float]:
    """For each kind the likelihood per character that all but the LEAST_FIT lowest of its strings have, by the table of the half
    that they are not in; ``halves`` are the tables of the even and the odd half."""
    shared = strings.sparkSession.sparkContext.broadcast(halves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(kind, log_likelihood(table, s) / len(s), n) for kind, s, even, odd in zip(*(c.to_pylist() for c in batch.columns))
                    for table, n in zip(shared.value[kind], (odd, even)) if n]
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.int64()))],
                                             names=["kind", "value", "n"])

    own = strings.where(F.col("kind") != FORMAT).select("kind", "classes", "even", "odd").mapInArrow(
        run, "kind string, value double, n long")
    return dict(zip(halves, values_at(own, [(kind, int(LEAST_FIT * total[kind])) for kind in halves]))) if halves else {}


def with_number(rows: DataFrame, name: str, of: Callable[[dict], float | None]) -> DataFrame:
    """``rows`` with a double that ``of`` tells from each row."""
    schema = schema_with(rows, f"{name} double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([of(r) for r in batch.to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=schema.names)

    return rows.mapInArrow(run, schema)


def ordinary_strings(words: DataFrame, tables: dict[str, list], least: dict[str, float]) -> DataFrame:
    """The words that are not like a kind, as in ``ordinary_of``; the kinds are given by their tables and least fits."""
    shared = words.sparkSession.sparkContext.broadcast((tables, least))

    def best_fit(row: dict) -> float | None:
        w = row["classes"]
        fits = [(log_likelihood(table, w) / len(w), shared.value[1][kind]) for kind, table in shared.value[0].items()]
        return max((fit for fit, bound in fits if fit >= bound), default=None)

    def seen_in(rows: DataFrame) -> list[int]:
        n = F.col("even") + F.col("odd")
        return [x or 0 for x in rows.agg(*[F.sum(n * F.length(F.regexp_replace("classes", f"[^{c}]", ""))) for c in range(N_CLASSES)],
                                         F.sum(n)).first()]

    scored = materialize(with_number(words, "fit", best_fit), "fits")
    n_like = scored.where("fit IS NOT NULL").count()
    if not n_like:
        return words
    everything = seen = seen_in(words)
    for turn in range(ROUNDS):
        table = [(log_shares(seen), [0] * N_CLASSES)]

        def gain(row: dict, table=table) -> float | None:
            return None if row["fit"] is None else row["fit"] - log_likelihood(table, row["classes"]) / len(row["classes"])

        gained = with_number(scored, "gain", gain)
        likely, most = gained.where("gain IS NOT NULL"), 0.0
        if turn == 0:
            most = median(values_at(likely.select("kind", F.col("gain").alias("value"), F.lit(1).alias("n")),
                                    [(FORMAT, (n_like - 1) // 2), (FORMAT, n_like // 2)]))
        last, seen = seen, [a - b for a, b in zip(everything, seen_in(likely.where(F.col("gain") > most)))]
        if seen == last:
            break
    return materialize(gained.where(F.col("gain").isNull() | (F.col("gain") <= most)).select(words.columns), "ordinary")


def learn(docs: DataFrame, text: str = "text") -> Formats:
    """Infer the formats from all texts."""
    strings = labelled_strings(docs, text)
    total = sizes(strings)
    kinds = [k for k in sorted(total) if k != FORMAT]
    # A single string is in both halves.
    made = {k: a.table() for k, a in automata(strings, total, [
        (kind, part) for kind in kinds for part in ((WHOLE, EVEN, ODD) if total[kind] > 1 else (WHOLE,))]).items()}
    tables = {kind: made[kind, WHOLE] for kind in kinds}
    if FORMAT not in total:
        return Formats.of_tables([*tables.values()], None)
    halves = {kind: tuple(made.get((kind, part), tables[kind]) for part in (EVEN, ODD)) for kind in kinds}
    plain = ordinary_strings(strings.where(F.col("kind") == FORMAT), tables, least_fits(strings, total, halves))
    left = sizes(plain)
    ordinary = automata(plain, left, [(FORMAT, WHOLE)])[FORMAT, WHOLE].table() if left else one_state([])
    return Formats.of_tables([*tables.values()], ordinary)


def scan(docs: DataFrame, formats: Formats, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, found)``: all secrets of each row as ``array<struct<start, end, kind>>``, in code points, end
    exclusive. A null or empty text has none; repeated rows are scanned each."""
    shared = docs.sparkSession.sparkContext.broadcast(formats)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    schema = schema_with(docs.select(key), "found array<struct<start:bigint,end:bigint,kind:string>>")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[{"start": a, "end": b, "kind": k} for a, b, k in shared.value.spans(t or "")]
                 for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=schema.names)

    return docs.select(key, F.col(text).alias("text")).mapInArrow(by_slice(work), schema)


def joined(found, kinds: tuple[str, ...]):
    """``kind:start:end`` of the spans of some kinds, comma-joined."""
    wanted = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, formats: Formats, text: str = "text") -> DataFrame:
    """``docs`` with every secret of the text column replaced by ``[kind]``; overlapping spans are one,
    named by the first. Other columns, and a null text, stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(formats)
    at = docs.columns.index(text)

    def cleaned(body: str | None) -> str | None:
        if not body:
            return body
        parts, last = [], 0
        for start, end, kind in shared.value.spans(body):
            if start >= last:
                parts += [body[last:start], f"[{kind}]"]
            last = max(last, end)
        return "".join([*parts, body[last:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.set_column(at, text, pa.array([cleaned(t) for t in batch.column(at).to_pylist()],
                                                      batch.column(at).type))

    return docs.mapInArrow(run, docs.schema)

"""The driver's side of learning merges: proposing a run of them and replaying it on exact counts."""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from textpack.constants import MAX_VOCAB_SIZE

Pair = tuple[int, int]

# Counts that the driver goes on following of many, and leading pairs per merge that a proposal looks at.
FOLLOWED = 20_000
LOOKED_AT = 8


@dataclass(frozen=True)
class Step:
    """A proposed merge. ``new`` says that no token is written like that yet; ``merged`` is then an id for this run only."""

    a: int
    b: int
    merged: int
    new: bool


def distinct(values: np.ndarray) -> np.ndarray:
    """The values in order, each once. Sorting is faster here than ``np.unique``, which hashes."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def leading(counts: dict[Pair, int], most: int) -> tuple[dict[Pair, int], int]:
    """At most the ``most`` largest counts, and a bound of the others."""
    if len(counts) <= most:
        return counts, 0
    cut = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), -most - 1)[-most - 1])
    return {pair: n for pair, n in counts.items() if n > cut}, cut


class Leader:
    """The most frequent pair of changing counts; of equal ones the smallest."""

    def __init__(self, counts: dict[Pair, float]):
        self.counts = counts
        self.heap = [(-n, pair) for pair, n in counts.items()]
        heapq.heapify(self.heap)

    def change(self, pair: Pair, by: float) -> None:
        self.counts[pair] = self.counts.get(pair, 0) + by
        heapq.heappush(self.heap, (-self.counts[pair], pair))

    def first(self) -> tuple[Pair | None, float]:
        while self.heap:
            n, pair = self.heap[0]
            if self.counts.get(pair) == -n:
                return pair, -n
            heapq.heappop(self.heap)
        return None, 0


class Chain:
    """Symbols of many pieces, each linked to its neighbours; the last place stands for none."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        ends = np.cumsum(lengths)
        none = len(symbols)
        self.symbols = np.append(symbols, -1).astype(np.int32)
        self.after = np.arange(1, none + 2, dtype=np.int32)
        self.before = np.arange(-1, none, dtype=np.int32)
        self.after[ends - 1] = self.after[none] = none
        self.before[ends - lengths] = self.before[none] = none

    def copy(self) -> Chain:
        other = Chain.__new__(Chain)
        other.symbols, other.after, other.before = self.symbols.copy(), self.after.copy(), self.before.copy()
        return other

    def keys(self, at: np.ndarray) -> np.ndarray:
        """The pair that starts at each place, as one number."""
        return self.symbols[at].astype(np.int64) * MAX_VOCAB_SIZE + self.symbols[self.after[at]]

    def pairs(self, at: np.ndarray) -> np.ndarray:
        """The places of them where a pair starts, each once."""
        none = len(self.symbols) - 1
        at = distinct(at)
        return at[(at < none) & (self.after[at] < none)]

    def merge(self, at: np.ndarray, a: int, b: int, merged: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Merge the pair wherever it still is among sorted places: places and keys of the pairs that go, and of those that come."""
        at = at[(self.symbols[at] == a) & (self.symbols[self.after[at]] == b)]
        if a == b and len(at):  # of overlapping places every other one, from the left
            starts = np.concatenate([[True], self.after[at[:-1]] != at[1:]])
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(starts, place, 0))) % 2 == 0]
        second = self.after[at]
        gone = self.pairs(np.concatenate([self.before[at], at, second]))
        gone_keys = self.keys(gone)
        right = self.after[second]
        self.symbols[at], self.symbols[second] = merged, -1
        self.after[at], self.before[right] = right, at
        come = self.pairs(np.concatenate([self.before[at], at]))
        return gone, gone_keys, come, self.keys(come)


class Predictor:
    """Guesses the next merges from a bounded set of pieces and the exact counts of the leading pairs.

    The places of a pair are listed when it comes up. A listed place may have been merged since, which its symbols tell. Of
    proposed merges that weren't accepted it is told what they change in all pieces; when they come up again that takes the
    place of the guess, so they find their place among the others.
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, n: np.ndarray):
        self.chain = Chain(symbols, lengths)
        self.weights = np.append(np.repeat(n, lengths), 0)
        self.places: dict[int, list[np.ndarray]] = defaultdict(list)
        self.told: dict[tuple[str, str], dict[tuple[str, str], int]] = {}
        self.order: dict[tuple[str, str], int] = {}
        self.beside: dict[str, list[tuple[str, str]]] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        at = self.chain.pairs(np.arange(len(symbols)))
        self._list(self.places, at, self.chain.keys(at))

    @staticmethod
    def _list(places: dict[int, list[np.ndarray]], at: np.ndarray, keys: np.ndarray) -> None:
        if not len(at):
            return
        order = np.argsort(keys, kind="stable")
        at, keys = at[order].astype(np.int32), keys[order]
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for key, part in zip(keys[np.append(0, cuts)].tolist(), np.split(at, cuts)):
            places[key].append(part)

    def _merged(self, chain: Chain, places: list[dict[int, list[np.ndarray]]], a: int, b: int, merged: int, counted: bool
                ) -> dict[Pair, float]:
        """Merge a pair; what that does to counts of pairs, if asked. Places of new pairs go to the last of ``places``."""
        listed = [part for found in places for part in found.get(a * MAX_VOCAB_SIZE + b, ())]
        if not listed:
            return {}
        gone, gone_keys, come, come_keys = chain.merge(distinct(np.concatenate(listed)), a, b, merged)
        self._list(places[-1], come, come_keys)
        if not counted:
            return {}
        keys, which = np.unique(np.concatenate([gone_keys, come_keys]), return_inverse=True)
        change = np.bincount(which, np.concatenate([-self.weights[gone], self.weights[come]]), len(keys))
        return {divmod(key, MAX_VOCAB_SIZE): by for key, by in zip(keys.tolist(), change.tolist()) if by}

    def propose(self, counts: dict[Pair, int], floor: int, tokens: list[str], written: dict[str, int], limit: int) -> list[Step]:
        """Up to ``limit`` merges. The first is the leading pair; none follow one of which the counts say too little."""
        counts, under = leading(counts, LOOKED_AT * limit)
        floor = max(floor, under)
        leader = Leader(dict(counts))
        spelled, known = list(tokens), dict(written)
        chain = self.chain.copy()
        places = [self.places, defaultdict(list)]
        told = dict(self.told)
        steps: list[Step] = []
        while len(steps) < limit:
            pair, n = leader.first()
            if pair is None or n < 1 or (steps and n <= floor):
                break
            a, b = pair
            token = spelled[a] + spelled[b]
            new = token not in known
            merged = known.setdefault(token, len(spelled))
            if new:
                spelled.append(token)
            steps.append(Step(a, b, merged, new))
            left, right = spelled[a], spelled[b]
            exact = told.pop((left, right), None)
            change = self._merged(chain, places, a, b, merged, exact is None)
            if exact is None:
                scale = n / max(1, -change.get(pair, 0))
                change = {other: by * scale for other, by in change.items()}
            else:
                change = self._in_ids(exact, known)
            for (x, y), by in self._moved((left, right), told, exact is None).items():
                x, y = self._ids_of(x, y, known)
                change[x, y] = by if exact is None else change.get((x, y), 0) + by
            leader.change(pair, -n)
            for other, by in change.items():
                if other != pair and (by > 0 or other in leader.counts):
                    leader.change(other, by)
            if not new:
                break
        return steps

    def tell(self, steps: list[Step], left: list[tuple[Step, dict[Pair, int]]], tokens: list[str]) -> None:
        """What the steps left of a run change, each after those before it. It is kept until the next run."""
        own: dict[int, str] = {}
        self.parts = {}

        def spell(token: int) -> str:
            return own.get(token) or tokens[token]

        for s in steps:
            if s.new:
                own[s.merged] = spell(s.a) + spell(s.b)
                self.parts[own[s.merged]] = spell(s.a), spell(s.b)
        self.told = {(spell(s.a), spell(s.b)): {(spell(a), spell(b)): by for (a, b), by in changes.items() if by}
                     for s, changes in left if s.new}
        self.order = {pair: k for k, pair in enumerate(self.told)}
        self.beside = defaultdict(list)
        for pair in self.told:
            for token in set(pair):
                self.beside[token].append(pair)

    def _ids_of(self, left: str, right: str, known: dict[str, int]) -> Pair:
        """A pair of spelled tokens. Of a token that isn't there in the order of now, the part beside the other counts."""
        while left not in known:
            left = self.parts[left][1]
        while right not in known:
            right = self.parts[right][0]
        return known[left], known[right]

    def _in_ids(self, told: dict[tuple[str, str], int], known: dict[str, int]) -> dict[Pair, int]:
        change: dict[Pair, int] = defaultdict(int)
        for pair, by in told.items():
            change[self._ids_of(*pair, known)] += by
        return change

    def _moved(self, pair: tuple[str, str], told: dict[tuple[str, str], dict[tuple[str, str], int]], untold: bool
               ) -> dict[tuple[str, str], int]:
        """What a merge changes beside its own if it goes before told ones that went before it, or all if it wasn't ``untold``.

        Three tokens in a row that either merge may take part in are then its own, and what is told of the other is corrected.
        """
        left, right = pair
        moved: dict[tuple[str, str], int] = {}
        before = len(self.order) if untold else self.order[pair]
        for other in self.beside.get(left, []) + self.beside.get(right, []):
            if other not in told or self.order[other] >= before:
                continue
            for hit, row, mine in ((other[1] == left, (other[0] + left, right), (other[0], left + right)),
                                   (other[0] == right, (left, right + other[1]), (left + right, other[1]))):
                if hit and (by := told[other].get(row, 0)) > 0:
                    told[other] = told[other] | {row: 0, pair: told[other].get(pair, 0) + by}
                    moved[other], moved[mine] = -by, by
        return moved

    def merge(self, merges: list[tuple[int, int, int]]) -> None:
        """Make accepted merges for good."""
        for a, b, merged in merges:
            self._merged(self.chain, [self.places], a, b, merged, False)
            self.places.pop(a * MAX_VOCAB_SIZE + b, None)


class Replay:
    """Exact counts of the leading pairs; all others have at most ``floor``."""

    def __init__(self, counts: dict[Pair, int], floor: int):
        self.leader = Leader(counts)
        self.floor = floor
        self.left: list[tuple[Step, dict[Pair, int]]] = []  # the last run's steps that weren't accepted, with what they change
        self.fresh = True  # the first of newly read counts leads even if others not read are as frequent

    @property
    def counts(self) -> dict[Pair, int]:
        return self.leader.counts

    def accept(self, steps: list[Step], changes: pa.Table, tokens: list[str], written: dict[str, int]
               ) -> tuple[list[tuple[int, int, int]], bool]:
        """The merges that come next, in their order, and whether the counts still tell which follow. ``left`` holds the others.

        Steps may be taken in another order than proposed, as long as none shares a place in a text with those it
        goes before: the run then gives the same in either order, and ``_go_before`` tells what each changes in the new one. New
        tokens are added to ``tokens`` and ``written``; their ids are given in the order of acceptance.
        """
        by_step: dict[int, dict[Pair, int]] = defaultdict(dict)
        pair = changes.column("pair").to_numpy()
        for k, a, b, by in zip(changes.column("step").to_pylist(), (pair // MAX_VOCAB_SIZE).tolist(),
                               (pair % MAX_VOCAB_SIZE).tolist(), np.asarray(changes.column("change")).tolist()):
            by_step[k][a, b] = by
        ids = {}  # of this run's new tokens, as far as they are accepted
        waiting = list(range(len(steps)))
        accepted, complete = self._taken(steps, by_step, waiting, ids, tokens, written)
        self.left = [(steps[k], by_step[k]) for k in waiting]
        if len(self.leader.heap) > 4 * FOLLOWED:
            counts, under = leading(self.counts, FOLLOWED)
            self.leader, self.floor = Leader(counts), max(self.floor, under)
        return accepted, complete

    def _taken(self, steps: list[Step], by_step: dict[int, dict[Pair, int]], waiting: list[int], ids: dict[int, int],
               tokens: list[str], written: dict[str, int]) -> tuple[list[tuple[int, int, int]], bool]:
        """Take merges out of ``waiting`` while the leading pair is one that may go next."""
        accepted: list[tuple[int, int, int]] = []
        own = {s.merged for s in steps if s.new}
        while waiting:
            leading, n = self.leader.first()
            if leading is None or n < 1 or (n <= self.floor and not self.fresh):
                return accepted, False
            place = next((i for i, k in enumerate(waiting) if self._final(steps[k], ids, own) == leading), None)
            if place is None or not all(self._apart(steps[j], steps[waiting[place]]) for j in waiting[:place]):
                return accepted, True
            k = waiting.pop(place)
            for j in reversed(waiting[:place]):
                self._go_before(steps[j], by_step[j], steps[k], by_step[k])
            self.fresh = False
            step = steps[k]
            token = tokens[leading[0]] + tokens[leading[1]]
            if step.new:
                ids[step.merged] = written[token] = len(tokens)
                tokens.append(token)
            merged = ids.get(step.merged, step.merged)
            accepted.append((*leading, merged))
            for (a, b), by in by_step[k].items():
                changed = (ids.get(a, a), ids.get(b, b))
                if changed in self.counts or (by > 0 and merged in changed):
                    self.leader.change(changed, by)
            if not step.new:  # pairs of old tokens may have grown, also some that are not followed
                return accepted, False
        return accepted, True

    @staticmethod
    def _final(step: Step, ids: dict[int, int], own: set[int]) -> Pair | None:
        """The pair of a step in final ids, if its parts have them."""
        if any(x in own and x not in ids for x in (step.a, step.b)):
            return None
        return ids.get(step.a, step.a), ids.get(step.b, step.b)

    @staticmethod
    def _apart(j: Step, k: Step) -> bool:
        """Whether no place in a text can be part of both merges, and each token tells which of them made it."""
        return j.new and k.new and j.b != k.a and j.a != k.b and j.merged not in (k.a, k.b)

    @staticmethod
    def _go_before(j: Step, by_j: dict[Pair, int], k: Step, by_k: dict[Pair, int]) -> None:
        """Make the changes of two steps, one right after the other, those of the other order.

        Beside what ``k`` merges, the token of ``j`` is then still its two parts. What both change together stays as it is.
        """
        for beside, apart in (((j.merged, k.a), (j.b, k.a)), ((j.merged, k.merged), (j.b, k.merged)),
                              ((k.b, j.merged), (k.b, j.a)), ((k.merged, j.merged), (k.merged, j.a))):
            by = by_k.pop(beside, 0)
            if by:
                by_k[apart] = by_k.get(apart, 0) + by
                by_j[beside] = by_j.get(beside, 0) + by
                by_j[apart] = by_j.get(apart, 0) - by

"""A compressed FM-index of word sequences, searched for many sequences in step."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank of any symbol up to any place, from bit vectors of one level for each bit of a symbol."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        left = symbols.astype(np.int64)
        for bit in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            ones = ((left >> bit) & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(-(-len(packed) // 8) + 1, dtype=np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            before = np.zeros(len(words), dtype=np.int32)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.levels.append((bit, words, before, int(len(left) - ones.sum())))
            left = np.concatenate([left[~ones], left[ones]])
        # Where the run of each symbol begins once all levels are passed.
        self.begin = self.walk(np.arange(n_symbols), np.zeros(n_symbols, dtype=np.int64))

    def walk(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for bit, words, before, zeros in self.levels:
            at = places >> 6
            below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[at] + np.bitwise_count(words[at] & below)
            places = np.where((symbols >> bit) & 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self.walk(symbols, places) - self.begin[symbols]


class FMIndex:
    """Index of sequences, each owned by a number, for windows of a fixed length.

    Suffixes are sorted by their first 64 words or more, as many as a window needs: a backward search of that
    many steps only depends on them.
    """

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, window: int):
        self.window = window
        _, self.codes = np.unique(np.concatenate(sequences), return_inverse=True)
        lengths = np.array([len(s) for s in sequences])
        n = int(lengths.sum() + len(lengths))
        text = np.zeros(n, dtype=np.int64)  # 0 ends each sequence
        inside = np.ones(n, dtype=bool)
        inside[np.cumsum(lengths + 1) - 1] = False
        text[inside] = self.codes + 1
        self.codes = self.codes + 1
        n_symbols = int(text.max()) + 1
        ranks, depth, levels = text, 1, []
        while depth < window:
            levels.append((depth, ranks))
            behind = np.zeros(n, dtype=np.int64)
            behind[:n - depth] = ranks[depth:] + 1
            _, ranks = np.unique(ranks * (n + 2) + behind, return_inverse=True)
            depth *= 2
        order = np.argsort(ranks, kind="stable")
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))[:-1]])
        self.wavelet = WaveletMatrix(text[order - 1], n_symbols)
        # Words that each suffix shares with the one before it, as far as a window goes.
        shared = np.zeros(n, dtype=np.int64)
        a, b = order[:-1], order[1:]
        for step, at in levels[::-1]:
            same = (at[np.minimum(a + shared[1:], n - 1)] == at[np.minimum(b + shared[1:], n - 1)]) & (b + shared[1:] < n) & (a + shared[1:] < n)
            shared[1:] += np.where(same, step, 0)
        heads = np.flatnonzero(shared < window)
        self.block = np.cumsum(shared < window) - 1
        self.block_start, self.block_end = heads, np.append(heads[1:], n)
        owner = np.repeat(owners, lengths + 1)[order]
        self.least = np.minimum.reduceat(owner, heads)

    def first_owners(self, lengths: np.ndarray) -> list[np.ndarray]:
        """For each indexed sequence, the smallest owner of every window of it, by backward search.

        All sequences are read from their ends in step. Once a match is as long as a window, it is cut
        back to the window at every word, which is the block of suffixes that share that many words.
        """
        starts = np.cumsum(lengths) - lengths
        by_length = np.argsort(-lengths, kind="stable")
        size = lengths[by_length]
        low, high = np.zeros(len(size), dtype=np.int64), np.full(len(size), len(self.block), dtype=np.int64)
        out = [np.zeros(max(0, n - self.window + 1), dtype=np.int64) for n in lengths]
        found = np.zeros((len(size), max(1, int(size.max()) - self.window + 1)), dtype=np.int64)
        for step in range(int(size.max())):
            live = int(np.searchsorted(-size, -step, side="left"))  # sequences longer than step
            symbol = self.codes[starts[by_length[:live]] + size[:live] - 1 - step]
            bounds = self.first[symbol] + self.wavelet.rank(symbol, low[:live]), self.first[symbol] + self.wavelet.rank(symbol, high[:live])
            low[:live], high[:live] = bounds
            if step + 1 >= self.window:
                block = self.block[low[:live]]
                low[:live], high[:live] = self.block_start[block], self.block_end[block]
                found[:live, step + 1 - self.window] = self.least[block]
        for k, i in enumerate(by_length.tolist()):
            n = len(out[i])
            out[i] = found[k, :n][::-1]
        return out

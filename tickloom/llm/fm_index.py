"""An FM-index over a sequence of small integers, held in numpy arrays."""

from __future__ import annotations

import numpy as np

END = 0


def suffix_array(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Starts of all suffixes in order. The last symbol must be ``END`` and unique.

    The first sort compares as many symbols as fit into 62 bits; later rounds double the
    compared length, and touch only the suffixes that are still tied.
    """
    n = len(symbols)
    step = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for k in range(step):
        key <<= bits
        key[: max(n - k, 0)] |= symbols[k:]
    order = np.argsort(key, kind="stable").astype(np.int64)
    sorted_key = key[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])))
    rank = np.empty(n, np.int64)
    sizes = np.diff(np.append(starts, n))
    rank[order] = np.repeat(starts, sizes)
    # Places in ``order`` that are tied with a neighbour.
    open_places = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    while len(open_places):
        tied = order[open_places]
        # A suffix that ends within the compared length holds END there and is unique.
        pair = rank[tied] * (n + 1) + rank[np.minimum(tied + step, n - 1)]
        by_pair = np.argsort(pair, kind="stable")
        tied, pair = tied[by_pair], pair[by_pair]
        order[open_places] = tied
        first = np.concatenate(([True], pair[1:] != pair[:-1]))
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(tied)))
        rank[tied] = np.repeat(open_places[starts], sizes)
        open_places = open_places[np.repeat(sizes, sizes) > 1]
        step *= 2
    return order


class WaveletMatrix:
    """Ranks in a sequence: how often a symbol occurs before a place."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.bits, self.n = bits, len(sequence)
        self.levels = []
        for level in range(bits - 1, -1, -1):
            one = ((sequence >> level) & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            zeros = self.n - int(one.sum())
            self.levels.append((words, before, zeros))
            sequence = np.concatenate((sequence[~one], sequence[one]))

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, place: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return before[place >> 6] + np.bitwise_count(words[place >> 6] & mask)

    def moved(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where ``place`` lies among the sorted symbols, for occurrences of ``symbol``."""
        for depth, (words, before, zeros) in enumerate(self.levels):
            ones = self._ones(words, before, place)
            bit = (symbol >> (self.bits - 1 - depth)) & 1
            place = np.where(bit == 1, zeros + ones, place - ones)
        return place

    def symbol_and_moved(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and where that occurrence lies among the sorted symbols."""
        symbol = np.zeros(len(place), np.int64)
        for words, before, zeros in self.levels:
            bit = ((words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._ones(words, before, place)
            symbol = symbol * 2 + bit
            place = np.where(bit == 1, zeros + ones, place - ones)
        return symbol, place


class FmIndex:
    """Counts and locates patterns in ``symbols`` (each at least 1, below ``2 ** bits``).

    ``END`` is appended. Every ``every``-th position of the sequence is kept as a sample; an
    occurrence is located by walking back to the nearest one.
    """

    def __init__(self, symbols: np.ndarray, bits: int, every: int = 8):
        text = np.append(symbols, END).astype(np.int64)
        order = suffix_array(text, bits)
        n = len(text)
        self.ranks = WaveletMatrix(text[order - 1], bits)
        counts = np.bincount(text, minlength=1 << bits)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        # Within the matrix equal symbols end up together, but groups go by reversed bits.
        every_symbol = np.arange(1 << bits, dtype=np.int64)
        self.base = self.ranks.moved(every_symbol, np.zeros(1 << bits, np.int64))
        sampled = order % every == 0
        self.sampled = sampled
        self.sample_no = np.cumsum(sampled) - 1
        self.samples = order[sampled]
        self.n = n

    def _rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.ranks.moved(symbol, place) - self.base[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges ``[low, high)`` of the patterns (rows, left-aligned): backward search."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        for back in range(1, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - back]
            low[live] = self.first[symbol] + self._rank(symbol, low[live])
            high[live] = self.first[symbol] + self._rank(symbol, high[live])
        return low, np.maximum(high, low)

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Positions in the sequence of the suffixes at ``places``."""
        found = np.empty(len(places), np.int64)
        open_, at, steps = np.arange(len(places)), places.copy(), 0
        while len(open_):
            hit = self.sampled[at]
            found[open_[hit]] = self.samples[self.sample_no[at[hit]]] + steps
            open_, at = open_[~hit], at[~hit]
            if len(open_):
                symbol, moved = self.ranks.symbol_and_moved(at)
                at = self.first[symbol] + moved - self.base[symbol]
            steps += 1
        return found

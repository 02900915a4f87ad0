"""An inverted index in blocks that finds the nearest vectors by cosine, exactly."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# Examples in a block.
BLOCK = 64

Vector = tuple[Sequence[int], Sequence[float]]


def unit(weights: Sequence[float]) -> np.ndarray:
    w = np.asarray(weights, float)
    length = float(np.sqrt(w @ w))
    return w / length if length > 0 else w


class BlockMaxIndex:
    """Postings of sparse vectors by term, and the largest weight of each term in each block.

    The largest weights bound what any example of a block can score. Blocks are opened by
    falling bound, until none that is left can reach the k-th best score: the result is that
    of comparing with every example.
    """

    def __init__(self, vectors: Sequence[Vector], n_terms: int, block: int = BLOCK):
        """``vectors`` are (terms, weights) with terms below ``n_terms``; they are scaled to length 1."""
        self.block, self.n = block, len(vectors)
        examples = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        terms = np.concatenate([np.asarray(t, np.int64) for t, _ in vectors] or [np.empty(0, np.int64)])
        weights = np.concatenate([unit(w) for _, w in vectors] or [np.empty(0)])
        order = np.lexsort((examples, terms))
        self.examples, self.weights, terms = examples[order], weights[order], terms[order]
        # A run is the postings of one term in one block.
        blocks = self.examples // block
        starts = np.flatnonzero(np.concatenate((
            [True], (terms[1:] != terms[:-1]) | (blocks[1:] != blocks[:-1])
        ))) if len(terms) else np.empty(0, np.int64)
        self.run_starts = np.append(starts, len(terms))
        self.run_blocks = blocks[starts]
        self.run_most = np.maximum.reduceat(self.weights, starts) if len(starts) else np.empty(0)
        self.term_runs = np.searchsorted(terms[starts], np.arange(n_terms + 1))

    def nearest(self, terms: Sequence[int], weights: Sequence[float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k nearest examples that share a term; ties to the smaller number."""
        weights = unit(weights)
        bounds = np.zeros((self.n + self.block - 1) // self.block)
        runs = []
        for term, weight in zip(terms, weights, strict=True):
            first, last = self.term_runs[term], self.term_runs[term + 1]
            runs.append((first, last, weight))
            bounds[self.run_blocks[first:last]] += weight * self.run_most[first:last]
        found, values, least = np.empty(0, np.int64), np.empty(0), 0.0
        for number in np.argsort(-bounds, kind="stable"):
            # Sums of the same products may differ in their last digits.
            if bounds[number] <= 0 or bounds[number] * (1 + 1e-12) < least:
                break
            scores = np.zeros(self.block)
            for first, last, weight in runs:
                at = first + np.searchsorted(self.run_blocks[first:last], number)
                if at < last and self.run_blocks[at] == number:
                    own = slice(self.run_starts[at], self.run_starts[at + 1])
                    scores[self.examples[own] - number * self.block] += weight * self.weights[own]
            near = np.flatnonzero(scores > 0)
            found = np.concatenate((found, near + number * self.block))
            values = np.concatenate((values, np.round(scores[near], 12)))
            best = np.lexsort((found, -values))[:k]
            found, values = found[best], values[best]
            least = values[-1] - 1e-12 if len(values) == k else 0.0
        return found, values

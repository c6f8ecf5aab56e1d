"""FM-index over the words of a shard of documents.

Rows are the suffixes in sorted order; the column of words before them (the BWT) is kept
as a wavelet matrix, whose ranks drive backward search. Positions are kept for every
SAMPLING-th word and every document start; other rows walk back to one of those.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain

import numpy as np

SAMPLING = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Sorted suffixes, by doubling the compared prefix of those that still tie.

    The last symbol must occur once and be smaller than all that may follow a tie.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    taken = max(1, 62 // bits)
    padded = np.r_[symbols.astype(np.int64), np.zeros(taken, np.int64)]
    key = np.zeros(n, np.int64)
    for k in range(taken):
        key = (key << bits) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.r_[True, key[1:] != key[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    while True:
        tied = np.flatnonzero(~(first & np.r_[first[1:], True]))
        if not len(tied):
            return order
        own = order[tied]
        key = (rank[own] << 32) | rank[np.minimum(own + taken, n - 1)]
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        begins = np.r_[True, key[1:] != key[:-1]]
        order[tied] = own
        first[tied] |= begins
        rank[own] = np.maximum.accumulate(np.where(begins, tied, 0))
        taken *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, a level for each bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.zeros, self.counts = bits, [], []
        for level in range(bits - 1, -1, -1):
            one = ((symbols >> level) & 1).astype(bool)
            count = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(~one, out=count[1:])
            self.counts.append(count)
            self.zeros.append(int(count[-1]))
            symbols = np.concatenate([symbols[~one], symbols[one]])
        # Where the rows of each symbol begin in the last level's order.
        self.begin = np.zeros(1 << bits, np.int64)
        places, at = np.unique(symbols, return_index=True)
        self.begin[places] = at

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each (present) symbol before each row."""
        row = row.astype(np.int64)
        for k, level in enumerate(range(self.bits - 1, -1, -1)):
            zero = self.counts[k][row]
            row = np.where((symbol >> level) & 1, self.zeros[k] + row - zero, zero)
        return row - self.begin[symbol]


class ShardIndex:
    def __init__(self, documents: list[list[bytes]]):
        """Documents as word lists; each is followed by a separator of its own."""
        vocabulary: dict[bytes, int] = defaultdict()
        vocabulary[b""] = 0  # for separators; no word is empty
        vocabulary.default_factory = vocabulary.__len__
        lengths = np.array([len(x) for x in documents], np.int64)
        ids = np.fromiter(
            map(vocabulary.__getitem__, chain.from_iterable(documents)), np.int64, int(lengths.sum())
        )
        vocabulary.default_factory = None
        self.vocabulary = vocabulary
        self.ends = np.cumsum(lengths + 1) - 1  # places of the separators
        self.starts = self.ends - lengths
        n, separators = len(ids) + len(documents), len(documents)
        words = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[self.ends] = False
        words[inside] = ids
        self.size = n
        if n == separators:
            self.bwt = None
            return
        # Separators sort first, each different, the last the smallest, so every tie ends at one.
        symbols = words + (separators - 1)
        symbols[self.ends] = np.arange(separators - 1, -1, -1)
        order = suffix_order(symbols)
        self.bwt = np.where(order > 0, words[order - 1], 0)
        counts = np.bincount(words, minlength=len(vocabulary))
        self.before = np.cumsum(counts) - counts  # rows of smaller symbols
        self.ranks = WaveletMatrix(self.bwt, max(1, (len(vocabulary) - 1).bit_length()))
        keep = np.zeros(n, bool)
        keep[::SAMPLING] = True
        keep[self.starts] = True
        self.sampled = keep[order]
        self.slot = np.cumsum(self.sampled) - 1
        self.positions = order[self.sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of patterns, rows of word ids (0: not in the shard)."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), 0 if self.bwt is None else self.size, np.int64)
        high[(patterns == 0).any(1)] = 0
        for k in range(patterns.shape[1] - 1, -1, -1):
            at = np.flatnonzero(low < high)
            if not len(at):
                break
            c = patterns[at, k]
            ranks = self.ranks.rank(np.r_[c, c], np.r_[low[at], high[at]])
            low[at] = self.before[c] + ranks[: len(at)]
            high[at] = self.before[c] + ranks[len(at) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Word positions of rows."""
        found = np.full(len(rows), -1, np.int64)
        at, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(at):
            done = self.sampled[rows]
            found[at[done]] = self.positions[self.slot[rows[done]]] + steps
            at, rows = at[~done], rows[~done]
            c = self.bwt[rows]
            rows = self.before[c] + self.ranks.rank(c, rows)
            steps += 1
        return found

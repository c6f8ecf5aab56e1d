"""Elias-Fano sequences and a two-level n-gram trie on memory-mapped arrays."""

from __future__ import annotations

import os

import numpy as np

_CHUNK = 1 << 15
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class EliasFano:
    """A sorted sequence of n values: low bits as they are, high bits in unary with a rank directory.

    A value v at place i sets bit (v >> low_bits) + i; a zero ends each value of the high part.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, ranks: np.ndarray, low_bits: int):
        self.low, self.high, self.ranks, self.low_bits = low, high, ranks, low_bits

    @staticmethod
    def arrays(values: np.ndarray, low_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """low, high (bytes, whole words of 64 bits) and ones before each word."""
        values = values.astype(np.uint64)
        top = (values >> np.uint64(low_bits)).astype(np.int64)
        size = (int(top[-1]) if len(top) else 0) + len(top) + 2
        bits = np.zeros(-(-size // 64) * 64, bool)
        bits[top + np.arange(len(top))] = True
        high = np.packbits(bits, bitorder="little")
        ones = _POPCOUNT[high].reshape(-1, 8).sum(1, dtype=np.int64)
        ranks = np.r_[0, np.cumsum(ones)].astype(np.int64)
        kind = np.uint16 if low_bits <= 16 else np.uint32
        return (values & np.uint64((1 << low_bits) - 1)).astype(kind), high, ranks

    def _select(self, k: np.ndarray, before: np.ndarray, flip: int) -> np.ndarray:
        """Place of the k-th (from 0) bit of a kind, given how many of it are before each word."""
        out = np.empty(len(k), np.int64)
        words = self.high.reshape(-1, 8)
        for at in range(0, len(k), _CHUNK):
            part = k[at : at + _CHUNK]
            word = np.searchsorted(before, part, side="right") - 1
            bits = np.unpackbits(words[word] ^ np.uint8(flip), axis=1, bitorder="little")
            count = np.cumsum(bits, axis=1, dtype=np.uint8)
            inside = (count > (part - before[word])[:, None]).argmax(1)
            out[at : at + _CHUNK] = word * 64 + inside
        return out

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        """Values at places."""
        top = self._select(places, self.ranks, 0) - places
        return (top.astype(np.uint64) << np.uint64(self.low_bits)) | self.low[places].astype(np.uint64)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 where it isn't in the sequence."""
        out = np.full(len(values), -1, np.int64)
        if not len(self.low):
            return out
        top = (values >> np.uint64(self.low_bits)).astype(np.int64)
        low = (values & np.uint64((1 << self.low_bits) - 1)).astype(self.low.dtype)
        words = len(self.ranks) - 1
        zeros = np.arange(words + 1, dtype=np.int64) * 64 - self.ranks
        at = np.flatnonzero(top < zeros[-1])
        place = np.zeros(len(at), np.int64)
        later = top[at] > 0
        place[later] = self._select(top[at[later]] - 1, zeros, 0xFF) + 1
        while len(at):  # the successors that share the high part
            one = (self.high[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            at, place = at[one], place[one]
            i = place - top[at]
            hit = self.low[i] == low[at]
            out[at[hit]] = i[hit]
            at, place = at[~hit], place[~hit] + 1
        return out


_CONTEXT_LOW = 32
_FOLLOWER_LOW = 16


class NgramTrie:
    """Contexts, and for each its successors, with quantised values in both levels.

    Successors are hashes, so within a context they are uniform: a successor's value is the
    context's pointer plus its hash as a fraction of the context's number of successors.
    All contexts together then form one dense monotone sequence, and a search touches the
    few entries next to the place that pointer and fraction give.
    """

    @staticmethod
    def _context_values(contexts: np.ndarray, count: int) -> np.ndarray:
        """Contexts (64-bit hashes) scaled to `count` buckets, with _CONTEXT_LOW bits inside."""
        # The product of the high half with the count gives the bucket, the rest the place inside it.
        top, rest = contexts >> np.uint64(32), contexts & np.uint64(0xFFFFFFFF)
        n = np.uint64(max(1, count))
        return top * n + ((rest * n) >> np.uint64(32))

    @staticmethod
    def _follower_values(pointer: np.ndarray, count: np.ndarray, followers: np.ndarray) -> np.ndarray:
        fraction = (followers.astype(np.uint64) * count.astype(np.uint64)) >> np.uint64(32 - _FOLLOWER_LOW)
        return (pointer.astype(np.uint64) << np.uint64(_FOLLOWER_LOW)) + fraction

    @staticmethod
    def write(folder: str, contexts, counts, followers, context_codes, follower_codes) -> None:
        """Levels as files. contexts: sorted; counts: successors of each; followers: 32-bit hashes, sorted
        within each context."""
        pointers = np.r_[0, np.cumsum(counts)].astype(np.uint64)
        which = np.repeat(np.arange(len(contexts)), counts)
        values = NgramTrie._follower_values(pointers[which], counts[which], followers)
        parts = {
            "context": EliasFano.arrays(NgramTrie._context_values(contexts, len(contexts)), _CONTEXT_LOW),
            "pointer": EliasFano.arrays(pointers, 2),
            "follower": EliasFano.arrays(values, _FOLLOWER_LOW),
        }
        for name, arrays in parts.items():
            for kind, array in zip(("low", "high", "ranks"), arrays):
                np.save(os.path.join(folder, f"{name}-{kind}.npy"), array)
        np.save(os.path.join(folder, "context-codes.npy"), context_codes)
        np.save(os.path.join(folder, "follower-codes.npy"), follower_codes)

    def __init__(self, folder: str):
        def mapped(name):
            return np.load(os.path.join(folder, f"{name}.npy"), mmap_mode="r")

        def sequence(name, low_bits):
            return EliasFano(*(mapped(f"{name}-{kind}") for kind in ("low", "high", "ranks")), low_bits)

        self.context = sequence("context", _CONTEXT_LOW)
        self.pointer = sequence("pointer", 2)
        self.follower = sequence("follower", _FOLLOWER_LOW)
        self.context_codes, self.follower_codes = mapped("context-codes"), mapped("follower-codes")

    def find_contexts(self, contexts: np.ndarray) -> np.ndarray:
        return self.context.find(self._context_values(contexts, len(self.context_codes)))

    def find_followers(self, places: np.ndarray, followers: np.ndarray) -> np.ndarray:
        """Place of each successor, given the (found) place of its context; -1: not seen there."""
        own, inverse = np.unique(places, return_inverse=True)
        start, stop = self.pointer[own][inverse], self.pointer[own + 1][inverse]
        return self.follower.find(self._follower_values(start, stop - start, followers))

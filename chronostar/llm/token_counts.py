"""Token counts of a piece vocabulary (SentencePiece BPE) by rank-synchronous array merging.

Whole texts become pre-tokens that no piece crosses. The distinct pre-tokens of a
slice are held as one ragged array of symbols; in each round every sequence applies
its own lowest-rank pair, all sequences at once. Only counts are kept.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronostar.llm.common import map_texts

NONE = np.iinfo(np.int32).max
#: Pre-tokens whose count a task remembers between slices.
REMEMBERED = 300_000
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes):
    """(number, value) of the fields of a protocol buffer message."""

    def varint(i):
        value = shift = 0
        while True:
            value |= (data[i] & 0x7F) << shift
            shift += 7
            i += 1
            if data[i - 1] < 0x80:
                return value, i

    i = 0
    while i < len(data):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            size, i = varint(i)
            value, i = data[i : i + size], i + size
        else:
            size = 8 if kind == 1 else 4
            value, i = data[i : i + size], i + size
        yield tag >> 3, value


@dataclass
class PieceVocabulary:
    """A piece model as arrays: symbol of each character, and the pair table."""

    symbol: np.ndarray  # by code point; -1: no pair has it
    weight: np.ndarray  # by code point: tokens that the character counts for if it stays alone
    keys: np.ndarray  # sorted left * size + right
    ranks: np.ndarray  # of the piece that the pair makes
    made: np.ndarray  # symbol that the pair makes
    together: np.ndarray  # by rank: all occurrences of a sequence may be merged in one round
    size: int
    splits: bool  # no piece goes on with a space mark after other characters
    prefix: bool

    @staticmethod
    def read(path: str) -> PieceVocabulary:
        pieces, prefix, charsmap, trim, fallback = [], True, b"", True, False
        with open(path, "rb") as f:
            for number, value in _fields(f.read()):
                if number == 1:
                    x = dict(_fields(value))
                    score = struct.unpack("<f", x.get(2, b"\0\0\0\0"))[0]
                    pieces.append((x.get(1, b"").decode(), score, x.get(3, NORMAL)))
                elif number == 2:
                    fallback = bool(dict(_fields(value)).get(35, 0))
                elif number == 3:
                    x = dict(_fields(value))
                    prefix, trim, charsmap = bool(x.get(3, 1)), bool(x.get(4, 1)), x.get(2, b"")
        if charsmap or trim or not fallback or any(kind in (USER, UNUSED) for _, _, kind in pieces):
            raise ValueError("only byte-fallback models without a normaliser or own symbols are supported")
        return PieceVocabulary.build([(p, s) for p, s, kind in pieces if kind == NORMAL], prefix)

    @staticmethod
    def build(pieces: list[tuple[str, float]], prefix: bool = True) -> PieceVocabulary:
        ids = {p: i for i, (p, _) in enumerate(pieces)}
        for p, _ in pieces:
            for c in p:
                ids.setdefault(c, len(ids))
        order = {s: r for r, s in enumerate(sorted({s for _, s in pieces}, reverse=True))}
        rank = {p: order[s] for p, s in pieces}
        pairs, together = {}, np.ones(len(order) + 1, bool)
        several = np.bincount([rank[p] for p, _ in pieces], minlength=len(order)) > 1
        together[: len(order)] &= ~several
        for p, _ in pieces:
            for k in range(1, len(p)):
                left, right = p[:k], p[k:]
                if left in ids and right in ids:
                    pairs[ids[left] * len(ids) + ids[right]] = (rank[p], ids[p])
                    for part in (left, right):
                        if len(part) > 1 and rank[p] <= rank[part]:
                            together[rank[part]] = False
        keys = np.array(sorted(pairs), np.int64)
        symbol = np.full(0x110000, -1, np.int32)
        points = np.arange(0x110000)
        weight = (1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)).astype(np.int32)
        for c, i in ids.items():
            if len(c) == 1:
                symbol[ord(c)] = i
                if i < len(pieces):
                    weight[ord(c)] = 1
        return PieceVocabulary(
            symbol,
            weight,
            keys,
            np.array([pairs[k][0] for k in keys.tolist()], np.int32),
            np.array([pairs[k][1] for k in keys.tolist()], np.int32),
            together,
            len(ids),
            not any(re.search(f"[^{SPACE}]{SPACE}", p) for p, _ in pieces),
            prefix,
        )

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and made symbol of pairs; NONE where there is no such pair."""
        if not len(self.keys):
            return np.full(len(left), NONE, np.int32), np.zeros(len(left), np.int32)
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], NONE), self.made[at]


def count_sequences(model: PieceVocabulary, sequences: list[str]) -> np.ndarray:
    """Tokens of each (non-empty) sequence."""
    counts = np.zeros(len(sequences), np.int64)
    if not sequences:
        return counts
    points = np.frombuffer("".join(sequences).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol, weight = model.symbol[points], model.weight[points]
    owner = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
    rank = np.full(len(symbol), NONE, np.int32)
    made = np.zeros(len(symbol), np.int32)
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    rank[inner], made[inner] = model.look_up(symbol[inner], symbol[inner + 1])
    while len(symbol):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lengths = np.diff(np.r_[first, len(owner)])
        lowest = np.minimum.reduceat(rank, first)
        if (lowest == NONE).any():
            counts[owner[first]] = np.add.reduceat(weight, first)
            going = np.repeat(lowest < NONE, lengths)
            symbol, weight, owner, rank, made = (x[going] for x in (symbol, weight, owner, rank, made))
            lengths, lowest = lengths[lowest < NONE], lowest[lowest < NONE]
            if not len(symbol):
                break
        hit = np.flatnonzero(rank == np.repeat(lowest, lengths))
        # Of overlapping occurrences every second is merged, from the left; of ranks that
        # could be overtaken by what they make, only the leftmost.
        begins = np.r_[True, np.diff(hit) != 1]
        run = np.maximum.accumulate(np.where(begins, np.arange(len(hit)), 0))
        leftmost = np.r_[True, owner[hit[1:]] != owner[hit[:-1]]]
        take = ((np.arange(len(hit)) - run) % 2 == 0) & (leftmost | model.together[rank[hit]])
        hit = hit[take]
        symbol[hit], weight[hit] = made[hit], 1
        stay = np.ones(len(symbol), bool)
        stay[hit + 1] = False
        at = hit - np.arange(len(hit))
        symbol, weight, owner, rank, made = (x[stay] for x in (symbol, weight, owner, rank, made))
        changed = np.zeros(len(symbol), bool)
        changed[at] = changed[at[at > 0] - 1] = True
        at = np.flatnonzero(changed)
        inside = at[at + 1 < len(owner)]
        inside = inside[owner[inside] == owner[inside + 1]]
        rank[at] = NONE
        rank[inside], made[inside] = model.look_up(symbol[inside], symbol[inside + 1])
    return counts


@cache
def _vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary.read(path)


def counter(path: str):
    """A function from texts to their token counts; it remembers frequent pre-tokens."""
    model = _vocabulary(path)
    parts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if model.splits else "(?s:.+)")
    known: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        if len(known) > REMEMBERED:
            known.clear()
        cut = [
            parts.findall((SPACE if model.prefix else "") + t.replace(" ", SPACE)) if t else [] for t in texts
        ]
        new = list({p for ps in cut for p in ps if p not in known})
        known.update(zip(new, count_sequences(model, new).tolist()))
        return [sum(map(known.__getitem__, ps)) for ps in cut]

    return count


def token_counts(docs: DataFrame, vocabulary: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row.

    Null texts count as empty and have no tokens; null keys and repeated rows give rows of
    their own; other columns are not read. An empty table gives no rows.
    """

    def work():
        count = counter(vocabulary)

        def step(keys, texts):
            return {"key": keys, "n_bytes": [len(t.encode()) for t in texts], "n_tokens": count(texts)}

        return step

    kind = docs.schema[key].dataType.simpleString()
    out = map_texts(docs, key, text, work, f"key {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

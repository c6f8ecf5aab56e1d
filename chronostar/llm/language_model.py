"""Language-model scores from a bigram trie that grows with the corpus.

Documents are tokenised in batches, which are written once. A batch asks for the counts of
its distinct words, then for the probabilities of its distinct bigrams; both questions go to
shards by hash, which sum the training counts over all batches and answer. So nothing of
the model passes through the driver, and the work follows the corpus. A shard's bigrams
form a trie of Elias-Fano levels with quantised smoothed probabilities, memory-mapped
while the shard answers.

Smoothing: absolute discounting, interpolated with add-0.1 unigrams,
P(w|u) = max(c(uw) - D, 0) / c(u) + D T(u) / c(u) P(w), T(u) the distinct successors of u.
Successors of a frequent context are spread over all shards; each takes its own T, which
is a uniform sample, times the number of shards.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostar.llm.common import arrow_schema, slices
from chronostar.llm.elias_fano import NgramTrie
from chronostar.session import stage

BATCH_BYTES = 8 << 20
#: Tokens of the corpus for each shard of words and of bigrams.
WORD_SHARD, BIGRAM_SHARD = 4_000_000, 2_000_000
PRIOR = 0.1
#: Values of the quantised levels; the lowest probability and back-off weight (log10) they hold.
LEVELS, LOWEST, LOWEST_BACKOFF = 127, -10.0, -4.0
#: Codes from here on are back-off weights.
BACKOFF = 128

_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_START = np.uint64(0x5851F42D4C957F2D)
_END_WORD = b""  # no word is empty


def held_out(key: Column) -> Column:
    """Rows not learnt from: crc32 of the id as text, modulo 10, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _pack(array: np.ndarray) -> bytes:
    """Compressed, byte planes apart: small integers have zero planes."""
    raw = np.ascontiguousarray(array)
    return zstandard.compress(raw.view(np.uint8).reshape(len(raw), -1).T.tobytes() if len(raw) else b"", 1)


def _unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel() if len(raw) else np.zeros(0, kind)


@dataclass
class Batch:
    """Documents as ids of the batch's own words; id 0 is the end."""

    words: list[bytes]
    tokens: np.ndarray
    lengths: np.ndarray
    held: np.ndarray

    @staticmethod
    def of(texts: list[str], held: list[bool]) -> Batch:
        ids: dict[bytes, int] = defaultdict()
        ids[_END_WORD] = 0
        ids.default_factory = ids.__len__
        parts = []
        for text in texts:
            own = text.encode().translate(_LOWER).split()
            parts.append(np.fromiter(map(ids.__getitem__, own), np.int32, len(own)))
            parts.append(np.zeros(1, np.int32))
        ids.default_factory = None
        lengths = np.array([len(p) + 1 for p in parts[::2]], np.int32)
        return Batch(list(ids), np.concatenate(parts) if parts else np.zeros(0, np.int32), lengths, np.array(held, bool))

    def columns(self) -> dict:
        return {
            "words": zstandard.compress(b" ".join(self.words[1:]), 1),
            "tokens": _pack(self.tokens),
            "lengths": _pack(self.lengths),
            "held": self.held.tobytes(),
        }

    @staticmethod
    def read(row: dict) -> Batch:
        own = zstandard.decompress(row["words"]).split(b" ") if row["words"] else []
        return Batch(
            [_END_WORD, *(w for w in own if w)],
            _unpack(row["tokens"], np.int32),
            _unpack(row["lengths"], np.int32),
            np.frombuffer(row["held"], bool),
        )

    def trained(self) -> np.ndarray:
        """Of each token: whether its document is learnt from."""
        return np.repeat(~self.held, self.lengths)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.trained()], minlength=len(self.words))

    def word_hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) sorted, training counts, and the number of each token's bigram.
        Context 0 is the start: no bigram goes on after an end."""
        contexts = np.r_[np.int64(0), self.tokens[:-1].astype(np.int64)][: len(self.tokens)]
        keys, number = np.unique(contexts * len(self.words) + self.tokens, return_inverse=True)
        counts = np.bincount(number[self.trained()], minlength=len(keys))
        return keys // len(self.words), keys % len(self.words), counts, number


def _shard_runs(batches, column: str):
    """(shard, its rows as dicts): rows come sorted by shard, a shard is held at a time."""
    own, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[column] != own:
                yield own, rows
                rows = []
            own = row[column]
            rows.append(row)
    if rows:
        yield own, rows


def _by_shard(rows: DataFrame, shards: int) -> DataFrame:
    return rows.repartition(shards, "shard").sortWithinPartitions("shard", "batch")


def _groups(shard: np.ndarray, shards: int):
    """(shard, places) of the non-empty shards, places in order."""
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(bounds)):
        yield int(s), order[bounds[s] : bounds[s + 1]]


def score_code(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(log10 / LOWEST * LEVELS), 0, LEVELS).astype(np.uint8)


def backoff_code(log10: np.ndarray) -> np.ndarray:
    return (BACKOFF + np.clip(np.rint(log10 / LOWEST_BACKOFF * LEVELS), 0, LEVELS)).astype(np.uint8)


def build_trie(folder: str, contexts, followers, counts, totals, shares, prior) -> None:
    """A shard's trie. For each bigram, in any order and with repeats: context and follower hash, training
    count, count of the context, by how much its successors here are fewer than all, and the
    follower's unigram probability."""
    order = np.lexsort((followers, contexts))
    contexts, followers, counts, totals, shares, prior = (
        x[order] for x in (contexts, followers, counts, totals, shares, prior)
    )
    new = np.r_[True, (contexts[1:] != contexts[:-1]) | (followers[1:] != followers[:-1])][: len(order)]
    first = np.flatnonzero(new)
    counts = np.add.reduceat(counts, first) if len(first) else counts
    contexts, followers, totals, shares, prior = (x[first] for x in (contexts, followers, totals, shares, prior))
    seen = counts > 0
    contexts, followers, counts, totals, shares, prior = (
        x[seen] for x in (contexts, followers, counts, totals, shares, prior)
    )
    once, twice = np.count_nonzero(counts == 1), np.count_nonzero(counts == 2)
    discount = min(0.95, max(0.5, once / (once + 2 * twice))) if once else 0.5
    own, start, size = np.unique(contexts, return_index=True, return_counts=True)
    mass = np.minimum(discount * size * shares[start] / totals[start], 1.0)
    each = np.repeat(mass, size)
    probability = np.maximum(counts - discount, 0) / totals + each * prior
    NgramTrie.write(
        folder,
        own,
        size,
        followers,
        backoff_code(np.log10(np.maximum(mass, 1e-9))),
        score_code(np.log10(np.minimum(np.maximum(probability, 1e-12), 1.0))),
    )


def answer(folder: str, contexts: np.ndarray, sizes: np.ndarray, followers: np.ndarray) -> np.ndarray:
    """Codes of bigrams: of the probability where the trie has it, else of the back-off weight (1 where the
    context was never seen)."""
    trie = NgramTrie(folder)
    place = trie.find_contexts(contexts)
    codes = np.full(len(contexts), BACKOFF, np.uint8)
    codes[place >= 0] = trie.context_codes[place[place >= 0]]
    out = np.repeat(codes, sizes)
    where = np.repeat(place, sizes)
    known = np.flatnonzero(where >= 0)
    found = trie.find_followers(where[known], followers[known])
    out[known[found >= 0]] = trie.follower_codes[found[found >= 0]]
    return out


def _words_to_shards(batched: DataFrame, shards: int) -> DataFrame:
    """Questions for the counts of a batch's words, by shard."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = Batch.read(row)
                counts, hashes = own.word_counts(), own.word_hashes()
                out = {"shard": [], "batch": [], "data": [], "counts": []}
                for shard, at in _groups((hashes % np.uint64(shards)).astype(np.int64), shards):
                    out["shard"].append(shard)
                    out["batch"].append(row["batch"])
                    out["data"].append(zstandard.compress(b" ".join(own.words[i] for i in at.tolist()), 1))
                    out["counts"].append(_pack(counts[at]))
                yield pa.RecordBatch.from_pydict(out, schema=types)

    schema = "shard int, batch long, data binary, counts binary"
    types = arrow_schema(batched.sparkSession, schema)
    return batched.mapInArrow(run, schema)


def _count_words(questions: DataFrame, shards: int) -> DataFrame:
    """Answers: training counts of each question's words; and each shard's tokens and distinct words."""

    def run(batches):
        for shard, rows in _shard_runs(batches, "shard"):
            total: dict[bytes, int] = defaultdict(int)
            asked = []
            for row in rows:
                own = zstandard.decompress(row["data"]).split(b" ")
                asked.append(own)
                for w, n in zip(own, _unpack(row["counts"], np.int64).tolist()):
                    total[w] += n
            out = {
                "batch": [r["batch"] for r in rows] + [None],
                "shard": [shard] * (len(rows) + 1),
                "kind": ["word"] * (len(rows) + 1),
                "data": [_pack(np.fromiter(map(total.__getitem__, a), np.int64, len(a))) for a in asked] + [None],
                "tokens": [0] * len(rows) + [sum(total.values())],
                "types": [0] * len(rows) + [sum(n > 0 for n in total.values())],
            }
            yield pa.RecordBatch.from_pydict(out, schema=types)

    schema = "batch long, shard int, kind string, data binary, tokens long, types long"
    types = arrow_schema(questions.sparkSession, schema)
    return _by_shard(questions, shards).mapInArrow(run, schema)


def _own_counts(batch: Batch, answers: list[dict], shards: int) -> np.ndarray:
    """The training counts of a batch's words, from the shards' answers."""
    counts = np.zeros(len(batch.words), np.int64)
    replies = {r["shard"]: r["data"] for r in answers if r["kind"] == "word"}
    for shard, at in _groups((batch.word_hashes() % np.uint64(shards)).astype(np.int64), shards):
        counts[at] = _unpack(replies[shard], np.int64)
    return counts


@dataclass
class Corpus:
    tokens: int
    types: int
    word_shards: int
    shards: int

    def prior(self, counts: np.ndarray) -> np.ndarray:
        return (counts + PRIOR) / (self.tokens + PRIOR * (self.types + 1))

    def placed(self, batch: Batch, counts: np.ndarray):
        """Bigrams of a batch with their shard: (context, word, count, number of each token, shard, is spread)."""
        context, word, seen, number = batch.bigrams()
        hashes = batch.word_hashes()
        own = hashes[context]
        own[context == 0] = _START
        spread = counts[context] > max(1, self.tokens // (4 * self.shards))
        mixed = (own ^ (own >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        more = np.where(spread, (hashes[word] * np.uint64(0x94D049BB133111EB)) >> np.uint64(17), np.uint64(0))
        shard = (((mixed + more) >> np.uint64(20)) % np.uint64(self.shards)).astype(np.int64)
        return context, word, seen, number, shard, spread, own, hashes


def _bigrams_to_shards(batched: DataFrame, words: DataFrame, corpus: Corpus) -> DataFrame:
    """Questions for a batch's bigrams, by shard."""

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"shard": [], "batch": [], "data": []}
        for row in left.to_pylist():
            batch = Batch.read(row)
            counts = _own_counts(batch, right.to_pylist(), corpus.word_shards)
            context, word, seen, _, shard, spread, own, hashes = corpus.placed(batch, counts)
            prior = corpus.prior(counts).astype(np.float32)
            followers = (hashes >> np.uint64(32)).astype(np.uint32)
            for s, at in _groups(shard, corpus.shards):
                new = np.r_[True, context[at][1:] != context[at][:-1]]
                first = at[new]
                parts = [
                    own[first],
                    np.diff(np.r_[np.flatnonzero(new), len(at)]).astype(np.int32),
                    np.maximum(counts[context[first]], 1),
                    spread[first].astype(np.uint8),
                    followers[word[at]],
                    seen[at].astype(np.int32),
                    prior[word[at]],
                ]
                packed = [_pack(p) for p in parts]
                out["shard"].append(s)
                out["batch"].append(row["batch"])
                out["data"].append(np.array([len(p) for p in packed], "<i4").tobytes() + b"".join(packed))
        return pa.table(out, schema=types)

    schema = "shard int, batch long, data binary"
    types = arrow_schema(batched.sparkSession, schema)
    return batched.groupBy("batch").cogroup(words.groupBy("batch")).applyInArrow(ask, schema)


_PARTS = (np.uint64, np.int32, np.int64, np.uint8, np.uint32, np.int32, np.float32)


def _parts(data: bytes) -> list[np.ndarray]:
    sizes = np.frombuffer(data[: 4 * len(_PARTS)], "<i4")
    ends = 4 * len(_PARTS) + np.cumsum(sizes)
    return [_unpack(data[e - n : e], kind) for n, e, kind in zip(sizes.tolist(), ends.tolist(), _PARTS)]


def _answer_bigrams(questions: DataFrame, shards: int) -> DataFrame:
    """Codes of each question's bigrams from the shard's trie."""

    def run(batches):
        for shard, rows in _shard_runs(batches, "shard"):
            asked = [_parts(r["data"]) for r in rows]
            for r in rows:
                r["data"] = None
            contexts, sizes, totals, spread, followers, counts, prior = (np.concatenate(x) for x in zip(*asked))
            with tempfile.TemporaryDirectory() as folder:  # the task's own; gone with the shard
                build_trie(
                    folder,
                    np.repeat(contexts, sizes),
                    followers,
                    counts.astype(np.int64),
                    np.repeat(totals, sizes),
                    np.repeat(np.where(spread > 0, shards, 1), sizes),
                    prior.astype(np.float64),
                )
                del contexts, sizes, totals, spread, followers, counts, prior
                codes = [_pack(answer(folder, a[0], a[1], a[4])) for a in asked]
            yield pa.RecordBatch.from_pydict(
                {"batch": [r["batch"] for r in rows], "shard": [shard] * len(rows), "kind": ["bigram"] * len(rows), "data": codes},
                schema=types,
            )

    schema = "batch long, shard int, kind string, data binary"
    types = arrow_schema(questions.sparkSession, schema)
    return _by_shard(questions, shards).mapInArrow(run, schema)


def _scores(batched: DataFrame, answers: DataFrame, corpus: Corpus, kind: str) -> DataFrame:
    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = right.to_pylist()
        tables = []
        for row in left.to_pylist():
            batch = Batch.read(row)
            counts = _own_counts(batch, replies, corpus.word_shards)
            _, word, _, number, shard, *_ = corpus.placed(batch, counts)
            codes = np.zeros(len(word), np.uint8)
            own = {r["shard"]: r["data"] for r in replies if r["kind"] == "bigram"}
            for s, at in _groups(shard, corpus.shards):
                codes[at] = _unpack(own[s], np.uint8)
            prior = np.log10(corpus.prior(counts))
            levels = codes.astype(np.float64)
            score = np.where(
                codes < BACKOFF,
                levels * (LOWEST / LEVELS),
                (levels - BACKOFF) * (LOWEST_BACKOFF / LEVELS) + prior[word],
            )
            first = np.cumsum(batch.lengths, dtype=np.int64) - batch.lengths
            tables.append(
                pa.table(
                    {
                        "key": pa.array(row["keys"], types.field("key").type),
                        "held_out": batch.held,
                        "n_tokens": batch.lengths.astype(np.int64),
                        "n_known": np.add.reduceat((counts > 0)[batch.tokens].astype(np.int64), first),
                        "base_score": np.add.reduceat(prior[batch.tokens], first),
                        "score": np.add.reduceat(score[number], first),
                    },
                    schema=types,
                )
            )
        return pa.concat_tables(tables) if tables else types.empty_table()

    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    types = arrow_schema(batched.sparkSession, schema)
    return batched.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(total, schema)


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Null and empty texts have the end as their only token; null keys are learnt from;
    repeated rows count and are scored each; an empty table gives no rows; without any
    training row all counts are 0. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    schema = f"batch long, keys array<{kind}>, words binary, tokens binary, lengths binary, held binary, size long"
    types = arrow_schema(spark, schema)

    def tokenise(batches):
        for batch in batches:
            for part in slices(batch, "_text", BATCH_BYTES):
                if part.num_rows:
                    own = Batch.of([x or "" for x in part.column("_text").to_pylist()], part.column("_held").to_pylist())
                    row = {"batch": uuid.uuid4().int >> 65, "keys": part.column("_key").to_pylist(), "size": len(own.tokens)}
                    yield pa.RecordBatch.from_pylist([row | own.columns()], schema=types)

    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), held_out(F.col(key)).alias("_held"))
    batched = stage(rows.mapInArrow(tokenise, schema), "lm-batches")  # written, so that batches keep their numbers
    size = batched.agg(F.sum("size")).first()[0] or 0
    word_shards, shards = math.ceil(max(1, size) / WORD_SHARD), math.ceil(max(1, size) / BIGRAM_SHARD)
    words = stage(_count_words(_words_to_shards(batched, word_shards), word_shards), "lm-words")
    tokens, distinct = words.agg(F.sum("tokens"), F.sum("types")).first()
    corpus = Corpus(tokens or 0, distinct or 0, word_shards, shards)
    words = words.filter("batch is not null").select("batch", "shard", "kind", "data")
    bigrams = stage(_answer_bigrams(_bigrams_to_shards(batched, words, corpus), shards), "lm-bigrams")
    scored = _scores(batched, words.union(bigrams), corpus, kind)
    return scored.select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )

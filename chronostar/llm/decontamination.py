"""Benchmark decontamination: an FM-index for each training shard, searched for all
windows of the benchmark's items.

A task indexes the words of its documents shard by shard. The windows come in blocks of
bounded size; a block is sent to all tasks, a larger benchmark takes several passes whose
spans are merged afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronostar.llm.common import map_texts, slices, words
from chronostar.llm.fm_index import ShardIndex
from chronostar.session import stage

#: Consecutive words of an item that make a hit; an item of fewer is one window.
WINDOW = 10
#: Text of a shard: one index.
SHARD_BYTES = 4 << 20
#: Benchmark text searched in one pass.
BLOCK_BYTES = 4 << 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SPAN = "struct<first:long,last:long,start:long,stop:long>"


class Windows:
    """Distinct windows of a block of items, by length, and the items that each is from."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        of: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            ws = words(text)
            for i in range(max(1, len(ws) - width + 1) if ws else 0):
                of.setdefault(tuple(ws[i : i + width]), set()).add(item)
        self.by_length: dict[int, list[tuple[tuple[bytes, ...], list[str]]]] = {}
        for window, own in of.items():
            self.by_length.setdefault(len(window), []).append((window, sorted(own)))

    def hits(self, index: ShardIndex) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[list[str]]]]:
        """(length, positions, number of the window, items of each window)."""
        get = index.vocabulary.get
        for length, windows in self.by_length.items():
            ids = np.array([[get(w, 0) for w in window] for window, _ in windows], np.int64)
            low, high = index.search(ids)
            counts = np.maximum(high - low, 0)
            which = np.repeat(np.arange(len(windows)), counts)
            rows = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
            if len(rows):
                yield length, index.locate(rows), which, [own for _, own in windows]


def blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """Items (id as text, text) in blocks of BLOCK_BYTES; rows without id or text are left out."""
    rows = benchmark.select(F.col(key).cast("string"), F.col(text).cast("string")).dropna()
    block, held = [], 0
    for item, content in rows.toLocalIterator():
        if block and held + len(content.encode()) > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append((item, content))
        held += len(content.encode())
    yield block


def _spans(covered: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
    return [(int(a), int(b) - 1) for a, b in edges.reshape(-1, 2)]


def search_shard(texts: list[str], windows: Windows) -> tuple[list[int], list[list[dict]], list[list[str]]]:
    """Of each text: its words, the merged spans that windows cover, the items with hits."""
    documents = [words(t) for t in texts]
    index = ShardIndex(documents)
    covered = np.zeros(index.size + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for length, positions, which, owners in windows.hits(index):
        np.add.at(covered, positions, 1)
        np.add.at(covered, positions + length, -1)
        pairs = np.unique(np.c_[np.searchsorted(index.ends, positions), which], axis=0)
        for doc, window in pairs.tolist():
            items[doc].update(owners[window])
    covered = np.cumsum(covered) > 0
    spans: list[list[dict]] = []
    for doc, text in enumerate(texts):
        found = _spans(covered[index.starts[doc] : index.ends[doc]]) if items[doc] else []
        places = [m.span() for m in _WORD.finditer(text)] if found else []
        spans.append([{"first": a, "last": b, "start": places[a][0], "stop": places[b][1]} for a, b in found])
    return [len(d) for d in documents], spans, [sorted(x) for x in items]


def merge_spans(spans: list[dict]) -> list[dict]:
    """Overlapping or adjacent spans of one document as one."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["first"], s["last"])):
        if out and s["first"] <= out[-1]["last"] + 1:
            if s["last"] > out[-1]["last"]:
                out[-1] |= {"last": s["last"], "stop": s["stop"]}
        else:
            out.append(dict(s))
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW,
) -> DataFrame:
    """key, n_words, n_hit, spans to remove and items (sorted ids as text) of every row.

    Spans have the numbers of their first and last word and the range of characters. Null
    and empty texts have no words; repeated rows and null keys get rows of their own; items
    without id, text or words have no windows; repeated items count once; an empty table
    gives no rows, an empty benchmark no hits. Other columns are not read.
    """
    found, several = None, None
    kind = docs.schema[key].dataType.simpleString()
    parts = blocks(benchmark, item_key, item_text)
    block, following = next(parts), next(parts, None)
    if following:  # the rows are numbered, so that what the passes find can be put together
        docs = docs.select(F.col(key).alias(key), F.col(text).alias(text))
        several = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        docs = several
    row_key = "_row" if following else key
    row_kind = "long" if following else kind
    while block is not None:

        def work(windows=Windows(block, width)):
            def step(keys, texts):
                n_words, spans, items = search_shard(texts, windows)
                return {"key": keys, "n_words": n_words, "spans": spans, "items": items}

            return step

        schema = f"key {row_kind}, n_words long, spans array<{_SPAN}>, items array<string>"
        own = map_texts(docs, row_key, text, work, schema, SHARD_BYTES)
        found = own if found is None else found.union(own)
        block, following = following, next(parts, None)
    if several is not None:
        found = found.groupBy("key").agg(
            F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),  # one entry a pass
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        merge = F.udf(lambda spans: merge_spans([s.asDict() for s in spans]), f"array<{_SPAN}>")
        found = found.withColumn("spans", F.when(F.size("spans") > 0, merge("spans")).otherwise(F.col("spans")))
        found = found.join(several.select(F.col("_row").alias("key"), F.col(key).alias("_key")), "key")
        found = found.drop("key").withColumnRenamed("_key", "key")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(F.col("key").alias(key), "n_words", n_hit.alias("n_hit"), "spans", "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", width: int = WINDOW) -> DataFrame:
    """The rows of `docs`, all columns, in which no window of the benchmark occurs."""
    for block in blocks(benchmark, "item_id", "text"):  # each pass works on what the last one kept

        def run(batches, windows=Windows(block, width)):
            for batch in batches:
                for part in slices(batch, text, SHARD_BYTES):
                    texts = [x or "" for x in part.column(text).cast(pa.string()).to_pylist()]
                    items = search_shard(texts, windows)[2]
                    yield part.filter(pa.array([not x for x in items], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

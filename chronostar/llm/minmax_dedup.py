"""Near duplicates by min-max hashing: banded signatures, links confirmed on full shingle sets.

Each of PERMUTATIONS hash functions gives a set's smallest and its largest value, two unbiased
samples for one evaluation. BAND_ROWS values make a band; smallest and largest ones
of a function are never in one band. Sets that agree in a band share a bucket.

Documents with equal sets are one set from the start. In each bucket all sets are first
compared with one of them, its pivot: of a group of near copies this connects most, in
a number of comparisons that grows with the group and not with its square. Buckets whose
other sets are not all connected by then are compared pair by pair, in tiles, but
only across what is not connected yet. Only trees of links leave a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronostar.llm.common import map_texts
from chronostar.llm.components import connected_components
from chronostar.session import stage

SHINGLE = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
PERMUTATIONS = 60
BAND_ROWS = 5
#: Orders in which a bucket's first set becomes its pivot; the bucket decides which.
PIVOT_ORDERS = 4
#: Sets and shingles of a tile's side, at most about so many.
TILE_SETS = 1024
TILE_SHINGLES = 1 << 18
#: Arrow bytes of tiles that a task takes up at once; a tile is never cut.
HELD_BYTES = 8 << 20

_U = np.uint64
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_RANDOM = np.random.default_rng(20250211)
_FACTORS = _RANDOM.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * _U(2) + _U(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
_BLOCK = 1 << 12


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text; fewer words are one shingle."""
    words = text.encode().translate(_LOWER).split()  # bytes split at space and \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = _scrambled(out ^ hashes[k : k + len(out)])
    return np.unique(out)


def min_max(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest value of each hash function over a (non-empty) set."""
    low, high = np.full(PERMUTATIONS, 2**64 - 1, np.uint64), np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(shingles), _BLOCK):
        values = shingles[None, start : start + _BLOCK] * _FACTORS[:, None] + _SHIFTS[:, None]
        low, high = np.minimum(low, values.min(1)), np.maximum(high, values.max(1))
    return low, high


def bands(shingles: np.ndarray) -> np.ndarray:
    """A hash (long) of each band: the bands of the smallest values, then those of the largest."""
    rows = np.concatenate(min_max(shingles)).reshape(-1, BAND_ROWS)
    out = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for k in range(BAND_ROWS):
        out = _scrambled(out ^ rows[:, k])
    return out.view(np.int64)


def expected_recall(percent: int = PERCENT) -> float:
    """Probability that two sets of that similarity share a bucket."""
    return 1 - (1 - (percent / 100) ** BAND_ROWS) ** (2 * PERMUTATIONS // BAND_ROWS)


def _sets(docs: DataFrame, key: str, text: str, full: bool) -> DataFrame:
    """key, n, set (digest of the shingles, null without words); the bands or the shingles themselves."""

    def work():
        def step(keys, texts):
            sets = [shingle_set(t) for t in texts]
            out = {
                "key": keys,
                "n": [len(s) for s in sets],
                "set": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            }
            if full:
                return out | {"shingles": [s.tobytes() for s in sets]}
            return out | {"bands": [bands(s) if len(s) else None for s in sets]}

        return step

    kind = docs.schema[key].dataType.simpleString()
    last = "shingles binary" if full else "bands array<long>"
    return map_texts(docs, key, text, work, f"key {kind}, n long, set binary, {last}")


def _tiles(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """One table for each group of rows with equal key columns (rows come sorted by them)."""

    def bounds(table: pa.Table) -> list[int]:
        ids = list(zip(*(table.column(k).to_pylist() for k in key)))
        return [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size > HELD_BYTES:
            table = pa.Table.from_batches(held)
            cuts = bounds(table)
            for start, stop in zip(cuts[:-2], cuts[1:-1]):
                yield table.slice(start, stop - start)
            held = table.slice(cuts[-2]).combine_chunks().to_batches()  # the last group may go on
            size = sum(b.nbytes for b in held) if len(cuts) > 2 else 0
    if held:
        table = pa.Table.from_batches(held)
        cuts = bounds(table)
        for start, stop in zip(cuts[:-1], cuts[1:]):
            yield table.slice(start, stop - start)


class Tile:
    """Shingle sets of a tile, to compare one of them with some others at a time."""

    def __init__(self, shingles: list[bytes], percent: int):
        sets = [np.frombuffer(s, np.uint64) for s in shingles]
        self.sizes = np.array([len(s) for s in sets])
        self.starts = np.cumsum(self.sizes) - self.sizes
        distinct, self.columns = np.unique(np.concatenate(sets), return_inverse=True)
        self.marked = np.zeros(len(distinct), np.uint8)
        self.percent = percent

    def linked(self, one: int, others: np.ndarray) -> np.ndarray:
        """Those of `others` (rows) that are linked with a row."""
        own, sizes = self.sizes[one], self.sizes[others]
        # The intersection is no larger than the smaller set, the union no smaller than the larger one.
        others = others[100 * np.minimum(own, sizes) >= self.percent * np.maximum(own, sizes)]
        if not len(others):
            return others
        sizes = self.sizes[others]
        first = np.cumsum(sizes) - sizes
        places = np.repeat(self.starts[others] - first, sizes) + np.arange(sizes.sum())
        mine = self.columns[self.starts[one] : self.starts[one] + own]
        self.marked[mine] = 1
        common = np.add.reduceat(self.marked[self.columns[places]].astype(np.int64), first)
        self.marked[mine] = 0
        return others[100 * common >= self.percent * (own + sizes - common)]


def tree_of_links(shingles: list[bytes], label: np.ndarray, right: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect what links connect, beyond what labels do already; with `right`, only those across sides."""
    tile, out = Tile(shingles, percent), []
    label = label.copy()
    for one in range(len(label)) if right is None else np.flatnonzero(~right):
        others = np.arange(one + 1, len(label)) if right is None else np.flatnonzero(right)
        found = tile.linked(one, others[label[others] != label[one]])
        if len(found):
            joined, at = np.unique(label[found], return_index=True)
            out += [(int(one), int(k)) for k in found[at]]
            label[np.isin(label, joined)] = label[one]
    return out


def _links(rows: DataFrame, percent: int, star: bool) -> DataFrame:
    """a, b: links in tiles of rows (group, i, j, right, set, label, shingles); of stars those of the one right row."""
    key = ["group", "i", "j"]

    def run(batches):
        for table in _tiles(batches, key):
            sets, right = table.column("set").to_pylist(), table.column("right").to_numpy()
            shingles = table.column("shingles").to_pylist()
            if star:
                centre = int(np.flatnonzero(right)[0])
                found = Tile(shingles, percent).linked(centre, np.flatnonzero(~right))
                pairs = [(centre, int(k)) for k in found]
            else:
                _, label = np.unique(np.array(table.column("label").to_pylist(), object), return_inverse=True)
                within = table.column("i")[0] == table.column("j")[0]
                pairs = tree_of_links(shingles, label, None if within else right, percent)
            a, b = ([sets[p[k]] for p in pairs] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    sorted_rows = rows.repartition(*key).sortWithinPartitions(*key)
    return sorted_rows.mapInArrow(run, "a binary, b binary").distinct()


def _parts(sets: str, shingles: str):
    """Into how many parts so many sets with so many shingles are cut."""
    most = F.greatest(F.col(sets) / TILE_SETS, F.col(shingles) / TILE_SHINGLES)
    return F.greatest(F.ceil(most), F.lit(1)).cast("int")


def _spokes(buckets: DataFrame) -> DataFrame:
    """pivot, set and n of the sets that share a bucket with its pivot (buckets: bucket, set, n, pivot)."""
    return buckets.filter("set != pivot").select("pivot", "set", "n").distinct()


def _star_tiles(spokes: DataFrame) -> DataFrame:
    """group, i, j, right and set: each pivot, on the right, with a part of its sets."""
    sizes = spokes.groupBy("pivot").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    sizes = stage(sizes.select("pivot", _parts("sets", "shingles").alias("parts")), "stars")
    own = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    none = F.lit(0)
    rim = spokes.join(sizes, "pivot").select(F.col("pivot").alias("group"), own.alias("i"), none.alias("j"), F.lit(False).alias("right"), "set")
    part = F.explode(F.sequence(none, F.col("parts") - 1))
    hubs = sizes.select(F.col("pivot").alias("group"), part.alias("i"), none.alias("j"), F.lit(True).alias("right"), F.col("pivot").alias("set"))
    return rim.union(hubs)


def _open_tiles(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Tiles of the buckets whose sets, the pivot aside, are not all connected yet; of equal buckets one.

    The sets with a bucket's most frequent label are not compared with each other: they meet the
    others only, so a large group with a few strays costs no more than the group's size.
    """
    labelled = buckets.filter("set != pivot").join(labels.withColumnRenamed("vertex", "set"), "set", "left")
    labelled = labelled.select("bucket", "set", "n", "pivot", F.coalesce("label", "set").alias("label"))
    seen = [F.bit_xor(F.xxhash64("set", F.lit(salt))).alias(f"seen{salt}") for salt in (1, 2)]
    mixed = labelled.groupBy("bucket", "pivot").agg(F.min("label").alias("low"), F.max("label").alias("high"), *seen)
    mixed = mixed.filter("low != high").groupBy("pivot", "seen1", "seen2").agg(F.min("bucket").alias("bucket"))
    rows = stage(labelled.join(stage(mixed.select("bucket"), "mixed"), "bucket").drop("pivot"), "mixed-sets")
    by_label = rows.groupBy("bucket", "label").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    sizes = by_label.groupBy("bucket").agg(
        F.max(F.struct("sets", "label", "shingles")).alias("top"), F.sum("sets").alias("all_sets"), F.sum("shingles").alias("all_shingles")
    )
    sizes = sizes.select(
        "bucket",
        F.col("top.label").alias("most"),
        F.col("top.sets").alias("sets"),
        F.col("top.shingles").alias("shingles"),
        (F.col("all_sets") - F.col("top.sets")).alias("other_sets"),
        (F.col("all_shingles") - F.col("top.shingles")).alias("other_shingles"),
    )
    sizes = stage(sizes.select("bucket", "most", _parts("sets", "shingles").alias("p"), _parts("other_sets", "other_shingles").alias("q")), "parts")
    placed = rows.join(sizes, "bucket")
    # Parts 0 to p - 1 hold the most frequent label, the next q the others.
    common = F.col("label") == F.col("most")
    at = F.xxhash64("set")
    own = F.when(common, F.pmod(at, F.col("p"))).otherwise(F.col("p") + F.pmod(at, F.col("q"))).cast("int")
    end = F.col("p") + F.col("q") - 1
    other = F.explode(F.sequence(F.when(common, F.col("p")).otherwise(F.lit(0)), end))
    tiled = placed.withColumn("own", own).withColumn("other", other)
    return tiled.select(
        F.col("bucket").alias("group"),
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("right"),
        "set",
        "label",
    )


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id, kept of every row.

    n_shingles: size of the row's shingle set. component_id: the smallest key among all rows that
    links connect, its own included; kept: the row has that key itself. Rows without words (null
    and empty texts too) have 0 shingles and no links. Repeated rows are copies of each other, and are all
    kept if one is; a null key is never smaller than another and its row is kept only if no key is
    connected with it. An empty table gives no rows.
    """
    rows = stage(_sets(docs, key, text, full=False), "minmax-rows")
    sets = rows.filter("set is not null").groupBy("set").agg(
        F.min("key").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    sets = stage(sets, "minmax-sets")
    placed = sets.select("set", "n", F.explode("bands").alias("bucket"))
    drawn = F.struct(F.xxhash64("set", F.pmod("bucket", F.lit(PIVOT_ORDERS))).alias("order"), F.col("set").alias("set"))
    pivots = placed.groupBy("bucket").agg(F.min(drawn).alias("drawn"), F.count("*").alias("size"))
    pivots = stage(pivots.filter("size > 1").select("bucket", F.col("drawn.set").alias("pivot")), "pivots")
    buckets = stage(placed.join(pivots, "bucket"), "buckets")
    spokes = stage(_spokes(buckets), "spokes")
    shingles = _full_sets(docs, key, text, sets, spokes)
    stars = _star_tiles(spokes).join(shingles, "set").withColumn("label", F.lit(None).cast("binary"))
    links = stage(_links(stars, percent, star=True), "star-links")
    labels = connected_components(links)
    more = _links(_open_tiles(buckets, labels).join(shingles, "set"), percent, star=False)
    if (more := stage(more, "more-links")).take(1):
        labels = connected_components(links.union(more))
    members = sets.select("set", "first").join(labels.withColumnRenamed("vertex", "set"), "set", "left")
    members = members.withColumn("label", F.coalesce("label", "set"))
    heads = members.groupBy("label").agg(F.min("first").alias("component"))
    known = stage(members.join(heads, "label").select("set", "component"), "members")
    out = rows.select("key", "n", "set").join(known, "set", "left")
    component = F.when(F.col("set").isNull(), F.col("key")).otherwise(F.col("component"))
    return out.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )


def _full_sets(docs: DataFrame, key: str, text: str, sets: DataFrame, spokes: DataFrame) -> DataFrame:
    """set and shingles of all pivots and spokes, from one document of each."""
    wanted = spokes.select("set").union(spokes.select("pivot")).distinct()
    wanted = stage(sets.select("set", "first").join(wanted, "set"), "wanted")
    firsts = stage(wanted.select("first").distinct(), "firsts")
    chosen = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    chosen = chosen.join(firsts, F.col("_key").eqNullSafe(F.col("first")), "left_semi")
    full = _sets(chosen, "_key", "_text", full=True).filter("set is not null").select("set", "shingles")
    return stage(full.join(wanted.select("set"), "set", "left_semi").dropDuplicates(["set"]), "shingles")

"""Near-duplicate documents by a chosen-path similarity join over word shingles.

Documents with the same set of shingles are one set from the start. Each set has a
MinHash signature, a fixed-size sample of tokens that similar sets share. A run chooses
some signature places at random and splits the sets by their tokens there; buckets that
are still large are split again at newly chosen places; small ones are compared pair by
pair on the signatures. Runs are repeated as often as the target recall needs.

Before that, the sets of the large buckets of some runs are compared with a few pivots of their
bucket: groups of near copies are mostly connected by that, in a number of comparisons that
grows with the group. The runs leave out buckets whose sets are connected, compare only what is not, and
call a bucket large by the pairs that are left to compare in it.

What is connected in this way is a group of candidates. Within each the exact similarity of
all pairs is computed from the shingles, group by group, large groups cut into tiles.
Only counts, and a tree of the links instead of all pairs, leave a task.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronostar.llm.common import arrow_schema, map_texts, words
from chronostar.llm.components import connected_components
from chronostar.session import stage

SHINGLE = 5
SIMILARITY = 0.8
TARGET_RECALL = 0.9999
#: Tokens of a signature.
PLACES = 64
#: Expected number of places that a node chooses; a run's root has just so many.
BRANCHES = 2
#: Sets up to which a bucket is compared without being split further.
SMALL = 128
#: Splits at most; what is still larger is compared in tiles of so many sets a side, also in the exact comparison.
DEPTH = 3
TILE_SETS = 1024
#: Runs whose root buckets have pivots, and pivots of a bucket, drawn by so many orders.
FIRST_RUNS = 2
PIVOTS = 3
#: Shingle bytes, at most, of one side of a tile in the exact comparison.
TILE_BYTES = 2 << 20
#: Ids up to which a table is sent to all tasks; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000
_MOST_RUNS = 10_000

_U = np.uint64
_RANDOM = np.random.default_rng(20240607)
_FACTORS = _RANDOM.integers(1, 1 << 63, PLACES, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def root_places(run: int) -> list[int]:
    """The signature places of a run's root: other ones in each run, until all have been used."""
    return [(run * BRANCHES + k) % PLACES for k in range(BRANCHES)]


def _equal_places(similarity: float) -> list[float]:
    """The probability of each number of equal signature places."""
    return [math.comb(PLACES, n) * similarity**n * (1 - similarity) ** (PLACES - n) for n in range(PLACES + 1)]


def least_equal(similarity: float = SIMILARITY, recall: float = TARGET_RECALL) -> int:
    """Equal signature places that make a candidate: fewer take at most half of the misses that are allowed."""
    below = 0.0
    for n, p in enumerate(_equal_places(similarity)):
        below += p
        if below > (1 - recall) / 2:
            return n
    return PLACES


def expected_recall(runs: int, similarity: float = SIMILARITY, least: int = 0) -> float:
    """Probability that a pair of that similarity meets at full depth in one of the runs, whose
    roots are as they are, and has at least so many equal signature places. All runs see
    the same signature, so it is summed over the number of equal places."""
    every, some = divmod(sum(len(root_places(r)) for r in range(runs)), PLACES)
    total = 0.0
    for n, p in enumerate(_equal_places(similarity)):
        if n < least:
            continue
        met = 1.0
        for _ in range(DEPTH - 1):
            met = 1 - (1 - BRANCHES / PLACES * met) ** n
        missed = sum(
            math.comb(n, k) * math.comb(PLACES - n, some - k) / math.comb(PLACES, some) * (1 - met) ** (every * n + k)
            for k in range(max(0, some - PLACES + n), min(n, some) + 1)
        )
        total += p * (1 - missed)
    return total


def runs_needed(recall: float = TARGET_RECALL, similarity: float = SIMILARITY) -> int:
    """Runs after which a pair of that similarity is a candidate with the target probability."""
    least = least_equal(similarity, recall)
    for runs in range(1, _MOST_RUNS + 1):
        if expected_recall(runs, similarity, least) >= recall:
            return runs
    raise ValueError(f"similarity {similarity} is too low for signatures of {PLACES} tokens")


def shingle_sets(texts: list[str], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; fewer words are one shingle."""
    cut = [words(t) for t in texts]
    known = {w: xxhash.xxh64_intdigest(w) for w in {w for ws in cut for w in ws}}
    out = []
    for ws in cut:
        h = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
        if len(h):
            n = max(1, len(h) - width + 1)
            total = np.zeros(n, np.uint64)
            for k in range(min(width, len(h))):
                total = _mixed(total * _STEP + h[k : k + n])
            h = np.unique(total)
        out.append(h)
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of PLACES hash functions over a (non-empty) set."""
    out = np.empty(PLACES, np.uint32)
    for at in range(0, PLACES, 8):
        part = (shingles[None, :] * _FACTORS[at : at + 8, None]) >> _U(32)
        out[at : at + 8] = part.min(1)
    return out


def _sets(docs: DataFrame, key: str, text: str, full: bool) -> DataFrame:
    """key, set (digest of the shingles, null without words) and its signature or its shingles."""

    def work():
        def step(keys, texts):
            sets = shingle_sets(texts)
            return {
                "key": keys,
                "set": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "data": [(s if full else signature(s)).tobytes() if len(s) else None for s in sets],
            }

        return step

    kind = docs.schema[key].dataType.simpleString()
    return map_texts(docs, key, text, work, f"key {kind}, set binary, data binary")


def _chosen(nodes: np.ndarray, places: list[int] | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each place: (place, rows whose node chooses it, salt of the child); all rows choose given places."""
    for place in range(PLACES) if places is None else places:
        h = _mixed(nodes * _STEP + _U(2 * place + 1))
        rows = np.flatnonzero(h < _U(BRANCHES * 2**64 // PLACES)) if places is None else np.arange(len(nodes))
        if len(rows):
            yield place, rows, h[rows]


def _children(
    nodes: np.ndarray, signatures: np.ndarray, places: list[int] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) of the sets at nodes: split by the tokens at each chosen place."""
    rows, keys = [], []
    for place, at, salt in _chosen(nodes, places):
        rows.append(at)
        keys.append(_mixed(salt * _STEP + signatures[at, place].astype(np.uint64)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(keys)


def _root_children(run: int, signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) of all sets at a run's root."""
    root = np.full(len(signatures), _mixed(np.array([run + 1], np.uint64))[0])
    return _children(root, signatures, root_places(run))


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), PLACES)


def _split(rows: DataFrame, first: list[int] | None = None) -> DataFrame:
    """node and set of the children: of the given runs' roots, or of each row's node."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, sets = _signatures(batch.column("signature")), batch.column("set")
            if first is None:
                found = [_children(batch.column("node").to_numpy().view(np.uint64), sig)]
            else:
                found = (_root_children(r, sig) for r in first)
            for at, keys in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), sets.take(pa.array(at)).cast(pa.binary())], names=["node", "set"]
                )

    return rows.mapInArrow(run, "node long, set binary")


def _links_to_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row connected with each of n rows."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _runs_of(batches: Iterator[pa.RecordBatch], key: list[str], most: int) -> Iterator[pa.Table]:
    """Tables of whole groups of rows that share a key (rows come sorted by it), several groups at a time."""
    held: list[pa.RecordBatch] = []
    size = 0

    def last_start(table: pa.Table) -> int:
        n = table.num_rows
        same = np.ones(n, bool)
        for c in key:
            column = table.column(c).to_numpy()
            same &= column == column[-1]
        return int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            table = pa.Table.from_batches(held)
            cut = last_start(table)
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).combine_chunks().to_batches()
                size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _group_bounds(table: pa.Table, key: list[str]) -> np.ndarray:
    n = table.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for c in key:
        column = table.column(c).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.r_[np.flatnonzero(new), n]


def _tiled(rows: DataFrame, count: str) -> DataFrame:
    """Rows of groups with the tiles (i, j) that they take part in, i <= j, and the side; `count` columns
    say into how many parts a group is cut."""
    own = F.pmod(F.xxhash64("set"), F.col(count)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    return rows.select(
        "*",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("right"),
    ).drop("other", count)


def _pairs(bounds: np.ndarray, i: np.ndarray, j: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows to compare: all of a tile on the diagonal, else one of each side."""
    out_a, out_b = [], []
    sizes = np.diff(bounds)
    for size in np.unique(sizes[sizes > 1]):  # groups of one size at a time
        a, b = np.triu_indices(size, 1)
        starts = bounds[:-1][sizes == size]
        step = max(1, 4_000_000 // len(a))
        for at in range(0, len(starts), step):
            s = starts[at : at + step, None]
            p, q = (s + a).ravel(), (s + b).ravel()
            want = (i[p] == j[p]) | (right[p] != right[q])
            out_a.append(p[want])
            out_b.append(q[want])
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _compare_signatures(rows: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) between sets of a bucket's tile that look similar: a tree for each connected part."""
    least = least_equal(similarity)
    key = ["node", "i", "j"]

    def run(batches):
        for table in _runs_of(batches, key, 8 << 20):
            sig = _signatures(table.column("signature"))
            label = table.column("label").to_pylist()
            _, label = np.unique(np.array([x or b"" for x in label], dtype=object), return_inverse=True)
            i, j, right = (table.column(c).to_numpy() for c in ("i", "j", "right"))
            none = np.array([x is None for x in table.column("label").to_pylist()])
            a, b = _pairs(_group_bounds(table, key), i, j, right)
            apart = (label[a] != label[b]) | none[a]  # the others are connected already
            a, b = a[apart], b[apart]
            kept = np.zeros(len(a), bool)
            for at in range(0, len(a), 65_536):
                p, q = a[at : at + 65_536], b[at : at + 65_536]
                kept[at : at + 65_536] = (sig[p] == sig[q]).sum(1) >= least
            # Roots are the smallest sets, so that buckets with like members give like edges.
            sets = table.column("set").combine_chunks()
            order = np.argsort(np.array(sets.to_pylist(), dtype=object), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            root = order[_links_to_roots(len(order), place[a[kept]], place[b[kept]])][place]
            linked = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays(
                [sets.take(pa.array(root[linked])).cast(pa.binary()), sets.take(pa.array(linked)).cast(pa.binary())],
                names=["a", "b"],
            )

    sorted_rows = rows.repartition(*key).sortWithinPartitions(*key)
    return sorted_rows.mapInArrow(run, "a binary, b binary").distinct()


def _small(df: DataFrame) -> DataFrame:
    """With a hint to send it to all tasks if it has few rows (it must be a written table)."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _pivot_edges(sets: DataFrame, similarity: float) -> DataFrame:
    """Edges (pivot, set) between sets of the large root buckets of the first runs and their pivots."""
    least = least_equal(similarity)
    level = stage(_split(sets.select("set", "signature"), list(range(FIRST_RUNS))), "level")
    drawn = [F.min(F.struct(F.xxhash64("set", F.lit(k)).alias("order"), "set"))["set"] for k in range(PIVOTS)]
    large = level.groupBy("node").agg(F.count("*").alias("size"), F.array(*drawn).alias("pivots")).filter(F.col("size") > SMALL)
    # A row for each set and large bucket, whatever the pivots: buckets with like members have like pivots, so a set
    # meets each pivot once, after its buckets' pivots are put together.
    large = stage(large.select("node", "pivots"), "pivots")
    met = level.join(_small(large), "node").groupBy("set").agg(F.array_distinct(F.flatten(F.collect_set("pivots"))).alias("pivots"))
    pairs = met.select(F.explode("pivots").alias("pivot"), "set").filter("set != pivot")
    pairs = stage(pairs, "pivot-pairs")
    centres = sets.select(F.col("set").alias("pivot"), F.col("signature").alias("other"))
    centres = stage(centres.join(pairs.select("pivot").distinct(), "pivot", "left_semi"), "centres")
    signed = pairs.join(_small(centres), "pivot").join(sets.select("set", "signature"), "set")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                equal = (_signatures(batch.column("signature")) == _signatures(batch.column("other"))).sum(1)
                near = batch.filter(pa.array(equal >= least))
                columns = [near.column(c).cast(pa.binary()) for c in ("pivot", "set")]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return stage(signed.mapInArrow(run, "a binary, b binary"), "pivot-edges")


def _placed(level: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sets of the buckets that still have something to compare: node, set, label, large and the parts of its tiles.

    Large is a bucket with more open pairs (of sets that are not connected) than SMALL for each set. The sets
    with a bucket's most frequent label are its parts 0 to p - 1, the others the next q parts. Rows that met their
    bucket are written, as the labels of large buckets are counted from the same rows.
    """
    live = stage(level.join(_small(sizes), "node"), "open")
    own = F.coalesce("label", "set")
    labels = live.filter(F.col("size") > SMALL).groupBy("node", own.alias("own")).agg(F.count("*").alias("n"))
    tops = labels.groupBy("node").agg(F.max(F.struct("n", "own")).alias("top"), F.sum(F.col("n") * F.col("n")).alias("same"))
    tops = stage(tops, "tops")
    parts = [F.greatest(F.ceil(n / TILE_SETS), F.lit(1)).cast("int") for n in (F.col("top.n"), F.col("size") - F.col("top.n"))]
    live = live.join(_small(tops), "node", "left").withColumns({"p": parts[0], "q": parts[1]})
    open_pairs = F.col("size") * F.col("size") - F.col("same")
    large = F.coalesce(open_pairs > F.col("size") * SMALL, F.lit(False))
    common = F.coalesce(own == F.col("top.own"), F.lit(False))
    return live.select("node", "set", "label", large.alias("large"), common.alias("common"), F.coalesce("p", F.lit(0)).alias("p"), F.coalesce("q", F.lit(1)).alias("q"))


def _open_tiles(rows: DataFrame) -> DataFrame:
    """Rows of `_placed` with the tiles that they take part in. Sets with the most frequent label are not
    compared with each other, so a large connected group with a few strays costs no more than its size."""
    at = F.xxhash64("set")
    own = F.when(F.col("common"), F.pmod(at, F.col("p"))).otherwise(F.col("p") + F.pmod(at, F.col("q"))).cast("int")
    other = F.explode(F.sequence(F.when(F.col("common"), F.col("p")).otherwise(F.lit(0)), F.col("p") + F.col("q") - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    right = (F.col("own") > F.col("other")).alias("right")
    return rows.select("node", "set", "label", "signature", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), right)


def _candidate_edges(sets: DataFrame, runs: list[int], labels: DataFrame, similarity: float) -> DataFrame:
    """Edges found by some runs of the chosen-path recursion, beyond what labels connect."""
    edges = None
    level = _split(sets.select("set", "signature"), runs)
    for depth in range(1, DEPTH + 1):
        level = level.join(labels.select(F.col("vertex").alias("set"), "label"), "set", "left")
        level = stage(level, "level")
        own = F.coalesce("label", "set")
        sizes = level.groupBy("node").agg(F.count("*").alias("size"), F.min(own).alias("low"), F.max(own).alias("high"))
        sizes = stage(sizes.filter("size > 1 and low != high").select("node", "size"), "sizes")
        live = stage(_placed(level, sizes), "live")
        if not live.take(1):
            break
        last = depth == DEPTH
        signed = live.join(sets.select("set", "signature"), "set")
        found = _compare_signatures(_open_tiles(signed if last else signed.filter("not large")), similarity)
        edges = found if edges is None else edges.union(found)
        if last or not live.filter("large").take(1):
            break
        level = _split(signed.filter("large").select("node", "set", "signature"))
    return edges


def _exact(rows: DataFrame, similarity: float) -> DataFrame:
    """Of each set and tile: documents linked with it, and the smallest set that it is connected with."""
    key = ["group", "i", "j"]

    def run(batches):
        for table in _runs_of(batches, key, 2 * TILE_BYTES):
            bounds = _group_bounds(table, key)
            sets = table.column("set").to_pylist()
            data = table.column("data").to_pylist()
            copies, right = table.column("copies").to_numpy(), table.column("right").to_numpy()
            diagonal = table.column("i").to_numpy() == table.column("j").to_numpy()
            out = {"set": [], "links": [], "root": []}
            for start, stop in zip(bounds[:-1], bounds[1:]):
                shingles = [np.frombuffer(d, np.uint64) for d in data[start:stop]]
                a, b = linked_pairs(shingles, similarity, None if diagonal[start] else right[start:stop])
                if not len(a):
                    continue
                order = np.argsort(np.array(sets[start:stop], dtype=object), kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                root = order[_links_to_roots(len(order), place[a], place[b])][place]
                links = np.zeros(stop - start, np.int64)
                np.add.at(links, a, copies[start:stop][b])
                np.add.at(links, b, copies[start:stop][a])
                for k in np.flatnonzero(links):
                    out["set"].append(sets[start + k])
                    out["links"].append(int(links[k]))
                    out["root"].append(sets[start + int(root[k])])
            yield pa.RecordBatch.from_pydict(out, schema=types)

    schema = "set binary, links long, root binary"
    types = arrow_schema(rows.sparkSession, schema)
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)


def linked_pairs(
    sets: list[np.ndarray], similarity: float, right: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with at least that Jaccard similarity; with `right`, only across the two sides."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.r_[True, values[1:] != values[:-1]]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1  # what one set alone has is in no intersection
    owner, column = owner[shared], column[shared]
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = max(256, (8 << 20) // max(1, len(sets)) // 4)
    for start in range(0, int(column[-1]) + 1, width):
        at = slice(*np.searchsorted(column, [start, start + width]))
        block = np.zeros((len(sets), width), np.float32)
        block[owner[at], column[at] - start] = 1
        common += block @ block.T
    out_a, out_b = [], []
    step = max(1, (1 << 20) // len(sets))
    for start in range(0, len(sets), step):
        at = slice(start, start + step)
        union = sizes[at, None] + sizes - common[at]
        near = np.triu(common[at] >= similarity * union - 1e-6 * union, start + 1)
        if right is not None:
            near &= right[at, None] != right
        a, b = np.nonzero(near)
        out_a.append(a + start)
        out_b.append(b)
    return np.concatenate(out_a), np.concatenate(out_b)


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """key, class_id and n_links of every row.

    n_links: other rows whose shingle set has the similarity or more, exact copies included.
    class_id: the smallest key among all rows that links connect. Rows without words (null
    and empty texts too) have no links and are their own class; repeated rows are copies of
    each other; null keys are allowed. An empty table gives no rows.
    """
    rows = stage(_sets(docs, key, text, full=False), "rows")
    sets = rows.filter("set is not null").groupBy("set").agg(
        F.count("*").alias("copies"), F.min("key").alias("first"), F.first("data").alias("signature")
    )
    sets = stage(sets, "sets")
    total = runs_needed(similarity=similarity)
    groups = connected_components(_pivot_edges(sets, similarity))
    more = _candidate_edges(sets, list(range(total)), groups, similarity)
    if more is not None and (more := stage(more, "more")).take(1):
        groups = connected_components(groups.select(F.col("label").alias("a"), F.col("vertex").alias("b")).union(more))
    if not groups.take(1):
        linked = sets.select("set", F.lit(0).cast("long").alias("links"), F.col("set").alias("root")).limit(0)
    else:
        linked = _verify(docs, key, text, sets, groups, similarity)
    known = sets.join(linked, "set", "left").withColumn("root", F.coalesce("root", "set"))
    heads = known.groupBy("root").agg(F.min("first").alias("class_id"))
    known = stage(known.join(heads, "root").select("set", "copies", "class_id", F.coalesce("links", F.lit(0)).alias("links")), "known")
    out = rows.select("key", "set").join(known, "set", "left")
    return out.select(
        F.col("key").alias(key),
        F.when(F.col("copies").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
    )


def _verify(docs: DataFrame, key: str, text: str, sets: DataFrame, groups: DataFrame, similarity: float) -> DataFrame:
    """set, links and root of the sets with exact links, from one document of each candidate set."""
    wanted = sets.join(groups.withColumnRenamed("vertex", "set"), "set").select("set", "copies", "first", "label")
    wanted = stage(wanted, "wanted")
    firsts = _small(stage(wanted.select("first").distinct(), "firsts"))
    chosen = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    chosen = chosen.join(firsts, F.col("_key").eqNullSafe(F.col("first")), "left_semi")
    full = _sets(chosen, "_key", "_text", full=True).filter("set is not null").select("set", "data")
    full = full.join(wanted.select("set", "copies", "label"), "set").dropDuplicates(["set"])
    full = stage(full.withColumn("group", F.xxhash64("label")), "candidates")
    parts = stage(_parts(full), "parts")
    tiled = _tiled(full.drop("label").join(parts, "group"), "parts")
    found = stage(_exact(tiled, similarity), "links")
    if not parts.filter("parts > 1").take(1):
        return found  # each group was one tile
    counted = found.groupBy("set").agg(F.sum("links").alias("links"))
    # What several tiles of a group found is connected once more.
    tree = connected_components(found.select(F.col("root").alias("a"), F.col("set").alias("b")))
    return counted.join(tree.withColumnsRenamed({"vertex": "set", "label": "root"}), "set")


def _parts(full: DataFrame) -> DataFrame:
    """Into how many parts each group is cut, so that no side of a tile has too many shingles or sets."""
    most = F.greatest(F.sum(F.length("data")) / TILE_BYTES, F.count("*") / TILE_SETS)
    return full.groupBy("group").agg(F.ceil(most).cast("int").alias("parts"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs`, all columns, without near duplicates: of each class the row with the smallest key stays.

    A null key is the largest; of rows with equal keys in one class any one stays.
    """
    number = "_row_number"
    while number in docs.columns:
        number += "_"
    numbered = stage(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    classes = join(numbered.select(F.col(number).alias("_row"), F.col(text).alias("_text")), "_row", "_text", similarity)
    keys = numbered.select(F.col(number).alias("_row"), F.col(key).alias("_key"))
    rank = F.struct(F.col("_key").isNull().alias("no_key"), "_key", "_row")
    firsts = classes.join(keys, "_row").groupBy("class_id").agg(F.min(rank).alias("first"))
    return numbered.join(firsts.select(F.col("first._row").alias(number)), number, "left_semi").drop(number)

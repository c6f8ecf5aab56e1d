"""Nearest neighbours by inner product: an inverted file whose lists are scanned dimension
by dimension.

Vectors get one more component that makes all norms equal, so the largest inner product
is the smallest distance. Each is filed under the nearest centre; a query visits the
nearest lists, and twice as many again where they gave fewer than it asks for. There, vectors are compared in a randomly rotated space in blocks of
columns: after each block a hypothesis test on the partial distance abandons the
candidates that are too far with high confidence. Survivors get exact scores.

Lists and the queries that visit them are cut into parts of bounded size, so a list that
holds a large share of all vectors becomes many tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronostar.llm.common import hash_sample
from chronostar.session import stage

#: Vectors that the centres are fitted on, about, drawn by a hash of their id.
SAMPLE_ROWS = 20_000
#: Vectors, and visits of queries, in one part of a list.
PART_ROWS, PART_VISITS = 8192, 1024
COLUMN_BLOCK = 16
#: Of the test: larger abandons later.
EPSILON = 2.1
_ITERATIONS = 12
_TILE = 1024  # points whose partial distances to all queries of a part are held at once
_THIN = 0.15  # share of pairs alive below which they are held as a list
#: The lists to visit are as many as find this share of the neighbours within the sample.
TARGET_RECALL = 0.96
_TRIALS = 256
_SLICE = 256


@dataclass
class ListModel:
    centres: np.ndarray
    rotation: np.ndarray
    norm: float  # the largest of all vectors
    probes: int  # lists that a query visits
    sample_ids: np.ndarray
    sample: np.ndarray  # as it is, and rotated
    turned: np.ndarray
    sample_lists: np.ndarray  # in which list each is
    sizes: np.ndarray | None = None  # vectors of each list

    def extended(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors.astype(np.float64) ** 2).sum(1), 0))
        return np.c_[vectors, rest].astype(np.float32)

    def nearest_lists(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """Numbers of the nearest centres of extended vectors, in no order."""
        distance = (self.centres**2).sum(1) - 2 * vectors @ self.centres.T
        count = min(count, len(self.centres))
        return np.argpartition(distance, count - 1, axis=1)[:, :count]

    def visited_lists(self, vectors: np.ndarray, count: int, least: int) -> np.ndarray:
        """Of each query, as a mask: the nearest lists, so many and more until they hold `least` vectors."""
        distance = (self.centres**2).sum(1) - 2 * vectors @ self.centres.T
        order = np.argsort(distance, axis=1, kind="stable")
        held = np.cumsum(self.sizes[order], axis=1) - self.sizes[order]  # by the lists before
        wanted = (np.arange(len(self.centres)) < count) | (held < least)
        mask = np.zeros(distance.shape, bool)
        np.put_along_axis(mask, order, wanted, axis=1)
        return mask

    def reach(self, ids: np.ndarray, turned: np.ndarray, visited: np.ndarray, k: int) -> np.ndarray:
        """For each query a squared distance that k vectors of the sample in its visited lists are within."""
        if len(self.sample) < k:
            return np.full(len(ids), np.inf, np.float32)
        distance = (turned**2).sum(1)[:, None] + (self.turned**2).sum(1) - 2 * turned @ self.turned.T
        distance[(ids[:, None] == self.sample_ids) | ~visited[:, self.sample_lists]] = np.inf
        return np.maximum(np.partition(distance, k - 1, axis=1)[:, k - 1], 0).astype(np.float32)


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """_id and _vector of the rows that take part: no null, zero or non-finite vectors, and
    only those of the most frequent length; rows without id are left out."""
    limit = F.lit(float(np.finfo(np.float32).max))
    kept = vectors.select(F.col(key).cast("long").alias("_id"), F.col(column).cast("array<float>").alias("_vector"))
    kept = kept.filter(
        F.col("_id").isNotNull()
        & F.col("_vector").isNotNull()
        & F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= limit))
        & F.exists("_vector", lambda x: x != 0)
    )
    sizes = kept.groupBy(F.size("_vector").alias("n")).count()
    top = sizes.orderBy(F.desc("count"), "n").limit(1).collect()
    return kept.filter(F.size("_vector") == (top[0]["n"] if top else 0))


def fit(vectors: DataFrame, k: int) -> ListModel | None:
    """Centres from a bounded sample, about one for the root of the row count; None if no
    vector is usable. How many lists to visit is measured on the sample: enough to find
    TARGET_RECALL of its own k nearest neighbours (which lie farther apart than those of
    all vectors, so it errs to the safe side)."""
    squares = F.aggregate("_vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    count, norm = vectors.agg(F.count("*"), F.max(F.sqrt(squares))).first()
    if not count:
        return None
    drawn = hash_sample(vectors, ["_id"], SAMPLE_ROWS, count).select("_id", "_vector").toArrow()
    if not drawn.num_rows:  # so few vectors that none was drawn
        drawn = vectors.select("_id", "_vector").limit(SAMPLE_ROWS).toArrow()
    ids, at = np.unique(drawn.column("_id").to_numpy(), return_index=True)
    sample = _matrix(drawn.column("_vector").combine_chunks())[at]
    random = np.random.default_rng(7)
    width = sample.shape[1] + 1
    rotation = np.linalg.qr(random.normal(size=(width, width)))[0].astype(np.float32)
    model = ListModel(np.zeros((1, width), np.float32), rotation, float(norm), 1, ids, sample, sample, np.zeros(len(ids), int))
    points = model.extended(sample)
    lists = int(np.clip(math.isqrt(count), 1, max(1, len(points) // 8)))
    model.centres = points[random.choice(len(points), lists, replace=False)]
    for _ in range(_ITERATIONS):
        own = model.nearest_lists(points, 1)[:, 0]
        sums = np.zeros((lists, width))
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=lists)
        full = sizes > 0
        model.centres[full] = (sums[full] / sizes[full, None]).astype(np.float32)
    model.turned = points @ rotation
    own = model.sample_lists = model.nearest_lists(points, 1)[:, 0]
    trial = random.choice(len(points), min(_TRIALS, len(points)), replace=False)
    product = sample[trial] @ sample.T
    product[np.arange(len(trial)), trial] = -np.inf
    nearest = np.argsort(-product, axis=1, kind="stable")[:, : max(1, min(k, len(points) - 1))]
    order = np.argsort((model.centres**2).sum(1) - 2 * points[trial] @ model.centres.T, axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(lists), axis=1)
    visits = np.sort(np.take_along_axis(place, own[nearest], axis=1).ravel())
    model.probes = int(visits[min(len(visits) - 1, math.ceil(TARGET_RECALL * len(visits)))]) + 1
    return model


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.float32)


def scan(points: np.ndarray, queries: np.ndarray, reach: np.ndarray, own: np.ndarray, k: int):
    """Pairs (query, point) that may be among a query's k nearest of these points.

    `points` and `queries` are rotated; `reach`: squared distance within which k others
    are known, by query; `own`: pairs that don't count, as a mask by tile. Column block by
    column block the partial distances grow; pairs that fail the test are abandoned.
    Dense tiles go on as matrices, thin ones as lists of pairs.
    """
    width = points.shape[1]
    kept_q, kept_p, kept_d = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for start in range(0, len(points), _TILE):
        tile = points[start : start + _TILE]
        partial = np.zeros((len(queries), len(tile)), np.float32)
        alive = ~own[:, start : start + _TILE]
        pairs = None
        for column in range(0, width, COLUMN_BLOCK):
            part = slice(column, min(column + COLUMN_BLOCK, width))
            if pairs is None:
                a, b = queries[:, part], tile[:, part]
                partial += (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
            else:
                partial += ((queries[pairs[0], part] - tile[pairs[1], part]) ** 2).sum(1)
            seen = part.stop
            slack = (seen / width) * (1 + EPSILON / math.sqrt(seen)) ** 2 if seen < width else 1 + 1e-4
            limit = reach * slack + 1e-5
            if pairs is None:
                alive &= partial <= limit[:, None]
                if np.count_nonzero(alive) < _THIN * alive.size or seen == width:
                    pairs = np.nonzero(alive)
                    partial = partial[pairs]
            else:
                near = partial <= limit[pairs[0]]
                pairs, partial = (pairs[0][near], pairs[1][near]), partial[near]
        kept_q.append(pairs[0])
        kept_p.append(pairs[1] + start)
        kept_d.append(partial)
        q, d = np.concatenate(kept_q), np.concatenate(kept_d)
        # The k-th distance found so far narrows the reach of the tiles that follow.
        order = np.lexsort((d, q))
        first = np.searchsorted(q[order], np.arange(len(queries)))
        has = np.flatnonzero(np.bincount(q, minlength=len(queries)) >= k)
        reach[has] = np.minimum(reach[has], d[order][first[has] + k - 1])
    q, p, d = np.concatenate(kept_q), np.concatenate(kept_p), np.concatenate(kept_d)
    near = d <= reach[q] * (1 + 1e-4) + 1e-5
    return q[near], p[near]


def best_of(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best: larger score, then smaller id; repeated rows once."""
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    new = np.r_[True, (q[1:] != q[:-1]) | (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])][: len(q)]
    order, q = order[new], q[new]
    first = np.searchsorted(q, q)
    return order[np.arange(len(q)) - first < k]


def search(
    vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k nearest found of each row of `queries`.

    All usable rows of `vectors` are candidates but those with the query's own id. Scores
    are inner products of the original vectors in double precision; ties go to the smaller
    id. Repeated rows count once. An empty table gives no rows. Other columns are not read.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    # A repeated row is one vector: the scans count to k.
    points = stage(usable(vectors, key, column).dropDuplicates(["_id", "_vector"]), "points")
    model = fit(points, k)
    if model is None:
        return spark.createDataFrame([], schema)
    asked = usable(queries, key, column).filter(F.size("_vector") == len(model.rotation) - 1)
    asked = stage(asked.dropDuplicates(["_id", "_vector"]), "asked")
    filing = spark.sparkContext.broadcast(model)  # bounded by SAMPLE_ROWS

    def file(batches):
        model = filing.value
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                lists = model.nearest_lists(model.extended(_matrix(part.column("_vector"))), 1)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists, pa.int32()), part.column("_id"), part.column("_vector")],
                    names=["_list", "_id", "_vector"],
                )

    filed = stage(points.mapInArrow(file, "_list int, _id long, _vector array<float>"), "filed")
    model.sizes = np.zeros(len(model.centres), np.int64)
    for row in filed.groupBy("_list").count().collect():  # as many as centres: SAMPLE_ROWS / 8 or so
        model.sizes[row["_list"]] = row["count"]
    shared = spark.sparkContext.broadcast(model)
    done, lists, free = [], model.probes, False
    while True:
        found = stage(_visit(filed, asked, shared, k, lists, free), "found")
        full = found.filter(F.col("rank") == k).select(F.col("query_id").alias("_id"))
        short = stage(asked.join(full, "_id", "left_anti"), "short")
        if free and lists >= len(model.centres) or not short.take(1):
            done.append(found)
            break
        # The test abandoned one of the k that gave the reach, or the lists hold too few: more lists, no reach.
        done.append(found.join(full.withColumnRenamed("_id", "query_id"), "query_id", "left_semi"))
        asked, lists, free = short, 2 * lists, True
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def _visit(filed: DataFrame, asked: DataFrame, shared, k: int, lists: int, free: bool) -> DataFrame:
    """The k nearest vectors in the lists that each query visits; scans start with the sample's reach or, if free, with none."""

    def visit(batches):
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                ids, own = part.column("_id").to_numpy(), _matrix(part.column("_vector"))
                visited = model.visited_lists(model.extended(own), lists, k + 1)
                if free:
                    reach = np.full(len(ids), np.inf, np.float32)
                else:
                    turned = np.c_[own, np.zeros(len(own), np.float32)] @ model.rotation
                    reach = model.reach(ids, turned, visited, k)
                rows, numbers = np.nonzero(visited)
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers, pa.int32()),
                        *[part.column(c).take(rows) for c in ("_id", "_vector")],
                        pa.array(reach).take(rows),
                    ],
                    names=["_list", "_id", "_vector", "_reach"],
                )

    visits = stage(asked.mapInArrow(visit, "_list int, _id long, _vector array<float>, _reach float"), "visits")
    # One row a list: how many parts its vectors and its visits make.
    parts = filed.groupBy("_list").agg(F.count("*").alias("_rows"))
    parts = parts.join(visits.groupBy("_list").agg(F.count("*").alias("_visits")), "_list").select(
        "_list",
        F.ceil(F.col("_rows") / PART_ROWS).cast("int").alias("_a"),
        F.ceil(F.col("_visits") / PART_VISITS).cast("int").alias("_b"),
    )
    parts = F.broadcast(parts)  # as many rows as centres: SAMPLE_ROWS / 8 at most

    def cut(rows, own, other):
        piece = F.pmod(F.xxhash64("_id"), F.col(own)).cast("int")
        many = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return rows.join(parts, "_list").withColumn("_piece", piece).withColumn("_other", many)

    left = cut(filed, "_a", "_b").select("_list", F.col("_piece").alias("_i"), F.col("_other").alias("_j"), "_id", "_vector")
    right = cut(visits, "_b", "_a").select("_list", F.col("_other").alias("_i"), F.col("_piece").alias("_j"), "_id", "_vector", "_reach")
    place = ["_list", "_i", "_j"]

    def compare(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        q = ids = np.zeros(0, np.int64)
        scores = np.zeros(0)
        if rows.num_rows and wanted.num_rows:
            model = shared.value
            ids, asked_ids = rows.column("_id").to_numpy(), wanted.column("_id").to_numpy()
            own = _matrix(rows.column("_vector").combine_chunks())
            points = _matrix(wanted.column("_vector").combine_chunks())
            q, p = scan(
                model.extended(own) @ model.rotation,
                np.c_[points, np.zeros(len(points), np.float32)] @ model.rotation,
                wanted.column("_reach").to_numpy().copy(),
                asked_ids[:, None] == ids,
                k,
            )
            scores = (own[p].astype(np.float64) * points[q].astype(np.float64)).sum(1)
            best = best_of(q, ids[p], scores, k)
            q, ids, scores = asked_ids[q[best]], ids[p[best]], scores[best]
        return pa.table({"query_id": q, "vec_id": ids, "score": scores})

    near = (
        left.groupBy(*place)
        .cogroup(right.groupBy(*place))
        .applyInArrow(compare, "query_id long, vec_id long, score double")
    )
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.dense_rank().over(by)).filter(F.col("rank") <= k)
    return ranked.dropDuplicates(["query_id", "rank"]).select("query_id", "rank", "vec_id", "score")

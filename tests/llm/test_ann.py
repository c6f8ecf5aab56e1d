import numpy as np
import pytest
from pyspark.sql import functions as F

from chronostar.llm import ann, queries

from .brute import table

SF = "/root/testdata/sf0.01"


def nearest(ids, vectors, query, k):
    scores = (vectors * vectors[query]).sum(1)
    scores[ids == ids[query]] = -np.inf
    return ids[np.lexsort((ids, -scores))[:k]]


def test_recall_of_the_query(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 150)  # so that the sample is a part of the table
    rows = table(SF, "embeddings")
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], np.float32).astype(float)
    got = queries.op2_neighbours(spark, SF).toPandas()
    found = 0
    asked = np.flatnonzero(ids % 20 == 0)
    for q in asked:
        own = got[got.query_id == ids[q]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        at = [int(np.flatnonzero(ids == i)[0]) for i in own.vec_id]
        np.testing.assert_allclose(own.score, (vectors[at] * vectors[q]).sum(1), rtol=0, atol=1e-12)
        assert own.vec_id.tolist() == own.sort_values(["score", "vec_id"], ascending=[False, True]).vec_id.tolist()
        found += len({*own.vec_id} & {*nearest(ids, vectors, q, 20)})
    assert found >= 0.9 * 20 * len(asked)


def test_hot_vector_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 16)
    monkeypatch.setattr(ann, "PART_VISITS", 4)
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 40)
    random = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(100)] + [(100 + i, random.normal(size=3).tolist()) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(frame, frame.filter("vec_id < 10"), 5).orderBy("query_id", "rank").collect()
    for q in range(10):
        assert [r.vec_id for r in got if r.query_id == q] == [i for i in range(6) if i != q][:5]


def test_results_are_of_the_visited_lists(spark, monkeypatch):
    """With the whole table as sample, and one list visited, what other lists hold is not found."""
    random = np.random.default_rng(3)
    vectors = random.normal(size=(400, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    fit, models = ann.fit, []

    def one_list(*args):
        models.append(fit(*args))
        models[0].probes = 1
        return models[0]

    monkeypatch.setattr(ann, "fit", one_list)
    got = ann.search(frame, frame.filter("vec_id < 60"), 3).toPandas()
    assert got.groupby("query_id").size().tolist() == [3] * 60
    model, found = models[0], 0
    at = np.argsort(model.sample_ids)
    filed = model.sample_lists[at]
    for q in range(60):
        order = np.argsort((model.centres**2).sum(1) - 2 * model.extended(vectors[q : q + 1])[0] @ model.centres.T)
        before = np.cumsum(model.sizes[order]) - model.sizes[order]
        lists = {*order[(np.arange(len(order)) < 1) | (before < 4)]}
        own = got[got.query_id == q]
        found += all(filed[i] in lists for i in own.vec_id)
    assert found >= 50  # the others lost a vector to the test, and visited twice as many


def test_fewer_than_k_vectors(spark):
    frame = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(4)], "vec_id long, embedding array<float>")
    got = ann.search(frame, frame, 20).collect()
    assert sorted((r.query_id, r.vec_id) for r in got) == [(a, b) for a in range(4) for b in range(4) if a != b]


@pytest.mark.parametrize("sample", [60, 20_000])
def test_repeated_rows_do_not_hide_others(spark, monkeypatch, sample):
    """A near vector that is stored 50 times takes one of the k places."""
    monkeypatch.setattr(ann, "SAMPLE_ROWS", sample)
    random = np.random.default_rng(5)
    vectors = np.r_[[[1.0, 0, 0, 0], [0.999, 0, 0, 0]], random.normal(size=(400, 4)) * 0.1]
    vectors[2:22, 0] = np.linspace(0.9, 0.95, 20)
    vectors[:, 3] = np.sqrt(np.maximum(0, 1.5 - (vectors[:, :3] ** 2).sum(1)))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1, vectors[1].tolist())] * 50
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(ann, "TARGET_RECALL", 1.0)
    got = ann.search(frame, frame.filter("vec_id = 0"), 10).orderBy("rank").collect()
    stored = vectors.astype(np.float32).astype(float)
    assert [r.vec_id for r in got] == nearest(np.arange(len(stored)), stored, 0, 10).tolist()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, []), (10, [-1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = ann.search(frame, frame, 20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [
        (1, 1, 2, 0.5), (1, 2, 10, -1.0), (2, 1, 1, 0.5), (2, 2, 10, -0.5), (10, 1, 2, -0.5), (10, 2, 1, -1.0),
    ]
    assert ann.search(frame.limit(0), frame, 3).count() == 0
    assert ann.search(frame.filter("vec_id = 3"), frame, 3).count() == 0

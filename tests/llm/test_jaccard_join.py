import random
import tracemalloc

import pytest

from chronostar.llm import jaccard_join, queries
from chronostar.llm.components import connected_components

from .brute import near_duplicates, shingles, table
from .conftest import SF


def copies(rnd, words, groups, largest):
    rows = []
    for _ in range(groups):
        base = rnd.choices(words, k=rnd.randint(3, 200))
        for _ in range(rnd.choice([1, 1, 2, 5, largest])):
            own = list(base)
            for _ in range(rnd.randint(0, 4)):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            rows.append((len(rows), " ".join(own)))
    return rows


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(SF, "documents")]
    got = queries.op5_jaccard_join(spark, SF).collect()
    assert sorted(map(tuple, got)) == near_duplicates(rows)


def test_split_buckets_and_tiles(docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "TILE_SETS", 5)
    monkeypatch.setattr(jaccard_join, "TILE_BYTES", 6000)
    rnd = random.Random(5)
    rows = copies(rnd, [f"w{i}" for i in range(500)], 12, 25)
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "..."), (len(rows) + 3, rows[0][1])]
    assert sorted(map(tuple, jaccard_join.join(docs(rows)).collect())) == near_duplicates(rows)


def test_lower_similarity(docs):
    rnd = random.Random(6)
    rows = copies(rnd, [f"w{i}" for i in range(500)], 12, 15)
    got = jaccard_join.join(docs(rows), similarity=0.4)
    assert sorted(map(tuple, got.collect())) == near_duplicates(rows, 0.4)


def test_components(spark):
    rnd = random.Random(4)
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(300, 300)]
    pairs += [(rnd.randrange(400, 500), rnd.randrange(400, 500)) for _ in range(40)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.vertex: r.label for r in got.collect()} == {v: top(v) for v in list(parent)}


def test_edges(docs):
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (None, "c d e f g h"), (5, None)]
    got = sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in jaccard_join.join(docs(rows)).collect())
    assert got == [(0, 0, 0), (0, 1, 2), (1, 1, 2), (1, 1, 2), (5, 5, 0)]
    assert jaccard_join.join(docs([])).count() == 0
    kept = jaccard_join.keep_first(docs(rows))
    assert kept.columns == docs([]).columns
    assert sorted(r.text or "" for r in kept.collect()) == ["", "a b", "c d e f g h"]


def test_the_smallest_key_stays(spark):
    rows = [(7, "a b c", 1), (3, "a b c", 2), (None, "a b c", 3), (5, "x y", 4), (None, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row_number int").repartition(3)
    kept = jaccard_join.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r._row_number for r in kept.collect()) == [2, 4, 5]


def test_shingles_and_signatures():
    texts = ["", "one", "a b c d e f", "A b, c d e f!", "a b c d e " * 50]
    sets = jaccard_join.shingle_sets(texts)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert (sets[2] == sets[3]).all() and (jaccard_join.signature(sets[2]) == jaccard_join.signature(sets[3])).all()


def test_pairs_at_the_bound_meet_in_large_buckets():
    np = jaccard_join.np
    runs = jaccard_join.runs_needed()
    places = [p for r in range(runs) for p in jaccard_join.root_places(r)]
    assert len(places) == len({*places}) == 2 * runs
    least = jaccard_join.least_equal()
    assert jaccard_join.expected_recall(runs, 0.8, least) >= jaccard_join.TARGET_RECALL
    random = np.random.default_rng(11)
    a, b = random.integers(0, 1 << 32, (2, 40_000, jaccard_join.PLACES), np.uint32)
    same = random.random(a.shape) < 0.8
    b[same] = a[same]
    met = np.zeros(len(a), bool)
    for run in range(runs):  # down to the full depth, as if no bucket were small
        (at, own), (_, other) = jaccard_join._root_children(run, a), jaccard_join._root_children(run, b)
        for depth in range(jaccard_join.DEPTH):
            at, own = at[own == other], own[own == other]
            if depth + 1 < jaccard_join.DEPTH:
                (k, child), (_, other) = jaccard_join._children(own, a[at]), jaccard_join._children(own, b[at])
                at, own = at[k], child
        met[at] = True
    met &= same.sum(1) >= least
    assert len(met) - met.sum() <= 12  # 4 are expected; 49 with roots drawn by the hash


def test_runs_reach_the_target():
    assert jaccard_join.runs_needed(0.9999) > jaccard_join.runs_needed(0.9) >= 1
    assert jaccard_join.runs_needed(0.99, 0.95) <= jaccard_join.runs_needed(0.99, 0.8)


@pytest.mark.parametrize("similarity", [0.3, 0.8])
def test_pairs(similarity):
    rnd = random.Random(2)
    sets = [jaccard_join.np.unique(jaccard_join.np.array(rnd.choices(range(30), k=20), "u8")) for _ in range(20)]
    a, b = jaccard_join.linked_pairs(sets, similarity, None)
    own = [set(s.tolist()) for s in sets]
    assert sorted(zip(a.tolist(), b.tolist())) == [
        (i, j) for i in range(20) for j in range(i + 1, 20) if len(own[i] & own[j]) >= similarity * len(own[i] | own[j])
    ]


def test_tiles_of_short_texts_are_bounded_by_sets(spark):
    full = spark.range(5000).selectExpr("id % 2 * id AS `group`", "cast(repeat('x', 80) AS binary) AS data")
    parts = {r.group: r.parts for r in jaccard_join._parts(full).collect()}
    assert parts[0] == -(-2500 // jaccard_join.TILE_SETS) and parts[1] == 1


def test_memory_of_a_tile():
    np = jaccard_join.np
    sets = [np.array([*range(9), 100 + i], "u8") for i in range(2 * jaccard_join.TILE_SETS)]
    tracemalloc.start()
    a = jaccard_join.linked_pairs(sets, 0.9, None)[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not len(a) and peak < 70e6


def test_a_set_meets_a_bucket_once_whatever_its_pivots(docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*base, f"x{rnd.randrange(1000)}"])) for i in range(40)]
    staged, stage = {}, jaccard_join.stage

    def spy(df, label, *rest):
        return staged.setdefault(label, stage(df, label, *rest))

    monkeypatch.setattr(jaccard_join, "stage", spy)
    sets = stage(jaccard_join._sets(docs(rows), "doc_id", "text", full=False).selectExpr("set", "data AS signature").distinct(), "sets")
    edges = jaccard_join._pivot_edges(sets, 0.8)
    nodes = [r["node"] for r in staged["pivots"].collect()]
    assert nodes and len(nodes) == len(set(nodes))
    pairs = [tuple(r) for r in staged["pivot-pairs"].select("pivot", "set").collect()]
    assert len(pairs) == len(set(pairs)) and all(a != b for a, b in pairs)
    assert {x for r in edges.collect() for x in r} == {r["set"] for r in sets.collect()}


def test_a_level_meets_its_buckets_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    joined, stage = [], jaccard_join.stage
    rows = [(n, b"%d" % s, b"0" if s < 3 else None) for n, size in ((1, 9), (2, 3)) for s in range(size)]
    level = stage(spark.createDataFrame(rows, "node long, set binary, label binary"), "level")
    sizes = stage(spark.createDataFrame([(1, 9)], "node long, size long"), "sizes")

    def spy(df, label, *rest):
        joined.append(df)
        return stage(df, label, *rest)

    monkeypatch.setattr(jaccard_join, "stage", spy)
    placed = jaccard_join._placed(level, sizes)
    got = sorted((r["node"], bytes(r["set"]), r["large"], r["common"], r["p"], r["q"]) for r in placed.collect())
    assert got == [(1, b"%d" % s, True, s < 3, 1, 1) for s in range(9)]
    files = set(level.inputFiles())
    assert sum(bool(files & set(df.inputFiles())) for df in [*joined, placed]) == 1

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from chronostar.llm import minmax_dedup, queries
from chronostar.llm.oracles import ORACLE_SQL

from .brute import table
from .conftest import SF

ASCII = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text):
    words = [w for w in (text or "").translate(ASCII).translate(dict.fromkeys(b"\t\n\x0b\x0c\r", " ")).split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows, percent=85):
    """(n_shingles, component_id, kept) by key; keys differ."""
    sets = {k: shingles(t) for k, t in rows}
    holders, parent = defaultdict(list), {k: k for k in sets}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k in sorted(sets):
        common = Counter(other for s in sets[k] for other in holders[s])
        for other, n in common.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[other]) - n):
                a, b = sorted((top(k), top(other)))
                parent[b] = a
        for s in sets[k]:
            holders[s].append(k)
    return {k: (len(s), top(k), top(k) == k) for k, s in sets.items()}


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(SF, "documents")]
    result = got(queries.op11_minmax_dedup(spark, SF))
    assert result == expected(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert {r[0]: r[1:] for r in con.sql(ORACLE_SQL["op11_minmax_dedup"]).fetchall()} == result


def near_copies(seed, groups, largest):
    """Copies with few changes of a base that is not among them: pairs lie around the bound, chains occur."""
    rnd = random.Random(seed)
    words, rows = [f"w{i}" for i in range(400)], []
    for _ in range(groups):
        base = rnd.choices(words, k=rnd.randint(3, 150))
        for _ in range(rnd.choice([1, 2, 6, largest])):
            own = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            rows.append((len(rows), " ".join(own)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("sets", "shingles_", "held"), [(1024, 1 << 18, 8 << 20), (4, 300, 2000)])
def test_near_copies(docs, monkeypatch, sets, shingles_, held):
    """In one tile a group, and cut into many tiles."""
    monkeypatch.setattr(minmax_dedup, "TILE_SETS", sets)
    monkeypatch.setattr(minmax_dedup, "TILE_SHINGLES", shingles_)
    monkeypatch.setattr(minmax_dedup, "HELD_BYTES", held)
    rows = near_copies(2, 25, 40)
    want = expected(rows)
    assert sum(not kept for *_, kept in want.values()) > 50
    assert got(minmax_dedup.components(docs(rows))) == want


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (9, "A\x0bb"), (5, "a b"), (6, "x " * 300_000), (7, "x " * 200_000)]
    assert got(minmax_dedup.components(docs(rows))) == expected(rows)
    repeated = [(None, "a b c"), (3, "a b c"), (3, "A B C"), (None, "solo"), (None, None)]
    result = sorted(map(tuple, minmax_dedup.components(docs(repeated)).collect()), key=repr)
    assert result == sorted(
        [(None, 1, 3, False), (3, 1, 3, True), (3, 1, 3, True), (None, 1, None, True), (None, 0, None, True)], key=repr
    )
    assert minmax_dedup.components(docs([])).count() == 0


def test_signatures_are_unbiased_and_vary_less_than_independent_ones():
    rng = np.random.default_rng(5)
    shares = []
    for _ in range(400):
        both, a, b = rng.integers(0, 1 << 63, (3, 60), np.uint64)
        pair = [minmax_dedup.min_max(np.concatenate([both, own])) for own in (a[:20], b[:20])]
        shares.append(np.mean(np.concatenate(pair[0]) == np.concatenate(pair[1])))
    jaccard = 60 / 100
    assert abs(np.mean(shares) - jaccard) < 0.01
    # As many independent values would have this variance.
    assert np.var(shares) < 1.1 * jaccard * (1 - jaccard) / (2 * minmax_dedup.PERMUTATIONS)


def test_pairs_at_the_bound_share_a_band():
    assert minmax_dedup.expected_recall() > 0.999999
    rng = np.random.default_rng(6)
    missed = 0
    for _ in range(300):
        both, a, b = rng.integers(0, 1 << 63, (3, 170), np.uint64)
        one, two = (minmax_dedup.bands(np.concatenate([both, own[:15]])) for own in (a, b))
        missed += not (one == two).any()
    assert not missed


def test_tree_of_links_skips_what_is_connected():
    sets = [np.arange(20, dtype=np.uint64) + k for k in (0, 1, 2, 3, 100)]
    data = [s.tobytes() for s in sets]
    label = np.arange(5)
    assert minmax_dedup.tree_of_links(data, label, None, 85) == [(0, 1), (1, 2), (2, 3)]
    assert minmax_dedup.tree_of_links(data, np.array([0, 0, 0, 1, 2]), None, 85) == [(2, 3)]
    right = np.array([False, True, False, True, False])
    assert minmax_dedup.tree_of_links(data, label, right, 85) == [(0, 1), (2, 1), (2, 3)]

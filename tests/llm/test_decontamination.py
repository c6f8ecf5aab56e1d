import hashlib
import random

from chronostar.llm import decontamination, queries
from chronostar.llm.decontamination import Windows, drop_contaminated, find_contamination, search_shard

from .brute import contamination, table
from .conftest import SF


def own(texts, items, width):
    counts, spans, found = search_shard(texts, Windows(items, width))
    return [(n, sum(s["last"] - s["first"] + 1 for s in x), y) for n, x, y in zip(counts, spans, found)]


def test_index_finds_what_brute_force_finds():
    rnd = random.Random(3)
    for _ in range(150):
        words = [f"w{i}" for i in range(rnd.choice([1, 2, 3, 8]))]
        texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 30))) for _ in range(rnd.randint(1, 12))]
        texts += texts[:2]
        items = [(str(i), " ".join(rnd.choices([*words, "zz"], k=rnd.randint(0, 9)))) for i in range(6)]
        assert own(texts, items, 4) == contamination(texts, items, 4)


def test_query(spark):
    rows = table(SF, "documents")
    items = [(r["item_id"], r["text"]) for r in table(SF, "benchmark")]
    expected = dict(zip([r["doc_id"] for r in rows], contamination([r["text"] for r in rows], items)))
    got = {r.doc_id: r for r in queries.op1_decontamination(spark, SF).collect()}
    assert got.keys() == expected.keys() and any(x[1] for x in expected.values())
    for key, (words, hit, names) in expected.items():
        r = got[key]
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (words, hit, len(names), digest, hit > 0)


def test_edges_and_blocks(spark, docs, monkeypatch):
    frame = docs([(1, None), (2, ""), (3, "One two, THREE four!"), (None, "three four"), (3, "One two, THREE four!")])
    items = spark.createDataFrame(
        [(7, "one two three"), (8, "two three four"), (None, "one"), (9, None), (9, "..."), (8, "two three four")],
        "item_id long, text string",
    )

    def rows():
        found = find_contamination(frame, items, width=3).collect()
        return sorted(
            (r.doc_id or 0, r.n_words, r.n_hit, [(s.start, s.stop) for s in r.spans], r.items) for r in found
        )

    whole = [(3, 4, 4, [(0, 19)], ["7", "8"])] * 2
    expected = [(0, 2, 0, [], []), (1, 0, 0, [], []), (2, 0, 0, [], []), *whole]
    assert rows() == expected
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 5)  # every item is a pass of its own
    assert rows() == expected
    kept = drop_contaminated(frame, items, width=3)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2]
    assert find_contamination(docs([]), items).count() == 0
    assert find_contamination(frame, items.limit(0)).filter("n_hit > 0").count() == 0

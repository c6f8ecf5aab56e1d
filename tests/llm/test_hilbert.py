from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from chronostar.llm import hilbert, queries

from .brute import table
from .conftest import SF


@pytest.mark.parametrize(("dimensions", "bits"), [(1, 4), (2, 3), (3, 2), (3, 3)])
def test_curve_visits_every_cell_by_single_steps(spark, dimensions, bits):
    side = 1 << bits
    cells = spark.range(side**dimensions)
    points = [((F.col("id") / F.lit(side**k)).cast("long") % side).cast("int") for k in range(dimensions)]
    rows = cells.select(F.array(*points).alias("p"), hilbert.curve_index(points, bits).alias("i")).collect()
    order = [r.p for r in sorted(rows, key=lambda r: r.i)]
    assert sorted(r.i for r in rows) == list(range(side**dimensions))
    assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(order, order[1:]))


def check(rows, shards):
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in rows)


def test_query(spark):
    rows = queries.op7_hilbert(spark, SF).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table(SF, "documents")}
    assert Counter(r.doc_id for r in rows) == Counter(texts.keys())
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 16, crc32(texts[r.doc_id])) for r in rows)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)} and {r.shard for r in rows} == set(range(40))
    check(rows, 40)


def test_edges(docs):
    rows = hilbert.shard_documents(docs([(1, None), (None, ""), (2, "a"), (2, "a"), (3, "é" * 900)]), 3).collect()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in rows)[:2] == [(0, 16, 0), (1, 16, 0)]
    check(rows, 3)
    assert len(hilbert.shard_documents(docs([(1, "x"), (2, "y")]), 40).collect()) == 2
    assert hilbert.shard_documents(docs([]), 40).count() == 0


def test_native_plan(spark):
    plan = queries.op7_hilbert(spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))

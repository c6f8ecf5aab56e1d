import pytest

from chronostar.llm import quality, queries

from .brute import remainder, table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(SF, "labels")}
    got = queries.op4_quality(spark, SF).collect()
    assert len(got) == len(table(SF, "documents"))
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(held) > 50
    assert sum(p == y for p, y in held) >= 0.93 * len(held)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", quality.F.when(quality.held_out(quality.F.col("doc_id")), 1 - labels.quality).otherwise(labels.quality))
    some = docs.filter("doc_id < 40")
    first, second = (
        {r.doc_id: r.score for r in quality.score_documents(some, own).collect()} for own in (labels, turned)
    )
    assert first == second


@pytest.mark.parametrize("labelled", [[], [(1, 1)], [(1, 1), (2, 0), (2, None), (None, 0), (3, 7), (1, 1)]])
def test_edges(spark, docs, labelled):
    frame = docs([(1, "a good text " * 9), (2, None), (None, ""), (3, "x"), (3, "x")])
    labels = spark.createDataFrame(labelled, "doc_id long, quality int")
    got = quality.score_documents(frame, labels).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 1, 2, 3, 3]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    if not labelled:
        assert {r.score for r in got} == {0.5}
    assert len({r.score for r in got if r.doc_id in (2, None)}) == 1
    assert quality.keep_good(frame, labels).columns == frame.columns
    assert quality.score_documents(docs([]), labels).count() == 0

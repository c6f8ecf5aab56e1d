import hashlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from chronostar.llm import quality

from .brute import contamination, near_duplicates, table
from .conftest import SF


def test_rows_of_run(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scores = {r.doc_id: r.score for r in quality.score_documents(docs, labels).collect()}
    rows = [(r["doc_id"], r["text"]) for r in table(SF, "documents") if scores[r["doc_id"]] >= 0.5]
    items = [(r["item_id"], r["text"]) for r in table(SF, "benchmark")]
    classes = near_duplicates(rows)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    texts = dict(rows)
    # One of each class, and of those all that hold no benchmark window.
    members = {}
    for key, own, _ in classes:
        members.setdefault(own, []).append(key)
    clean = {key for key, (_, hit, _) in zip(texts, contamination(texts.values(), items)) if not hit}
    assert all(len([k for k in own if k in got]) <= 1 for own in members.values())
    assert all(any(k in got for k in own) for own in members.values() if all(k in clean for k in own))
    assert set(got) <= clean
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for key, r in got.items():
        ids = library.encode(texts[key], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_stages_on_odd_rows(spark, docs):
    base = docs([(1, None), (None, "a b c d e f"), (None, "a b c d e f"), (2, ""), (3, "x " * 5000)])
    for rows in (base, base.limit(0)):
        out = rows
        for _, function in corpus_pipeline.STAGES[:-1]:
            out = function(spark, out, SF)
            assert out.schema.names == rows.schema.names
            assert out.count() <= rows.count()
        assert corpus_pipeline.STAGES[-1][1](spark, out, SF).count() == out.count()

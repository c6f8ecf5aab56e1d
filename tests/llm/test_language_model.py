import numpy as np
import pytest

from chronostar.llm import language_model, queries
from chronostar.llm.elias_fano import EliasFano, NgramTrie

from .brute import Bigrams, table
from .conftest import SF


@pytest.mark.parametrize("n", [0, 1, 7, 3000])
@pytest.mark.parametrize("bits", [2, 16])
def test_sequence(n, bits):
    random = np.random.default_rng(n)
    values = np.unique(random.integers(0, (n + 1) << bits, n).astype(np.uint64))
    own = EliasFano(*EliasFano.arrays(values, bits), bits)
    assert (own[np.arange(len(values))] == values).all()
    assert (own.find(values) == np.arange(len(values))).all()
    asked = random.integers(0, (n + 9) << bits, 500).astype(np.uint64)
    assert [x in set(values.tolist()) for x in asked.tolist()] == (own.find(asked) >= 0).tolist()


def test_trie(tmp_path):
    random = np.random.default_rng(2)
    contexts = np.sort(random.integers(0, 1 << 63, 200).astype(np.uint64))
    counts = np.r_[5000, random.integers(1, 9, 199)]
    followers = np.concatenate([np.sort(random.integers(0, 1 << 32, n).astype(np.uint32)) for n in counts])
    NgramTrie.write(str(tmp_path), contexts, counts, followers, np.zeros(200, np.uint8), np.zeros(len(followers), np.uint8))
    trie = NgramTrie(str(tmp_path))
    assert (trie.find_contexts(contexts) == np.arange(200)).all()
    assert (trie.find_contexts(random.integers(0, 1 << 63, 200).astype(np.uint64)) == -1).all()
    places = np.repeat(np.arange(200), counts)
    found = trie.find_followers(places, followers)
    assert (found >= 0).all() and (np.diff(found) >= 0).all() and np.mean(found == np.arange(len(followers))) > 0.999
    other = trie.find_followers(places, random.integers(0, 1 << 32, len(followers)).astype(np.uint32))
    assert np.mean(other >= 0) < 0.001


@pytest.mark.parametrize("small", [False, True])
def test_query(spark, monkeypatch, small):
    if small:  # several batches and shards, frequent contexts spread over all of them
        monkeypatch.setattr(language_model, "BATCH_BYTES", 1 << 16)
        monkeypatch.setattr(language_model, "WORD_SHARD", 40_000)
        monkeypatch.setattr(language_model, "BIGRAM_SHARD", 30_000)
    rows = [(r["doc_id"], r["text"]) for r in table(SF, "documents")]
    model = Bigrams(rows)
    got = {r.doc_id: r for r in queries.op9_language_model(spark, SF).collect()}
    assert len(got) == len(rows)
    for (key, _), tokens, held in zip(rows, model.tokens, model.held):
        r = got[key]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held, len(tokens), model.total)
        assert r.n_known == sum(model.counts[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(model.base(tokens), rel=1e-9)
        # Half a step of the quantised levels, and the discounts that each shard fits on its own.
        assert r.score == pytest.approx(model.score(tokens), abs=0.06 * len(tokens) + 0.1)
    held = [got[key] for key, h in zip((k for k, _ in rows), model.held) if h]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(docs):
    got = sorted(language_model.score_documents(docs([(1, None), (2, ""), (None, "A b"), (None, "a B")])).collect(), key=str)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 3), (0, 3), (1, 1), (2, 1)]
    assert len({r.score for r in got if r.doc_id is None}) == 1
    assert all(r.score <= 0 and np.isfinite(r.score) for r in got)
    assert language_model.score_documents(docs([])).count() == 0
    alone = language_model.score_documents(docs([(27, "a b")])).first()  # no row to learn from
    assert alone.held_out == (Bigrams([(27, "")]).held[0]) and np.isfinite(alone.base_score)

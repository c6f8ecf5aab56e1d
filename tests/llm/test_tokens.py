"""Token counts and BPE against the libraries that define them."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from chronostar.llm import bpe, queries, token_counts

from .brute import table
from .conftest import SF

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def odd_texts():
    rnd = random.Random(1)
    out = [
        "", " ", "  a  b ", "▁x ▁", "aaaa" * 500, "ab" * 3000, "<s> </s> <unk> <0x0A>", "\x00a\x00", "İstanbul ΣΑΣ",
        "<|endoftext|> hi<|startoftext|><|ENDOFTEXT|>", "it's we'll 'Tis I'D", "é Å ﬁ", "\x1c\x1d\x85 x y", "x" * 20000,
        "abcdefgh" * 40,
    ]
    alphabets = [range(0x20, 0x7F), range(0x250), range(0x4E00, 0x4F00), range(0x1F600, 0x1F650), [0x20, 0x61, 0x62]]
    for _ in range(300):
        chars = [*rnd.choice(alphabets), *[0x20] * 5]
        out.append("".join(chr(rnd.choice(chars)) for _ in range(rnd.randint(0, 60))))
    return out


def test_counts_equal_the_library():
    texts = odd_texts()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert token_counts.counter(PIECES)(texts) == [len(x) for x in library.encode(texts, num_threads=1)]


def test_ranks_that_are_overtaken():
    # "ab" is merged once before its result with the next "a" outranks the other "ab".
    model = token_counts.PieceVocabulary.build([("a", 0.0), ("b", 0.0), ("ab", -2.0), ("aba", -1.0)])
    assert token_counts.count_sequences(model, ["abab", "ababa", "b"]).tolist() == [2, 3, 1]


@pytest.mark.parametrize("forget", [False, True])
def test_ids_and_decoding_equal_the_library(forget, monkeypatch):
    if forget:
        monkeypatch.setattr(bpe, "REMEMBERED", 0)
    encoder, library = bpe.Encoder(WORDS), Tokenizer.from_file(WORDS)
    texts = odd_texts()
    for text, own in zip(texts, encoder.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, "<u4").tolist() == ids
        assert encoder.decode(own) == library.decode(ids, skip_special_tokens=False)


def test_every_character_is_read_as_by_the_library():
    encoder, library = bpe.Encoder(WORDS), Tokenizer.from_file(WORDS)
    marks = "a\u0897\u0301 \U000113c2\U000113c2 \U0001611e\U0001611e\u0327 \U00016d67\U00016d67 e\u1ac1\u0323"
    # Beyond these planes there are ideographs, private characters and none (all of them were compared once).
    chars = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x20000), *range(0xE0000, 0xE0200))]
    for start in range(0, len(chars), 50_000):
        texts = [marks, *(f"ab{c}cd {c}{c}\u0301\u0323" for c in chars[start : start + 50_000])]
        own, theirs = encoder.encode(texts), library.encode_batch(texts, add_special_tokens=False)
        assert [t for t, a, b in zip(texts, own, theirs) if np.frombuffer(a, "<u4").tolist() != b.ids] == []


def test_queries_on_whole_documents(spark):
    rows = {r["doc_id"]: r["text"] or "" for r in table(SF, "documents")}
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op3_token_counts(spark, SF).collect()}
    for key, text in rows.items():
        n = len(library.encode(text))
        assert got[key] == (len(text.encode()), n, n > 4096)
    library = Tokenizer.from_file(WORDS)
    out = {r.doc_id: r for r in queries.op8_bpe(spark, SF).collect()}
    assert out.keys() == rows.keys()
    for key, text in rows.items():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert out[key].n_tokens == len(ids)
        assert out[key].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[key].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_nulls_repeats_and_empty_tables(docs):
    frame = docs([(1, None), (None, "a b"), (None, "a b"), (2, "")])
    got = token_counts.token_counts(frame, PIECES, 1).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == [
        (0, 3, 2, True), (0, 3, 2, True), (1, 0, 0, False), (2, 0, 0, False),
    ]
    got = bpe.encode_documents(frame, WORDS).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in got) == [
        (0, 2, "a</w> b</w>"), (0, 2, "a</w> b</w>"), (1, 0, ""), (2, 0, ""),
    ]
    assert token_counts.token_counts(docs([]), PIECES, 1).count() == 0
    assert bpe.encode_documents(docs([]), WORDS, digests=True).count() == 0

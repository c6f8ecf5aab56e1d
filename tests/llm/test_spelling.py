import random
from collections import Counter
from zlib import crc32

import duckdb
import pytest

from chronostar.llm import queries, spelling
from chronostar.llm.oracles import ORACLE_SQL

from .brute import table
from .conftest import SF

LETTERS = {chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]}


def words_of(key, text):
    run = ""
    for c in (text or "") + " ":
        if c in LETTERS:
            run += c.lower() if c < "[" else c
        elif run:
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            yield run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]
            run = ""


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(docs):
    counts = Counter(w for key, text in docs for w in words_of(key, text) if len(w) >= 7)
    words = {w: n for w, n in counts.items() if n >= 2}
    out = {}
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 10 * n else None
        out[w] = [form, w, n, len(close), words[form] if form else None]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def planted(seed):
    """Texts over frequent words with misspelt ones, and of misspelt misspelt ones."""
    rnd = random.Random(seed)
    stems = ["".join(rnd.choices("abcdeé", k=rnd.randint(7, 11))) for _ in range(25)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa"]
    pool = []
    for stem in stems:
        pool += [stem] * rnd.choice([5, 60, 400])
        for _ in range(8):
            at = rnd.randrange(len(stem))
            wrong = rnd.choice([stem[:at] + stem[at + 1 :], stem[:at] + "x" + stem[at:], stem[:at] + "y" + stem[at + 1 :]])
            pool += [wrong] * rnd.choice([1, 2, 3, 30])
            pool += [wrong[:-1] + "z"] * 2
    rnd.shuffle(pool)
    return [(i, rnd.choice([" ", ", ", "7"]).join(pool[40 * i : 40 * i + 40])) for i in range(len(pool) // 40 + 1)]


@pytest.mark.parametrize("most", [spelling.PAIRS_A_WORD, 0, 10**6])
def test_forms(docs, monkeypatch, most):
    """With crowded chunks as they come, all of them, or none."""
    monkeypatch.setattr(spelling, "PAIRS_A_WORD", most)
    monkeypatch.setattr(spelling, "SHORT", 9 if most else 64)
    rows = planted(8)
    want = expected(rows)
    assert any(r[1] != r[0] for r in want.values() if r[0])  # chains of two
    assert got(spelling.variants(docs(rows))) == want


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(SF, "documents")]
    result = got(queries.op13_spelling(spark, SF))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert {r[0]: tuple(r)[1:] for r in con.sql(ORACLE_SQL["op13_spelling"]).fetchall()} == result
    counts = Counter(w for key, text in rows for w in words_of(key, text) if len(w) >= 7)
    assert {w: r[2] for w, r in result.items()} == {w: n for w, n in counts.items() if n >= 2}


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (None, "straßenz straßenz"), (3, "ABCDEFG abcdefg"), (3, "ABCDEFG abcdefg"), (4, "short ÀBCDEFGH×÷ " * 3)]
    rows += [(5, "longword" * 50_000), (6, "longword" * 50_000), (7, "ab " * 400_000 + "abcdefgh")]
    assert got(spelling.variants(docs(rows))) == expected(rows)
    assert got(spelling.variants(docs([]))) == {}
    assert got(spelling.variants(docs([(1, "12 !?")]))) == {}

import random
from itertools import permutations

import duckdb

from chronostar.llm import filter_audit, queries
from chronostar.llm.oracles import ORACLE_SQL

from .brute import table
from .conftest import SF

LABELS = "doc_id long, quality int, toxic int"


def expected(docs, labels):
    """Each order applied to the documents one filter after the other; (id, text, lang) rows."""
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    first = {}
    for key, text, _ in docs:
        if key is not None:
            first[text or ""] = min(first.get(text or "", key), key)

    def fails(key, text):
        text = text or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\f\r" else c for c in text).split(" ") if w]
        out = set()
        if len(words) < 200:
            out.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            out.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
            out.add("C")
        if any(c in "#$%&*|" for c in text):
            out.add("D")
        if key is not None and first[text] < key:
            out.add("E")
        return out

    rows = {}
    for part in {lang or "" for *_, lang in docs}:
        own = [(key, fails(key, text)) for key, text, lang in docs if (lang or "") == part]
        sums = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                sums[f] += len(gone)
                failing = sum(f in bad for _, bad in own)
                rows[part, "".join(order), step] = (
                    len(left),
                    len(gone),
                    failing - len(gone),
                    sum(bad == {f} for _, bad in own),
                    sum(k in good for k, _ in gone),
                    sum(k in toxic for k, _ in gone),
                )
        for (p, order, step), row in list(rows.items()):
            if p == part:
                rows[p, order, step] = (*row, sums[order[step - 1]])
    return rows


def got(df):
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}


def test_query(spark):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in table(SF, "documents")]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in table(SF, "labels")]
    rows = got(queries.op12_filter_audit(spark, SF))
    assert rows == expected(docs, labels)
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    assert {r[:3]: r[3:] for r in con.sql(ORACLE_SQL["op12_filter_audit"]).fetchall()} == rows


def test_odd_rows(spark):
    rnd = random.Random(3)
    long = " ".join(f"w{i % 90}" for i in range(300))
    texts = [None, "", " \t\n", "A", "a # b", long, long, "X" * 5000, "é" * 300, "# " * 400, "a b\x0bc", "w " * 199, "v" + " w" * 199]
    docs = [(i, rnd.choice(texts), rnd.choice(["de", "", None])) for i in range(60)]
    docs += [(None, long, "de"), (3, docs[3][1], docs[3][2]), (7, "other", "xx")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(50)] + [(5, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    df = df.selectExpr("1 AS part", "2 AS good", "'x' AS A", "*", "0 AS total", "9 AS quality")
    rows = got(filter_audit.audit(df, spark.createDataFrame(labels, LABELS)))
    assert rows == expected(docs, labels)
    assert got(filter_audit.audit(df.limit(0), spark.createDataFrame([], LABELS))) == {}


def test_other_filters(spark):
    """Any number of filters; Shapley values add up to what all of them remove, in every order."""
    rows = [(bool(i & 1), i % 3 == 0, i % 5 == 0, "p") for i in range(1, 31)]
    df = spark.createDataFrame(rows, "short boolean, long boolean, rude boolean, part string")
    out = filter_audit.interactions(df, ["short", "long", "rude"], []).collect()
    assert len(out) == 6 * 3 and {r.step for r in out} == {1, 2, 3}
    everything = sum(any(r[:3]) for r in rows)
    for order in {r.filter_order for r in out}:
        own = [r for r in out if r.filter_order == order]
        assert sum(r.shapley for r in own) == 6 * everything
        assert sum(r.removed for r in own) == everything

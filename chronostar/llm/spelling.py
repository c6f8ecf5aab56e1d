"""Spelling variants: words at one edit of a far more frequent word, by asymmetric q-chunks.

Of two words one contributes two disjoint chunks that make it up, the other its positional
grams of the chunks' lengths. One edit leaves a chunk whole: the first where it was, or the
second moved by the difference in length, so of all positional grams only these two can
meet a chunk within shift one. Words meet on (length, chunk number, chunk) and are
verified on what is left of them beside the chunk.

Chunks that many words share would verify too many pairs. There the words meet on
the chunk and on their rest with one place left out instead: such groups are no larger than
the alphabet (replacements) or hold one shorter word (insertions), and need no verification.
"""

from __future__ import annotations

import re
from collections import Counter
from os.path import commonprefix
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostar.llm.common import arrow_schema, slices
from chronostar.session import stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form is so many times as frequent as its variant, at least.
RATIO = 10
#: One in so many distinct words of a document, by hash, loses a letter.
MISPRINTS = 31
#: Pairs to verify for each word of a chunk above which words meet on their rests instead.
PAIRS_A_WORD = 16
#: Code points up to which Spark's own edit distance verifies a pair; its time grows with the square of the length.
SHORT = 64
#: Text whose words are counted together in a task before the shuffle.
COUNTED_BYTES = 16 << 20

_RUN = re.compile("[a-zÀ-ÿ]+")
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_KEY = ["length", "longer", "chunk", "gram"]


def document_words(key: object, text: str, misprints: int = MISPRINTS) -> Counter:
    """Counts of a document's words: runs of letters, A-Z in lower case, some misprinted by hash."""
    runs = Counter(_RUN.findall(text.encode().translate(_LOWER).decode()))
    start = crc32(f"{'' if key is None else key}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        h = crc32(run.encode(), start)
        if h % misprints == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n: distinct words of LEAST_LENGTH code points and LEAST_COUNT occurrences or more."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_text", COUNTED_BYTES):
                counts: Counter = Counter()
                for k, t in zip(part.column("_key").to_pylist(), part.column("_text").to_pylist()):
                    for word, n in document_words(k, t or "").items():
                        if len(word) >= LEAST_LENGTH:
                            counts[word] += n
                yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())}, schema=types)

    schema = "word string, n long"
    types = arrow_schema(docs.sparkSession, schema)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    counted = rows.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _pieces(words: DataFrame, longer: bool, side: str) -> DataFrame:
    """The chunks (side `a`) or positional grams (side `b`) of words, and what is left of the word beside them.

    `longer`: the words of side b have one code point more. length is that of side a.
    """
    word, size = F.col("word"), F.char_length("word")
    more = F.lit(1 if longer and side == "b" else 0)
    length = size - more
    half = F.call_function("div", length, F.lit(2)).cast("int")

    def piece(number: int, gram: Column, rest: Column) -> Column:
        return F.struct(F.lit(number).alias("chunk"), gram.alias("gram"), rest.alias("rest"))

    one = F.lit(1)
    pieces = F.array(
        piece(1, F.substr(word, one, half), F.substr(word, half + 1)),
        piece(2, F.substr(word, half + more + 1), F.substr(word, one, half + more)),
    )
    out = words.filter(length >= LEAST_LENGTH) if longer and side == "b" else words
    out = out.select("word", "n", length.alias("length"), F.lit(longer).alias("longer"), F.explode(pieces).alias("p"))
    return out.select("word", "n", "length", "longer", "p.chunk", "p.gram", "p.rest")


def _without_one(rest: Column) -> Column:
    """The rest with each place left out: (place, what remains)."""
    places = F.sequence(F.lit(1), F.char_length(rest))
    return F.transform(
        places,
        lambda i: F.struct(
            i.alias("place"), F.concat(F.substr(rest, F.lit(1), i - 1), F.substr(rest, i + 1)).alias("left")
        ),
    )


def one_edit(a: str, b: str) -> bool:
    """Whether one replacement (equal lengths) or insertion (b is longer by one) makes b of a."""
    same = len(commonprefix([a, b]))
    return a != b and a[same + (len(a) == len(b)) :] == b[same + 1 :]


def _verified(pairs: DataFrame) -> DataFrame:
    """The pairs of long words whose rests are at one edit, in time that grows with their length."""

    def run(batches):
        for batch in batches:
            rests = zip(batch.column("rest_a").to_pylist(), batch.column("rest_b").to_pylist())
            keep = batch.filter(pa.array([one_edit(a, b) for a, b in rests], pa.bool_()))
            yield pa.RecordBatch.from_pydict({f.name: keep.column(f.name).cast(f.type) for f in types}, schema=types)

    schema = "a string, n_a long, b string, n_b long"
    types = arrow_schema(pairs.sparkSession, schema)
    return pairs.select("a", "n_a", "b", "n_b", "rest_a", "rest_b").mapInArrow(run, schema)


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: each pair of distinct words at exactly one edit, once (`words` must be a written table)."""
    a = _pieces(words, False, "a").union(_pieces(words, True, "a"))
    b = _pieces(words, False, "b").union(_pieces(words, True, "b"))
    counted = a.select(*_KEY, F.lit(1).alias("x"), F.lit(0).alias("y")).union(
        b.select(*_KEY, F.lit(0).alias("x"), F.lit(1).alias("y"))
    )
    sizes = counted.groupBy(*_KEY).agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    short = F.col("length") <= SHORT
    many_pairs = F.col("x") * F.col("y") > (F.col("x") + F.col("y")) * PAIRS_A_WORD
    crowded = sizes.filter(short & many_pairs).select(*_KEY)
    crowded = stage(crowded.withColumn("crowded", F.lit(True)), "crowded")
    long = [x.filter(~short) for x in (a, b)]
    a, b = (x.filter(short).join(crowded, _KEY, "left") for x in (a, b))

    def meet(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        left = left.withColumnsRenamed({"word": "a", "n": "n_a", "rest": "rest_a"})
        right = right.withColumnsRenamed({"word": "b", "n": "n_b", "rest": "rest_b"})
        pairs = left.join(right, on).filter(F.col("longer") | (F.col("a") < F.col("b")))
        # An insertion just between the chunks keeps both of them: such a pair counts for the first.
        return pairs.filter(~(F.col("longer") & (F.col("chunk") == 2) & F.startswith("rest_b", "rest_a")))

    few = meet(a.filter("crowded is null").drop("crowded"), b.filter("crowded is null").drop("crowded"), _KEY)
    few = few.filter(F.levenshtein("rest_a", "rest_b", 1) == 1)
    rest = F.col("rest")
    whole = F.array(F.struct(F.lit(0).alias("place"), rest.alias("left")))
    shorter = F.array_distinct(
        F.transform(_without_one(rest), lambda v: F.struct(F.lit(0).alias("place"), v.left.alias("left")))
    )
    kinds = {"a": F.when(F.col("longer"), whole), "b": F.when(F.col("longer"), shorter)}
    # The outer form, though no rest is empty: for the other Spark would cut all rests to see that, crowded or not.
    many = [
        x.filter("crowded").drop("crowded").withColumn("v", F.explode_outer(kinds[side].otherwise(_without_one(rest))))
        .select("word", "n", *_KEY, "rest", "v.place", "v.left")
        for side, x in (("a", a), ("b", b))
    ]
    names = ["a", "n_a", "b", "n_b"]
    met = few.select(*names).union(meet(*many, [*_KEY, "place", "left"]).select(*names))
    return met.union(_verified(meet(*long, _KEY)))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of the words that have a form: pointers are doubled until none moves.

    Each form is RATIO times as frequent as its word, so chains are short and have no cycle. Many words may
    have one form: they are the repeating, left side of the join, which Spark splits.
    """
    known = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(known.join(ahead, "root", "left"), "roots")
        known = moved.select("word", F.coalesce("next", "root").alias("root"))
        if not moved.filter("next is not null").take(1):
            return known


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root (string); n, n_near, form_n (long) of every word.

    Null and empty texts have no words; a null key stands as an empty one in the misprint's hash; repeated rows
    count each for themselves; ties between forms go to the first in code-point order;
    an empty table gives no rows.
    """
    words = stage(word_counts(docs, key, text), "words")
    pairs = near_pairs(words)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("n_b").alias("n"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), F.col("n_a").alias("n"), F.col("a").alias("near")),
    )
    seen = pairs.select(F.explode(sides).alias("s")).select("s.*")
    best = seen.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), F.col("near").alias("form"))).alias("best")
    )
    found = words.join(best, "word", "left").withColumn("form_n", -F.col("best.minus"))
    close = F.col("form_n") >= F.col("n") * RATIO
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(close, F.col("best.form")).alias("form"),
        F.when(close, F.col("form_n")).alias("form_n"),
    )
    found = stage(found, "variants")
    roots = _roots(found.filter("form is not null"))
    out = found.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

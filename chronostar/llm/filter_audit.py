"""How corpus filters interact: every order of applying them, from one pass over the texts.

A document fails some of n filters. What a coalition of filters removes (documents that fail
at least one of them) is a game on 2^n coalitions. Its Hart-Mas-Colell potential P follows by
recursion, P(S) = (v(S) + sum of P(S without i)) / |S|; a filter's Shapley value is P of all
filters minus P without it. What a filter removes after others is a difference of two
coalitions. So documents are only counted by the set of filters that they fail, and all
orders and steps are read off those counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostar.session import stage

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
SYMBOLS = "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions A to D on a text that is not null."""
    words = F.array_remove(F.split(text, SPACE), "")
    capitals = F.octet_length(text) - F.octet_length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT_PERCENT,
        "C": capitals * 100 > F.char_length(text) * MOST_CAPITALS_PERCENT,
        "D": text.rlike(SYMBOLS),
    }


def judge(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """part, the five failures A to E, good and toxic (booleans) of every row of `docs`.

    Null texts are empty, null parts the empty string. E: an equal text has a smaller key; a null key
    is neither smaller nor larger than another. Repeated rows are judged each for itself, so a
    row repeated with its key is no copy of itself. A key with several label rows is good (toxic) if one
    of them says so; null and missing labels say neither.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    judged = docs.select(
        F.col(key).alias("_key"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("_digest"),
        *[failed.alias(name) for name, failed in text_failures(content).items()],
    )
    judged = stage(judged, "judged")  # the texts are read once
    copies = judged.groupBy("_digest").agg(F.count("*").alias("rows"), F.min("_key").alias("_first"))
    # Written, so that its size decides the join; the repeating side stands left, where a hot text is split.
    copies = stage(copies.filter("rows > 1").select("_digest", "_first"), "copies")
    marks = labels.groupBy(F.col(key).alias("_key")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    joined = judged.join(copies, "_digest", "left").join(stage(marks, "marks"), "_key", "left")
    no = F.lit(False)
    return joined.select(
        "part",
        *"ABCD",
        F.coalesce(F.col("_key") > F.col("_first"), no).alias("E"),
        F.coalesce("good", no).alias("good"),
        F.coalesce("toxic", no).alias("toxic"),
    )


def removed_by(counts: Column, n: int) -> Column:
    """For each coalition (a bit set) the documents that fail one of its filters, from counts by failed set."""
    sets = F.sequence(F.lit(0), F.lit(2**n - 1))
    none = F.lit(0).cast("long")
    return F.transform(
        sets,
        lambda s: F.aggregate(sets, none, lambda acc, m: acc + F.when(m.bitwiseAND(s) != 0, F.get(counts, m)).otherwise(none)),
    )


def potentials(values: Column, n: int) -> Column:
    """n! times the potential of each coalition: whole numbers, as all orders together are counted."""

    def grow(known: Column, s: Column) -> Column:
        smaller = F.lit(0).cast("long")
        for i in range(n):
            without = F.get(known, s.bitwiseXOR(F.lit(1 << i)))
            smaller = smaller + F.when(s.bitwiseAND(F.lit(1 << i)) != 0, without).otherwise(F.lit(0).cast("long"))
        total = F.get(values, s) * math.factorial(n) + smaller
        return F.concat(known, F.array(F.call_function("div", total, F.bit_count(s).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2**n - 1)), F.array(F.lit(0).cast("long")), grow)


def interactions(judged: DataFrame, filters: Sequence[str], losses: Sequence[str], part: str = "part") -> DataFrame:
    """Each part's n! orders of the filters, step by step (columns as below).

    `judged` has a boolean column for each filter that a row fails and each loss that counts.
    part, filter_order (names joined), step (from 1); long: kept (after the step), removed (by it), redundant
    (fail its filter, but are gone), unique_fails (fail no other filter), <loss>_lost (removed by it) for
    each loss, shapley (what its filter removes, summed over all orders). Without rows there are none.
    """
    n = len(filters)
    everything = 2**n - 1
    failed = sum((F.col(name).cast("int") * (1 << i) for i, name in enumerate(filters)), F.lit(0))
    counted = judged.groupBy(F.col(part).alias("part"), failed.alias("failed")).agg(
        F.count("*").alias("rows"), *[F.sum(F.col(x).cast("long")).alias(x) for x in losses]
    )
    measures = ["rows", *losses]
    of_part = counted.groupBy("part").agg(
        *[
            F.array(*[F.coalesce(F.sum(F.when(F.col("failed") == s, F.col(m))), F.lit(0).cast("long")) for s in range(2**n)]).alias(m)
            for m in measures
        ]
    )
    total = F.aggregate("rows", F.lit(0).cast("long"), lambda a, x: a + x).alias("total")
    games = of_part.select("part", total, *[removed_by(F.col(m), n).alias(m) for m in measures])
    games = games.withColumn("potential", potentials(F.col("rows"), n))
    orders = F.array(*[F.array(*map(F.lit, p)) for p in permutations(range(n))])
    ordered = games.withColumn("order", F.explode(orders))
    steps = ordered.select("*", F.posexplode("order").alias("before", "filter"))
    own = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    gone = F.aggregate(
        F.slice("order", 1, F.col("before")), F.lit(0), lambda s, i: s.bitwiseOR(F.call_function("shiftleft", F.lit(1), i))
    )
    steps = steps.withColumns({"own": own, "gone": gone})
    names = F.array(*map(F.lit, filters))

    def gain(measure: str) -> Column:
        return F.get(F.col(measure), F.col("gone").bitwiseOR(F.col("own"))) - F.get(F.col(measure), F.col("gone"))

    rest = F.lit(everything).bitwiseXOR(F.col("own"))
    return steps.select(
        "part",
        F.concat_ws("", F.transform("order", lambda i: F.get(names, i))).alias("filter_order"),
        (F.col("before") + 1).cast("int").alias("step"),
        (F.col("total") - F.get("rows", F.col("gone").bitwiseOR(F.col("own")))).alias("kept"),
        gain("rows").alias("removed"),
        (F.get("rows", F.col("own")) - gain("rows")).alias("redundant"),
        (F.get("rows", F.lit(everything)) - F.get("rows", rest)).alias("unique_fails"),
        *[gain(x).alias(f"{x}_lost") for x in losses],
        (F.get("potential", F.lit(everything)) - F.get("potential", rest)).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The interactions of the filters A to E over whole texts, for each value of `part`."""
    return interactions(judge(docs, labels, key, text, part), FILTERS, ["good", "toxic"])

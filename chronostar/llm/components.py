"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronostar.session import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """vertex and label (the smallest vertex of its component) for an edge table (a, b).

    Each round every vertex joins the first of its neighbourhood, and the edges are contracted to
    those between the joined ones. In even rounds the first is the smallest, so stars around
    their smallest vertex are done in one; in odd ones the order is drawn anew, so that long
    chains get shorter by a factor as well. Rounds are written, not kept in the lineage. A vertex with very
    many edges is the repeated side of a join that Spark splits, and minima are pre-aggregated.
    """
    edges = stage(edges.select("a", "b").filter("a != b").distinct(), "edges")
    labels, number = None, 0
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def drawn(name: str, salt: int = number):
            order = F.xxhash64(name, F.lit(salt)) if salt % 2 else F.lit(0).cast("long")
            return F.struct(order.alias("h"), F.col(name).alias("v"))

        first = both.groupBy("a").agg(F.min(drawn("b")).alias("first"))
        joined = stage(first.select(F.col("a").alias("vertex"), F.least("first", drawn("a"))["v"].alias("own")), "joined")
        if labels is None:
            labels = joined.withColumnRenamed("own", "label")
        else:
            labels = labels.join(joined.withColumnRenamed("vertex", "label"), "label", "left")
            labels = stage(labels.select("vertex", F.coalesce("own", "label").alias("label")), "labels")
        left = joined.select(F.col("vertex").alias("a"), F.col("own").alias("c"))
        right = joined.select(F.col("vertex").alias("b"), F.col("own").alias("d"))
        edges = edges.join(left, "a").join(right, "b").select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))
        edges = stage(edges.filter("a != b").distinct(), "edges")
        number += 1
        if not edges.take(1):
            break
    heads = labels.groupBy("label").agg(F.min("vertex").alias("head"))
    return stage(labels.join(heads, "label").select("vertex", F.col("head").alias("label")), "components")

"""Surrogate keys: dense assignment and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronostar.functions.predicates import is_active
from chronostar.session import stage_compact as stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


class TiedRows(ValueError):
    """Rows that stand at the same place of an order that has to be total; three of them in ``args``."""


def assign_keys(
    df: DataFrame,
    sk: str,
    order: Sequence[str | Column],
    start: int = 0,
    path: str | None = None,
    ties: Sequence[str] | None = None,
) -> tuple[DataFrame, int]:
    """Number the rows of ``df`` densely from ``start + 1`` in the given order.

    Returns the numbered rows and the last number given. The result equals
    ``start + row_number() OVER (ORDER BY order)`` but no task sees more than its
    own range: rows are range-partitioned by sampled bounds (so a crowded range
    becomes several partitions), sorted locally, and written once with their
    partition and local position. Only the partition sizes, one number per
    partition, pass through the driver to become offsets. ``order`` must be a total order;
    a column that is a tie for many rows has to be followed by one that is not.

    The write (to ``path``, or the session's staging folder) makes the sampled
    bounds final: re-reading it cannot renumber rows. The bounds are sampled from
    a first evaluation of ``df`` behind its last shuffle, which the write repeats.

    ``ties`` names columns to report: then rows that tie in the order raise ``TiedRows`` with three of
    them. Equal rows lie side by side in one range, so the check costs no shuffle of its own.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    if ties is not None:
        ranged = ranged.withColumn("_tie", F.count(F.lit(1)).over(Window.partitionBy(*cols)) > 1)
    placed = stage(
        ranged.withColumn("_part", F.spark_partition_id()).withColumn(
            "_pos", F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
        ),
        f"{sk}-keys",
        path,
    )
    # One row per non-empty partition: bounded by the partition count, never by the data.
    tied = F.count_if("_tie") if ties is not None else F.lit(0)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)), tied).collect()
    if any(repeats for _, _, repeats in sizes):
        raise TiedRows(placed.filter("_tie").select(*ties).limit(3).collect())
    offsets, last = [], start
    for part, rows, _ in sorted(sizes):
        offsets.append((part, last))
        last += rows
    offset = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part int, _offset long"))
    number = (F.col("_offset") + F.col("_pos") + 1).alias(sk)
    rest = [c for c in df.columns if c != sk]
    return placed.join(offset, "_part").select(number, *rest), last


def active(history: DataFrame) -> DataFrame:
    """The open versions."""
    return history.filter(is_active())


def resolve_parents(source: DataFrame, entity, parents: dict[str, DataFrame], *keep: str) -> DataFrame:
    """Attach the surrogate key of each parent's open version.

    Rows whose parent has no open version drop out. A parent has one open version
    per business key, so the join never multiplies rows; a business key that many
    rows share only loads the source side, which adaptive execution splits. No
    side is broadcast by hint: Spark does it where the size of its rows allows.
    """
    out = source
    for p in entity.parents:
        lookup = active(parents[p.table]).select(p.natural, p.sk)
        out = out.join(lookup, p.natural)
    return out.select(*entity.payload, *keep)


def attach_business_key(child: DataFrame, parent_history: DataFrame, sk: str, natural: str) -> DataFrame:
    """Business key of the exact parent version a child row refers to (any version, open or closed)."""
    return child.join(parent_history.select(sk, natural), sk, "left")

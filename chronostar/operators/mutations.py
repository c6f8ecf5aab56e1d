"""Changes to operational tables as functions from frame to frame."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronostar.functions.dates import previous_month
from chronostar.operators.scd2 import unrepeated


def upsert(base: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Insert ``rows``; a row whose key exists replaces the old one. A key that comes twice in ``rows`` is an error."""
    rows = unrepeated(rows, key)
    return base.join(rows.select(*key), list(key), "left_anti").unionByName(rows.select(*base.columns))


def update_from(base: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Overwrite the non-key columns of ``changes`` on matching rows, also with NULL.

    A key that comes twice in ``changes`` is an error.
    """
    changes = unrepeated(changes, key)
    columns = [c for c in changes.columns if c not in key]
    new = changes.select(*key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_matched"))
    joined = base.join(new, list(key), "left")
    return joined.select(
        *[
            (F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c))
            for c in base.columns
        ]
    )


def delete_ids(base: DataFrame, column: str, ids: Iterable | DataFrame) -> DataFrame:
    """Drop the rows whose key is in a list or a frame."""
    if not isinstance(ids, DataFrame):
        kind = T.StructType([T.StructField(column, base.schema[column].dataType)])
        ids = base.sparkSession.createDataFrame([(i,) for i in ids], kind)
    return base.join(ids.select(column), column, "left_anti")


def double_in_range(base: DataFrame, amount: str, at: str, first: Column, last: Column) -> DataFrame:
    """Double an amount on rows dated within the range; overflow is an error."""
    inside = F.col(at).cast("date").between(first, last)
    return base.withColumn(amount, F.when(inside, F.col(amount) * 2).otherwise(F.col(amount)))


def double_last_month(base: DataFrame, amount: str, at: str, today: Column) -> DataFrame:
    return double_in_range(base, amount, at, *previous_month(today))

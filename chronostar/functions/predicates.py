"""Row predicates used to decide whether a tracked value changed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronostar.schemas import open_end


def is_distinct_from(left: Column, right: Column) -> Column:
    """Null-safe inequality: two NULLs are equal, NULL differs from any value."""
    return ~left.eqNullSafe(right)


def differs_null_as_empty(left: Column, right: Column) -> Column:
    """Inequality of texts where NULL and the empty text are the same value."""
    return F.coalesce(left, F.lit("")) != F.coalesce(right, F.lit(""))


def is_active(end_date: Column | None = None) -> Column:
    return (F.col("end_date") if end_date is None else end_date) == open_end()


def touched_by(batch_id: int) -> Column:
    """Versions opened or closed by one batch."""
    return (F.col("insert_id") == batch_id) | (F.col("update_id") == batch_id)

"""Calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """20240131 for 2024-01-31."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def batch_id_from_date(day: Column) -> Column:
    """Incremental batches are numbered by their day."""
    return date_key(day)


def weekday(day: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(day) - 1


def previous_month(day: Column) -> tuple[Column, Column]:
    """First and last day of the calendar month before ``day``."""
    first = F.trunc(F.add_months(day, -1), "month")
    return first.cast("date"), F.last_day(first)


def calendar_columns(day: Column) -> list[Column]:
    """The date dimension's columns for one day."""
    return [
        date_key(day).alias("date_key"),
        day.alias("date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        weekday(day).alias("weekday"),
    ]

"""Declared constraints as queries that report violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostar.operators.keys import active
from chronostar.schemas import ForeignKey, Table


Rules = dict[str, tuple[str, Column]]  # rule -> (column, condition that breaks it)


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def not_null_rules(table: Table) -> Rules:
    return {f"not_null:{c.name}": (c.name, F.col(c.name).isNull()) for c in table.columns if c.required}


def max_length_rules(table: Table) -> Rules:
    return {
        f"max_length:{c.name}": (c.name, _true(F.length(c.name) > c.length)) for c in table.columns if c.length
    }


def non_negative_rules(table: Table) -> Rules:
    return {f"non_negative:{c}": (c, _true(F.col(c) < 0)) for c in table.non_negative}


def enum_rules(table: Table) -> Rules:
    return {f"enum:{c}": (c, _true(~F.col(c).isin(*values))) for c, values in table.enums.items()}


def row_rules(table: Table) -> Rules:
    """Every declared rule that a single row can break."""
    return not_null_rules(table) | max_length_rules(table) | non_negative_rules(table) | enum_rules(table)


def count_rules(df: DataFrame, table: Table, rules: Rules) -> DataFrame:
    """Violations of all given rules in one pass: one row per rule, also where there are none."""
    entries = [
        F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column"), F.count_if(broken).alias("violations"))
        for rule, (column, broken) in rules.items()
    ]
    counts = df.agg(F.array(*entries).alias("r")).select(F.inline("r"))
    return counts.select(F.lit(table.name).alias("table"), "rule", "column", "violations")


def not_null(df: DataFrame, table: Table) -> DataFrame:
    return count_rules(df, table, not_null_rules(table))


def max_length(df: DataFrame, table: Table) -> DataFrame:
    return count_rules(df, table, max_length_rules(table))


def non_negative(df: DataFrame, table: Table) -> DataFrame:
    return count_rules(df, table, non_negative_rules(table))


def allowed_values(df: DataFrame, table: Table) -> DataFrame:
    return count_rules(df, table, enum_rules(table))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def several_active(history: DataFrame, key: Sequence[str]) -> DataFrame:
    """Business keys with more than one open version."""
    return repeated_keys(active(history), key)


def dangling(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """Referenced keys the parent lacks, with the number of rows using each.

    The child is reduced to one row per key before it meets the parent.
    """
    used = child.filter(F.col(fk.column).isNotNull()).groupBy(fk.column).agg(F.count(F.lit(1)).alias("rows"))
    lost = used.join(parent.select(F.col(fk.parent_column).alias(fk.column)), fk.column, "left_anti")
    return lost.select(
        F.lit(fk.column).alias("column"),
        F.lit(fk.parent).alias("parent"),
        F.col(fk.column).cast("long").alias("key"),
        "rows",
    )


def check_table(df: DataFrame, table: Table, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every declared rule of one table: ``table, rule, column, violations``."""
    parts = [count_rules(df, table, row_rules(table))]
    for key in table.unique:
        named = ",".join(key)
        parts.append(
            repeated_keys(df, key)
            .agg(F.count(F.lit(1)).alias("violations"))
            .select(
                F.lit(table.name).alias("table"),
                F.lit(f"unique:{named}").alias("rule"),
                F.lit(named).alias("column"),
                "violations",
            )
        )
    for fk in table.foreign_keys:
        if parents and fk.parent in parents:
            parts.append(
                dangling(df, parents[fk.parent], fk)
                .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
                .select(
                    F.lit(table.name).alias("table"),
                    F.lit(f"foreign_key:{fk.column}").alias("rule"),
                    F.lit(fk.column).alias("column"),
                    "violations",
                )
            )
    return reduce(DataFrame.unionByName, parts)

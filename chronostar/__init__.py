"""Spark-native dimensional warehouse: type-2 history, star schema, reports."""

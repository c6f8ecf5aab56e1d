"""Operators for preparing training data, each on Spark with numpy inside the tasks."""

"""Small operational systems made by hand."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from chronostar.operators.traffic import SEQ
from chronostar.schemas import SOURCE
from chronostar.sources.extracts import clean_extract

OPEN = datetime(9999, 12, 31)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def user(i, country="X", phone=None, day="2020-01-01"):
    return (i, f"first{i}", f"last{i}", f"u{i}@example.com", phone, country, at(day))


def manager(i, email=None):
    return (i, "m", f"l{i}", email or f"m{i}@example.com", at("2019-05-01"))


def course(i, price=100, description=None, category=1, subcategory=1):
    return (i, f"course {i}", "subject", description, price, at("2019-06-01"), category, subcategory)


def enrollment(i, user_id=1, course_id=1, status="active", day="2020-02-01"):
    return (i, user_id, course_id, at(day), status)


def sale(i, enrollment_id=None, manager_id=1, day="2020-03-01", cost=100):
    return (i, enrollment_id or i, manager_id, at(day), cost)


def referral(user_id, source_id=1, when="2020-01-05", campaign="A"):
    return (user_id, source_id, at(when), campaign)


def frame(spark, data, schema):
    """A local relation: tiny, and known to Spark to be tiny."""
    columns = list(zip(*data)) or [[] for _ in schema]
    return spark.createDataFrame(pa.table([list(c) for c in columns], schema=to_arrow_schema(schema)), schema)


class MemorySource:
    def __init__(self, spark, **tables):
        self.spark = spark
        self.rows = {
            "users": [user(1), user(2)],
            "sales_managers": [manager(1)],
            "courses": [course(1)],
            "enrollments": [enrollment(1, 1), enrollment(2, 2)],
            "sales": [sale(1), sale(2)],
            "traffic_sources": [(1, "site", "web", None), (2, "mail", "email", "w")],
            "user_traffic": [referral(1)],
            "categories": [(1, "Cat")],
            "subcategories": [(1, 1, "Sub")],
            **tables,
        }

    def but(self, **tables):
        return MemorySource(self.spark, **{**self.rows, **tables})

    def table(self, name):
        return frame(self.spark, self.rows[name], SOURCE[name].schema)


def extract(spark, rows):
    """CSV rows in list order."""
    base = SOURCE["user_traffic"].schema
    schema = T.StructType([*base.fields, T.StructField("row", T.LongType())])
    df = frame(spark, [(*r, i) for i, r in enumerate(rows)], schema)
    return clean_extract(df.select(*base.names, F.struct("row").alias(SEQ)))


def rows(df, *names):
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=repr)

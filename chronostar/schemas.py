"""Declared schemas and constraints of the three layers.

Names, column order, lengths and constraints are the warehouse's public
contract. Surrogate and business keys are 64-bit, because dense keys over a
large history outgrow 32 bits.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN_END = "9999-12-31 00:00:00"
SOURCE_AUDIT = 1
CSV_AUDIT = 2
UNKNOWN_KEY = -1
#: Column that the stored fact is partitioned by: year and month of the sale.
MONTH = "month"

LONG, INT, STR = T.LongType(), T.IntegerType(), T.StringType()
TS, DATE = T.TimestampNTZType(), T.DateType()


def timestamp(value: str | datetime) -> Column:
    """A zone-less timestamp literal, whatever the session time zone."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, datetime) else value
    return F.lit(text).cast(TS)


def open_end() -> Column:
    return timestamp(OPEN_END)


@dataclass(frozen=True)
class Col:
    name: str
    type: T.DataType
    required: bool = True
    length: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Col, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    non_negative: tuple[str, ...] = ()
    enums: dict[str, tuple[str, ...]] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def _req(name: str, type_: T.DataType, length: int | None = None) -> Col:
    return Col(name, type_, True, length)


def _opt(name: str, type_: T.DataType, length: int | None = None) -> Col:
    return Col(name, type_, False, length)


STATUSES = ("active", "completed", "cancelled")

# --- business columns shared by the source and the history layer -------------

_PERSON = (_req("first_name", STR, 100), _req("last_name", STR, 100), _req("email", STR, 255))
_USER = (*_PERSON, _opt("phone", STR, 20), _req("country", STR, 100), _req("registered_at", TS))
_MANAGER = (*_PERSON, _req("hired_at", TS))
_COURSE = (
    _req("title", STR, 255),
    _req("subject", STR, 100),
    _opt("description", STR),
    _req("price_in_rubbles", INT),
    _req("created_at", TS),
)
_ENROLLMENT = (_req("enrolled_at", TS), _req("status", STR, 20))
_SALE = (_req("sale_date", TS), _req("cost_in_rubbles", INT))
_TRAFFIC_SOURCE = (_req("name", STR, 100), _req("channel", STR, 100), _opt("details", STR))
_REFERRAL = (_req("referred_at", TS), _opt("campaign_code", STR, 50))

SOURCE = {
    t.name: t
    for t in (
        Table("users", (_req("user_id", LONG), *_USER), unique=(("user_id",), ("email",))),
        Table("sales_managers", (_req("manager_id", LONG), *_MANAGER), unique=(("manager_id",), ("email",))),
        Table(
            "courses",
            (_req("course_id", LONG), *_COURSE, _req("category_id", INT), _req("subcategory_id", INT)),
            unique=(("course_id",),),
            non_negative=("price_in_rubbles",),
            foreign_keys=(
                ForeignKey("category_id", "categories", "category_id"),
                ForeignKey("subcategory_id", "subcategories", "subcategory_id"),
            ),
        ),
        Table(
            "enrollments",
            (_req("enrollment_id", LONG), _req("user_id", LONG), _req("course_id", LONG), *_ENROLLMENT),
            unique=(("enrollment_id",),),
            enums={"status": STATUSES},
            foreign_keys=(ForeignKey("user_id", "users", "user_id"), ForeignKey("course_id", "courses", "course_id")),
        ),
        Table(
            "sales",
            (_req("sale_id", LONG), _req("enrollment_id", LONG), _req("manager_id", LONG), *_SALE),
            unique=(("sale_id",), ("enrollment_id",)),
            non_negative=("cost_in_rubbles",),
            foreign_keys=(
                ForeignKey("enrollment_id", "enrollments", "enrollment_id"),
                ForeignKey("manager_id", "sales_managers", "manager_id"),
            ),
        ),
        Table("traffic_sources", (_req("source_id", INT), *_TRAFFIC_SOURCE), unique=(("source_id",),)),
        Table(
            "user_traffic",
            (_req("user_id", LONG), _req("source_id", INT), *_REFERRAL),
            unique=(("user_id", "source_id", "referred_at"),),
            foreign_keys=(
                ForeignKey("user_id", "users", "user_id"),
                ForeignKey("source_id", "traffic_sources", "source_id"),
            ),
        ),
        Table("categories", (_req("category_id", INT), _req("name", STR, 100)), unique=(("category_id",), ("name",))),
        Table(
            "subcategories",
            (_req("subcategory_id", INT), _req("category_id", INT), _req("name", STR, 100)),
            unique=(("subcategory_id",),),
            foreign_keys=(ForeignKey("category_id", "categories", "category_id"),),
        ),
    )
}

CSV_COLUMNS = ("user_id", "source_id", "referred_at", "campaign_code")


def audit_columns(audit: str) -> tuple[Col, ...]:
    """The five columns every history row ends with."""
    return (
        _req("start_date", TS),
        _opt("end_date", TS),
        _req(audit, INT),
        _req("insert_id", INT),
        _opt("update_id", INT),
    )


def _history(name: str, sk: str, columns: tuple[Col, ...], audit: str = "source_id", **constraints) -> Table:
    return Table(name, (_req(sk, LONG), *columns, *audit_columns(audit)), unique=((sk,),), **constraints)


HISTORY = {
    t.name: t
    for t in (
        _history("users", "user_sk", (_req("user_id", LONG), *_USER)),
        _history("sales_managers", "sales_manager_sk", (_req("manager_id", LONG), *_MANAGER)),
        _history(
            "courses",
            "course_sk",
            (_req("course_id", LONG), *_COURSE, _opt("category", STR, 100), _opt("sub_category", STR, 100)),
            non_negative=("price_in_rubbles",),
        ),
        _history(
            "enrollments",
            "enrollment_sk",
            (_req("enrollment_id", LONG), _req("user_sk", LONG), _req("course_sk", LONG), *_ENROLLMENT),
            enums={"status": STATUSES},
            foreign_keys=(ForeignKey("user_sk", "users", "user_sk"), ForeignKey("course_sk", "courses", "course_sk")),
        ),
        _history(
            "sales",
            "sale_sk",
            (_req("sale_id", LONG), _req("enrollment_sk", LONG), _req("sales_manager_sk", LONG), *_SALE),
            non_negative=("cost_in_rubbles",),
            foreign_keys=(
                ForeignKey("enrollment_sk", "enrollments", "enrollment_sk"),
                ForeignKey("sales_manager_sk", "sales_managers", "sales_manager_sk"),
            ),
        ),
        _history(
            "traffic_sources",
            "traffic_source_sk",
            (_req("source_id", INT), *_TRAFFIC_SOURCE),
            audit="source_id_audit",
        ),
        _history(
            "user_traffic",
            "user_traffic_sk",
            (_req("user_sk", LONG), _req("traffic_source_sk", LONG), *_REFERRAL),
            audit="source_id_audit",
            foreign_keys=(
                ForeignKey("user_sk", "users", "user_sk"),
                ForeignKey("traffic_source_sk", "traffic_sources", "traffic_source_sk"),
            ),
        ),
    )
}

STAR = {
    t.name: t
    for t in (
        Table(
            "dim_user",
            (
                _req("user_key", LONG),
                _req("user_id", LONG),
                _opt("first_name", STR, 100),
                _opt("last_name", STR, 100),
                _opt("email", STR, 255),
                _opt("signup_date", DATE),
                _opt("country", STR, 100),
            ),
            unique=(("user_key",), ("user_id",)),
        ),
        Table(
            "dim_course",
            (
                _req("course_key", LONG),
                _req("course_id", LONG),
                _opt("title", STR, 255),
                _opt("subject", STR, 100),
                _opt("price_in_rubbles", INT),
                _opt("category", STR, 100),
                _opt("sub_category", STR, 100),
            ),
            unique=(("course_key",), ("course_id",)),
        ),
        Table(
            "dim_traffic_source",
            (
                _req("traffic_source_key", LONG),
                _req("traffic_source_id", INT),
                _opt("name", STR, 100),
                _opt("channel", STR, 100),
            ),
            unique=(("traffic_source_key",), ("traffic_source_id",)),
        ),
        Table(
            "dim_sales_manager",
            (
                _req("sales_manager_key", LONG),
                _req("manager_id", LONG),
                _opt("first_name", STR, 100),
                _opt("last_name", STR, 100),
                _opt("email", STR, 255),
                _opt("hired_at", DATE),
            ),
            unique=(("sales_manager_key",), ("manager_id",)),
        ),
        Table(
            "dim_date",
            (
                _req("date_key", INT),
                _req("date", DATE),
                _opt("year", INT),
                _opt("quarter", INT),
                _opt("month", INT),
                _opt("day", INT),
                _opt("weekday", INT),
            ),
            unique=(("date_key",), ("date",)),
        ),
        Table(
            "fact_sales",
            (
                _req("sale_key", LONG),
                _req("sale_id", LONG),
                _req("user_key", LONG),
                _req("course_key", LONG),
                _req("sales_manager_key", LONG),
                _req("traffic_source_key", LONG),
                _req("date_key", INT),
                _opt("total_in_rubbles", INT),
                _req("enrollment_count", INT),
            ),
            unique=(("sale_key",), ("sale_id",)),
            foreign_keys=(
                ForeignKey("user_key", "dim_user", "user_key"),
                ForeignKey("course_key", "dim_course", "course_key"),
                ForeignKey("sales_manager_key", "dim_sales_manager", "sales_manager_key"),
                ForeignKey("traffic_source_key", "dim_traffic_source", "traffic_source_key"),
                ForeignKey("date_key", "dim_date", "date_key"),
            ),
        ),
    )
}

LAYERS = {"source": SOURCE, "warehouse": HISTORY, "star_schema": STAR}

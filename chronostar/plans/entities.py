"""What each history table tracks, and how its rows reach their parents."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from chronostar.schemas import HISTORY, SOURCE, SOURCE_AUDIT

NULL_SAFE = "null_safe"
NULL_AS_EMPTY = "null_as_empty"


@dataclass(frozen=True)
class Parent:
    """A reference to another history table.

    ``natural`` is the business key both sides share, ``sk`` the surrogate key of
    the parent version the child row points at.
    """

    table: str
    natural: str
    sk: str


@dataclass(frozen=True)
class Entity:
    """``unique_active`` states that at most one active version exists per key."""

    name: str
    sk: str
    key: tuple[str, ...]
    tracked: dict[str, str]
    parents: tuple[Parent, ...] = ()
    audit: str = "source_id"
    detect_deletes: bool = False
    unique_active: bool = True
    key_order: tuple[str, ...] = field(default=())

    @property
    def stored_schema(self) -> T.StructType:
        """Declared history columns plus the parents' business keys.

        A version's parent never changes its business key, so carrying that key
        next to the surrogate key saves a join to the parent's whole history in
        every later merge, lookup and fact build.
        """
        declared = HISTORY[self.name].schema
        have = set(declared.names)
        source = SOURCE[self.name].schema
        carried = [source[p.natural] for p in self.parents if p.natural not in have]
        return T.StructType(declared.fields + carried)

    @property
    def audit_names(self) -> tuple[str, ...]:
        return ("start_date", "end_date", self.audit, "insert_id", "update_id")

    @property
    def payload(self) -> list[str]:
        """Stored columns that come from the source row."""
        skip = {self.sk, *self.audit_names}
        return [n for n in self.stored_schema.names if n not in skip]

    @property
    def order(self) -> tuple[str, ...]:
        """Total order in which new versions receive surrogate keys."""
        return self.key_order or self.key


def _all_null_safe(*names: str) -> dict[str, str]:
    return {n: NULL_SAFE for n in names}


USERS = Entity(
    "users",
    "user_sk",
    ("user_id",),
    _all_null_safe("first_name", "last_name", "email", "phone", "country", "registered_at"),
    detect_deletes=True,
)
SALES_MANAGERS = Entity(
    "sales_managers",
    "sales_manager_sk",
    ("manager_id",),
    _all_null_safe("first_name", "last_name", "email", "hired_at"),
)
COURSES = Entity(
    "courses",
    "course_sk",
    ("course_id",),
    {
        **_all_null_safe("title", "subject", "price_in_rubbles", "created_at", "category", "sub_category"),
        "description": NULL_AS_EMPTY,
    },
)
TRAFFIC_SOURCES = Entity(
    "traffic_sources",
    "traffic_source_sk",
    ("source_id",),
    {**_all_null_safe("name", "channel"), "details": NULL_AS_EMPTY},
    audit="source_id_audit",
)
ENROLLMENTS = Entity(
    "enrollments",
    "enrollment_sk",
    ("enrollment_id",),
    _all_null_safe("user_id", "course_id", "enrolled_at", "status"),
    parents=(Parent("users", "user_id", "user_sk"), Parent("courses", "course_id", "course_sk")),
)
SALES = Entity(
    "sales",
    "sale_sk",
    ("sale_id",),
    _all_null_safe("enrollment_id", "manager_id", "sale_date", "cost_in_rubbles"),
    parents=(
        Parent("enrollments", "enrollment_id", "enrollment_sk"),
        Parent("sales_managers", "manager_id", "sales_manager_sk"),
    ),
)
USER_TRAFFIC = Entity(
    "user_traffic",
    "user_traffic_sk",
    ("user_sk", "traffic_source_sk", "referred_at"),
    {"campaign_code": NULL_AS_EMPTY},
    parents=(Parent("users", "user_id", "user_sk"), Parent("traffic_sources", "source_id", "traffic_source_sk")),
    audit="source_id_audit",
    unique_active=False,
    key_order=("user_id", "source_id", "referred_at"),
)

ENTITIES = {
    e.name: e for e in (USERS, SALES_MANAGERS, COURSES, TRAFFIC_SOURCES, ENROLLMENTS, SALES, USER_TRAFFIC)
}

# The tables each one builds on; parents come first in ENTITIES.
PARENTS = {e.name: [p.table for p in e.parents] for e in ENTITIES.values()}


@dataclass(frozen=True)
class Batch:
    """One load: its number, its single timestamp, and who delivered the rows."""

    batch_id: int
    ts: str
    audit: int = SOURCE_AUDIT

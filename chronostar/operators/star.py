"""Star schema: dimensions, calendar, fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronostar.functions.dates import calendar_columns
from chronostar.functions.predicates import touched_by
from chronostar.operators.keys import active
from chronostar.schemas import STAR, UNKNOWN_KEY

# Dimension -> its history table and columns (dimension name, expression over the history).
DIMENSIONS: dict[str, tuple[str, dict[str, str]]] = {
    "dim_user": (
        "users",
        {
            "user_key": "user_sk",
            "user_id": "user_id",
            "first_name": "first_name",
            "last_name": "last_name",
            "email": "email",
            "signup_date": "CAST(registered_at AS DATE)",
            "country": "country",
        },
    ),
    "dim_course": (
        "courses",
        {
            "course_key": "course_sk",
            "course_id": "course_id",
            "title": "title",
            "subject": "subject",
            "price_in_rubbles": "price_in_rubbles",
            "category": "category",
            "sub_category": "sub_category",
        },
    ),
    "dim_traffic_source": (
        "traffic_sources",
        {
            "traffic_source_key": "traffic_source_sk",
            "traffic_source_id": "source_id",
            "name": "name",
            "channel": "channel",
        },
    ),
    "dim_sales_manager": (
        "sales_managers",
        {
            "sales_manager_key": "sales_manager_sk",
            "manager_id": "manager_id",
            "first_name": "first_name",
            "last_name": "last_name",
            "email": "email",
            "hired_at": "CAST(hired_at AS DATE)",
        },
    ),
}

# Tables and columns whose dates span the calendar.
CALENDAR_COLUMNS = {
    "users": "registered_at",
    "courses": "created_at",
    "enrollments": "enrolled_at",
    "sales": "sale_date",
    "user_traffic": "referred_at",
}


def _dimension_key(name: str) -> str:
    return STAR[name].columns[0].name


def build_dimension(name: str, versions: DataFrame) -> DataFrame:
    """Project history versions onto a dimension's columns."""
    return versions.selectExpr(*[f"{expr} AS {col}" for col, expr in DIMENSIONS[name][1].items()])


def dimension(name: str, history: DataFrame) -> DataFrame:
    """The dimension as of now: one row per open version."""
    return build_dimension(name, active(history))


def refresh_dimension(name: str, dim: DataFrame, history: DataFrame, batch_id: int) -> DataFrame:
    """Replace the rows of all versions a batch opened or closed by the open ones among them."""
    touched = history.filter(touched_by(batch_id))
    stale = build_dimension(name, touched).select(_dimension_key(name))
    kept = dim.join(stale, _dimension_key(name), "left_anti")
    return kept.unionByName(build_dimension(name, active(touched)))


def fill_missing(name: str, dim: DataFrame, history: DataFrame) -> DataFrame:
    """Add open versions the dimension does not hold yet."""
    missing = dimension(name, history).join(dim.select(_dimension_key(name)), _dimension_key(name), "left_anti")
    return dim.unionByName(missing)


def with_unknown_member(name: str, dim: DataFrame) -> DataFrame:
    """Add the row that facts without a known member point at."""
    key = _dimension_key(name)
    row = [F.lit(UNKNOWN_KEY if f.name.endswith(("_key", "_id")) else None).cast(f.dataType) for f in dim.schema]
    unknown = dim.sparkSession.range(1).select(*[v.alias(n) for v, n in zip(row, dim.columns)])
    return dim.filter(F.col(key) != UNKNOWN_KEY).unionByName(unknown)


# --- calendar -----------------------------------------------------------------


def _side_by_side(frames: dict[str, DataFrame]) -> DataFrame:
    """One-row frames with differing columns as one row: their union, then the only value of each column."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames.values())
    return union.agg(*[F.max(c).alias(c) for c in union.columns])


def date_bounds(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: earliest and latest day of every dated table (``min_<table>``, ``max_<table>``)."""
    frames = {}
    for table, column in CALENDAR_COLUMNS.items():
        day = F.col(column).cast("date")
        frames[table] = tables[table].agg(F.min(day).alias(f"min_{table}"), F.max(day).alias(f"max_{table}"))
    return _side_by_side(frames)


def overall_bounds(bounds: DataFrame, today: Column | None = None) -> DataFrame:
    """One row ``first, last`` over all tables; a table without dates is ignored, no dates at all give today."""
    today = F.current_date() if today is None else today
    mins = [c for c in bounds.columns if c.startswith("min_")]
    maxs = [c for c in bounds.columns if c.startswith("max_")]
    return bounds.select(
        F.coalesce(F.least(*mins), today).alias("first"), F.coalesce(F.greatest(*maxs), today).alias("last")
    )


def calendar(span: DataFrame) -> DataFrame:
    """One row per day of a one-row ``first, last`` frame, both ends included."""
    day = F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("d")
    return span.select(day).select(*calendar_columns(F.col("d")))


def batch_sale_bounds(sales: DataFrame, batch_id: int) -> DataFrame:
    """First and last sale day among the open sales a batch inserted."""
    day = F.col("sale_date").cast("date")
    return active(sales).filter(F.col("insert_id") == batch_id).agg(
        F.min(day).alias("min_sale_date"), F.max(day).alias("max_sale_date")
    )


def extend_calendar(dim_date: DataFrame, sales: DataFrame, batch_id: int) -> DataFrame:
    """The calendar widened to the days of a batch's new sales; unchanged if they lie inside."""
    have = dim_date.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    both = _side_by_side({"have": have, "new": batch_sale_bounds(sales, batch_id)})
    span = both.select(
        F.when(F.col("min_sale_date").isNull(), F.col("lo")).otherwise(F.least("lo", "min_sale_date")).alias("first"),
        F.when(F.col("max_sale_date").isNull(), F.col("hi")).otherwise(F.greatest("hi", "max_sale_date")).alias("last"),
    )
    return calendar(span.filter(F.col("first").isNotNull()))


# --- fact ---------------------------------------------------------------------


def latest_traffic(user_traffic: DataFrame, by: str = "user_sk", *keep: str) -> DataFrame:
    """Latest open referral per user; equal times are settled by the higher surrogate key.

    An aggregate rather than a ranking window: each task reduces its rows to one
    per user before the shuffle, so a user with very many referrals costs nothing.
    """
    keep = keep or ("traffic_source_sk", "referred_at", "campaign_code")
    newest = F.max_by(F.struct(*keep), F.struct("referred_at", "user_traffic_sk"))
    return active(user_traffic).groupBy(by).agg(newest.alias("_t")).select(by, "_t.*")


def _fact_columns(rows: DataFrame, **keys: Column) -> DataFrame:
    """``sale_key`` is the sale version's own surrogate key: unique, and no extra numbering pass."""
    return rows.select(
        F.col("sale_sk").alias("sale_key"),
        "sale_id",
        *[expr.cast("long").alias(name) for name, expr in keys.items()],
        "date_key",
        F.col("cost_in_rubbles").alias("total_in_rubbles"),
        F.lit(1).alias("enrollment_count"),
    )


def fact_as_loaded(
    sales: DataFrame,
    enrollments: DataFrame,
    latest: DataFrame,
    dim_date: DataFrame,
    active_enrollments_only: bool = False,
) -> DataFrame:
    """Sales with the surrogate keys their versions were loaded with.

    ``latest`` is the written result of ``latest_traffic``; computed in place, the
    aggregate would sit between shuffle and join and keep a user with very many
    sales from being split.

    A sale of an enrollment version that has since ended drops out when
    ``active_enrollments_only`` is set (the incremental rebuild); sales outside
    the calendar always do.
    """
    e = active(enrollments) if active_enrollments_only else enrollments
    rows = (
        active(sales)
        .withColumn("date", F.col("sale_date").cast("date"))
        .join(e.select("enrollment_sk", "user_sk", "course_sk"), "enrollment_sk")
        .join(latest.select("user_sk", "traffic_source_sk"), "user_sk", "left")
        .join(dim_date.select("date", "date_key"), "date")
    )
    return _fact_columns(
        rows,
        user_key=F.col("user_sk"),
        course_key=F.col("course_sk"),
        sales_manager_key=F.col("sales_manager_sk"),
        traffic_source_key=F.coalesce("traffic_source_sk", F.lit(UNKNOWN_KEY)),
    )


def fact_current(tables: dict[str, DataFrame], latest: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sales with the keys of the versions open now, found through the business keys.

    Nothing drops out because a parent was re-versioned; a parent without an open
    version (a deleted user) becomes the unknown member. Needs the stored tables,
    whose rows carry the parents' business keys, and the written result of
    ``latest_traffic`` by ``user_id``.
    """

    def keys(table: str, natural: str, sk: str) -> DataFrame:
        return active(tables[table]).select(natural, sk)

    rows = (
        active(tables["sales"])
        .select("sale_sk", "sale_id", "enrollment_id", "manager_id", "sale_date", "cost_in_rubbles")
        .withColumn("date", F.col("sale_date").cast("date"))
        .join(active(tables["enrollments"]).select("enrollment_id", "user_id", "course_id"), "enrollment_id")
        .join(keys("users", "user_id", "user_sk"), "user_id", "left")
        .join(latest.select("user_id", "source_id"), "user_id", "left")
        .join(keys("courses", "course_id", "course_sk"), "course_id", "left")
        .join(keys("sales_managers", "manager_id", "sales_manager_sk"), "manager_id", "left")
        .join(keys("traffic_sources", "source_id", "traffic_source_sk"), "source_id", "left")
        .join(dim_date.select("date", "date_key"), "date")
    )
    return _fact_columns(
        rows,
        **{
            key: F.coalesce(sk, F.lit(UNKNOWN_KEY))
            for key, sk in (
                ("user_key", "user_sk"),
                ("course_key", "course_sk"),
                ("sales_manager_key", "sales_manager_sk"),
                ("traffic_source_key", "traffic_source_sk"),
            )
        },
    )


def insert_ignore_conflicts(
    target: DataFrame, rows: DataFrame, key: list[str], order: list[str]
) -> DataFrame:
    """Append rows whose key the target lacks; of repeated keys the first in ``order`` wins."""
    fresh = rows.join(target.select(*key), key, "left_anti")
    first = fresh.groupBy(*key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("_r"))
    return target.unionByName(first.select("_r.*"))

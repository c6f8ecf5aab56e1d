"""Keys, star builders, mutations, constraints, dates."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from support import OPEN, at, frame, rows, user

from chronostar.functions.dates import batch_id_from_date, previous_month, weekday
from chronostar.functions.predicates import differs_null_as_empty, is_distinct_from
from chronostar.operators import mutations, quality, star
from chronostar.operators.keys import TiedRows, assign_keys
from chronostar.plans import reports
from chronostar.plans.entities import USER_TRAFFIC, USERS
from chronostar.schemas import HISTORY, SOURCE, STAR, Col, ForeignKey, Table

# --- keys ---------------------------------------------------------------------


def test_keys_are_dense_and_ordered_under_skew(spark):
    rng = random.Random(1)
    data = [(1 if rng.random() < 0.4 else rng.randint(1, 9), i) for i in range(5000)]
    df = spark.createDataFrame(data, "a int, b int").repartition(8)
    numbered, last = assign_keys(df, "sk", ("a", "b"), 10)
    assert last == 5010
    assert rows(numbered, "sk", "a", "b") == sorted(
        ((11 + n, a, b) for n, (a, b) in enumerate(sorted(data))), key=repr
    )


def test_a_hot_leading_value_spreads_over_partitions(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20000).select(F.lit(1).alias("hot"), "id")
        numbered, _ = assign_keys(df, "sk", ("hot", "id"))
        sizes = [r["count"] for r in numbered.groupBy(F.input_file_name()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 10000
        assert numbered.filter("sk <> id + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_rows_that_tie_are_found_without_a_shuffle_of_their_own(spark, monkeypatch):
    from chronostar.operators import keys

    plans = []
    written = keys.stage
    monkeypatch.setattr(keys, "stage", lambda df, *a: plans.append(df._jdf.queryExecution().executedPlan().toString()) or written(df, *a))
    df = spark.range(9000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b"), F.lit("x").alias("c"))
    numbered, last = assign_keys(df, "sk", ("a", "b"), ties=("b",))
    assert last == 9000 and sorted(numbered.columns) == ["a", "b", "c", "sk"]
    assert plans[0].count("Exchange") == 1 and plans[0].count("Sort ") == 1 and "Window" in plans[0]
    with pytest.raises(TiedRows, match="b=77"):
        assign_keys(df.union(df.filter("b = 77")), "sk", ("a", "b"), ties=("b",))
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "a int, b int")
    with pytest.raises(TiedRows, match="a=None"):
        assign_keys(nulls, "sk", ("a",), ties=("a",))
    assert assign_keys(spark.range(0), "sk", ("id",), ties=("id",))[1] == 0


def test_keys_of_nothing(spark):
    numbered, last = assign_keys(spark.range(0), "sk", ("id",), 5)
    assert last == 5 and numbered.count() == 0


# --- star ---------------------------------------------------------------------


def traffic(spark, *data):
    full = [(sk, u, t, at(w), c, at("2024-01-01"), end, 1, 1, None, u, t) for sk, u, t, w, c, end in data]
    return frame(spark, full, USER_TRAFFIC.stored_schema)


def test_latest_referral_breaks_ties_by_key(spark):
    df = traffic(
        spark,
        (1, 1, 1, "2020-01-01", "a", OPEN),
        (2, 1, 2, "2020-01-02", "b", OPEN),
        (3, 1, 1, "2020-01-02", "c", OPEN),
        (4, 1, 2, "2021-01-01", "closed", at("2024-02-01")),
        (5, 2, 2, "2020-01-01", None, OPEN),
    )
    assert rows(star.latest_traffic(df), "user_sk", "traffic_source_sk", "campaign_code") == [(1, 1, "c"), (2, 2, None)]


def span(spark, first, last):
    return spark.sql(f"SELECT DATE '{first}' AS first, DATE '{last}' AS last")


def test_calendar(spark):
    days = star.calendar(span(spark, "2024-02-28", "2024-03-03"))
    assert days.columns == STAR["dim_date"].names
    assert rows(days.filter("day = 3")) == [(20240303, date(2024, 3, 3), 2024, 1, 3, 3, 0)]
    assert days.count() == 5


def sales(spark, *days, insert_id=2):
    data = [(i, i, 1, 1, at(d), 1, at("2024-01-01"), OPEN, 1, insert_id, None) for i, d in enumerate(days)]
    return frame(spark, data, HISTORY["sales"].schema)


@pytest.mark.parametrize(
    "days, expected",
    [
        (["2024-01-10 23:59:59"], ("2024-01-05", "2024-01-15")),
        (["2023-12-31", "2024-01-10"], ("2023-12-31", "2024-01-15")),
        (["2024-01-20 12:00:00"], ("2024-01-05", "2024-01-20")),
        ([], ("2024-01-05", "2024-01-15")),
    ],
)
def test_calendar_extension(spark, days, expected):
    dim = star.calendar(span(spark, "2024-01-05", "2024-01-15"))
    out = star.extend_calendar(dim, sales(spark, *days), 2)
    low, high = out.agg(F.min("date"), F.max("date")).first()
    assert (str(low), str(high)) == expected
    assert out.count() == (high - low).days + 1
    other_batch = star.extend_calendar(dim, sales(spark, *days), 3)
    assert other_batch.count() == 11


def test_calendar_extension_from_nothing(spark):
    empty = star.calendar(span(spark, "2024-01-01", "2024-01-01")).limit(0)
    assert star.extend_calendar(empty, sales(spark, "2024-01-10"), 2).count() == 1
    assert star.extend_calendar(empty, sales(spark), 2).count() == 0


def test_bounds_without_dates_are_today(spark):
    nothing = {t: frame(spark, [], HISTORY[t].schema) for t in HISTORY}
    span_row = star.overall_bounds(star.date_bounds(nothing), F.lit("2024-05-06").cast("date")).first()
    assert span_row == (date(2024, 5, 6), date(2024, 5, 6))


def test_sales_outside_the_calendar_drop(spark):
    enrollments = frame(
        spark,
        [(i, i, 1, 1, at("2024-01-01"), "active", at("2024-01-01"), OPEN, 1, 1, None) for i in range(3)],
        HISTORY["enrollments"].schema,
    )
    s = sales(spark, "2023-12-31", "2024-01-10", "2024-01-16")
    s = s.withColumn("enrollment_sk", F.col("sale_sk"))
    latest = star.latest_traffic(traffic(spark))
    fact = star.fact_as_loaded(s, enrollments, latest, star.calendar(span(spark, "2024-01-01", "2024-01-15")))
    assert rows(fact, "sale_id", "traffic_source_key", "date_key") == [(1, -1, 20240110)]


def users_history(spark, *data):
    full = [(sk, *user(i), at("2024-01-01"), end, 1, ins, upd) for sk, i, end, ins, upd in data]
    return frame(spark, full, USERS.stored_schema)


def test_refresh_and_fill_end_at_the_open_versions(spark):
    before = users_history(spark, (1, 1, OPEN, 1, None), (2, 2, OPEN, 1, None), (3, 3, OPEN, 1, None))
    after = users_history(
        spark,
        (1, 1, at("2024-02-02"), 1, 2),
        (2, 2, OPEN, 1, None),
        (3, 3, at("2024-02-02"), 1, 2),
        (4, 1, OPEN, 2, None),
        (5, 5, OPEN, 2, None),
        (6, 6, OPEN, 1, None),  # from a batch whose refresh was lost
    )
    dim = star.dimension("dim_user", before)
    refreshed = star.refresh_dimension("dim_user", dim, after, 2)
    assert rows(refreshed, "user_key") == [(2,), (4,), (5,)]
    filled = star.fill_missing("dim_user", refreshed, after)
    assert rows(filled) == rows(star.dimension("dim_user", after))


def test_unknown_member(spark):
    dim = star.dimension("dim_user", users_history(spark, (1, 1, OPEN, 1, None)))
    twice = star.with_unknown_member("dim_user", star.with_unknown_member("dim_user", dim))
    assert rows(twice, "user_key", "user_id", "email") == [(-1, -1, None), (1, 1, "u1@example.com")]
    assert twice.schema == dim.schema


def test_insert_ignore_conflicts(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "b"), (2, "a")], "k int, v string")
    assert rows(star.insert_ignore_conflicts(target, new, ["k"], ["v"])) == [(1, "old"), (2, "a")]


# --- mutations ------------------------------------------------------------------


def test_upsert_update_delete(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", None)], "id int, p string, q string")
    new = spark.createDataFrame([(2, "B", None), (4, "d", "z")], "id int, p string, q string")
    assert rows(mutations.upsert(base, new, ["id"])) == [(1, "a", "x"), (2, "B", None), (3, "c", None), (4, "d", "z")]
    changes = spark.createDataFrame([(1, None), (9, "q")], "id int, q string")
    assert rows(mutations.update_from(base, changes, ["id"])) == [(1, "a", None), (2, "b", "y"), (3, "c", None)]
    assert rows(mutations.delete_ids(base, "id", [1, 7]), "id") == [(2,), (3,)]
    assert rows(mutations.delete_ids(base, "id", new), "id") == [(1,), (3,)]
    assert mutations.delete_ids(base, "id", []).count() == 3
    assert rows(mutations.delete_ids(base, "p", ["a", *map(str, range(2000))]), "id") == [(2,), (3,)]
    for change in (mutations.upsert, mutations.update_from):
        with pytest.raises(Exception, match="repeated source key"):
            change(base, new.union(new), ["id"]).collect()


def test_pivot_keeps_channels_that_are_not_listed(spark):
    fact = spark.createDataFrame([(1, 1, 10, 1), (1, 2, 20, 1), (1, 9, 40, 1)], "date_key int, traffic_source_key long, total_in_rubbles int, enrollment_count int")
    days = spark.createDataFrame([(1, 2024, 1)], "date_key int, year int, quarter int")
    sources = spark.createDataFrame([(1, "web"), (2, "radio")], "traffic_source_key long, channel string")
    got = reports.traffic_source_pivot(fact, days, sources, ["web"]).first()
    assert (got.web, got.other, got.unknown) == (10, 20, 40)


def test_double_last_month(spark):
    days = ["2024-01-31 23:59:59", "2024-02-01", "2024-02-29 23:59:59", "2024-03-01"]
    df = spark.createDataFrame([(i, at(d), 10) for i, d in enumerate(days)], "id int, at timestamp_ntz, cost int")
    out = mutations.double_last_month(df, "cost", "at", F.lit("2024-03-31").cast("date"))
    assert rows(out, "id", "cost") == [(0, 10), (1, 20), (2, 20), (3, 10)]


def test_doubling_overflow_is_an_error(spark):
    df = spark.createDataFrame([(at("2024-02-01"), 2**31 - 1)], "at timestamp_ntz, cost int")
    with pytest.raises(Exception, match="OVERFLOW"):
        mutations.double_last_month(df, "cost", "at", F.lit("2024-03-31").cast("date")).collect()


# --- dates and predicates ---------------------------------------------------------


@pytest.mark.parametrize(
    "day, first, last",
    [
        ("2024-03-31", date(2024, 2, 1), date(2024, 2, 29)),
        ("2024-01-01", date(2023, 12, 1), date(2023, 12, 31)),
        ("2023-03-01", date(2023, 2, 1), date(2023, 2, 28)),
    ],
)
def test_previous_month(spark, day, first, last):
    a, b = previous_month(F.lit(day).cast("date"))
    assert spark.range(1).select(a, b).first() == (first, last)


def test_weekday_and_batch_id(spark):
    day = F.lit("2024-03-03").cast("date")  # a Sunday
    assert spark.range(1).select(weekday(day), batch_id_from_date(day)).first() == (0, 20240303)


def test_predicates(spark):
    df = spark.createDataFrame([(None, None), (None, ""), ("a", None), ("a", "a"), ("a", "b")], "l string, r string")
    left, right = F.col("l"), F.col("r")
    out = df.select(is_distinct_from(left, right), differs_null_as_empty(left, right)).collect()
    assert [tuple(r) for r in out] == [(False, False), (True, False), (True, True), (False, False), (True, True)]


# --- constraints ----------------------------------------------------------------------


def test_declared_rules_find_each_violation(spark):
    data = [
        user(1),
        (2, None, "l", "u1@example.com", "p" * 21, "X", at("2020-01-01")),
        (2, "f", "l", "e", None, "X", at("2020-01-01")),
    ]
    users = SOURCE["users"]
    report = {r.rule: r.violations for r in quality.check_table(frame(spark, data, users.schema), users).collect()}
    found = {rule for rule, n in report.items() if n}
    assert found == {"not_null:first_name", "max_length:phone", "unique:user_id", "unique:email"}


def test_values_and_references(spark):
    table = Table(
        "t",
        (Col("id", SOURCE["users"].schema["user_id"].dataType),),
        non_negative=("n",),
        enums={"s": ("a", "b")},
        foreign_keys=(ForeignKey("p", "parents", "id"),),
    )
    df = spark.createDataFrame(
        [(1, -1, "a", 1), (2, 0, "z", 5), (3, None, None, 5), (4, 1, "b", None)], "id long, n int, s string, p int"
    )
    parents = {"parents": spark.createDataFrame([(1,), (2,)], "id int")}
    report = {r.rule: r.violations for r in quality.check_table(df, table, parents).collect()}
    assert report == {"not_null:id": 0, "non_negative:n": 1, "enum:s": 1, "foreign_key:p": 2}
    assert rows(quality.dangling(df, parents["parents"], table.foreign_keys[0]), "key", "rows") == [(5, 2)]

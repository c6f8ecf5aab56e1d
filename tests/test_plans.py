"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F
from support import OPEN, at

from chronostar.catalog.lab import lab
from chronostar.operators import scd2, star
from chronostar.operators.keys import resolve_parents
from chronostar.plans import reports
from chronostar.plans.entities import ENROLLMENTS, ENTITIES, USER_TRAFFIC, USERS, Batch
from chronostar.session import stage, stage_compact, tune

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def env(spark):
    return lab(spark, SF_DIR)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture
def tiny_skew(spark, no_broadcast):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # one map task could not be split
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)
    tune(spark)


def test_merge_of_unique_keys_is_one_join(env, no_broadcast):
    source = env.loaded.current("users").select(*USERS.payload)
    text = plan(scd2.merge_rows(source, env.loaded.current("users"), USERS, env.batch))
    assert text.count("FullOuter") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # One shuffle and one sort per side; the check for repeated keys uses the join's.
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Sort [") == 2


@pytest.mark.parametrize("table", ["enrollments", "sales"])
def test_merge_compares_before_it_looks_up_parents(env, no_broadcast, table):
    """The whole source meets the table's own versions only; two shuffles, none of a parent."""
    entity = ENTITIES[table]
    source = env.loaded.current(table).drop(entity.sk, *[p.sk for p in entity.parents], *entity.audit_names)
    pairs = scd2.acting_pairs(source, env.loaded.current(table), entity)
    text = plan(pairs)
    assert text.count("Join") - text.count("BroadcastHashJoin LeftAnti") == 1
    assert text.count("Exchange hashpartitioning") == 2
    parents = {p.table: env.loaded.current(p.table) for p in entity.parents}
    found = scd2.with_parents(stage(pairs, "pairs"), entity, parents)
    assert all(f"{p.natural}" in plan(found) for p in entity.parents)
    assert found.count() == 0


def test_days_prune_the_months_of_the_fact(env):
    fact = env.complete.star("fact_sales", by_month=True)
    days = env.complete.star("dim_date").filter("year = 1995 and quarter = 2")
    env.spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.enabled", "true")
    text = reports.on_days(fact, days)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text.lower() and "PartitionFilters: [" in text
    got = reports.on_days(fact, days).count()
    assert got == fact.filter("date_key between 19950401 and 19950630").count() > 0


@pytest.mark.parametrize("table", sorted(ENTITIES))
def test_steps_use_anti_joins(env, table):
    entity = ENTITIES[table]
    rows = scd2.new_rows(env.second_rows(entity), env.loaded.current(table), entity, env.batch)
    assert "LeftAnti" in plan(rows)


def test_open_versions_are_filtered_in_the_scan(env):
    dim = star.dimension("dim_traffic_source", env.merged.current("traffic_sources"))
    text = dim._jdf.queryExecution().explainString(
        env.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(end_date,9999-12-31T00:00)" in text
    assert "details" not in text.split("ReadSchema")[1].split("\n")[0]


def test_date_range_reaches_the_fact_scan(env):
    from datetime import date

    s = env.loaded.star
    df = reports.filtered_revenue(
        s("fact_sales"), s("dim_user"), s("dim_course"), s("dim_date"), first=date(1995, 1, 1), last=date(1995, 6, 30)
    )
    text = df._jdf.queryExecution().explainString(
        env.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(date_key,19950101)" in text and "LessThanOrEqual(date_key,19950630)" in text


def test_latest_referral_needs_no_window(env):
    text = plan(star.latest_traffic(env.loaded.current("user_traffic")))
    assert "Window" not in text and "partial_max_by" in text


def skewed_users(spark, n=30000):
    """A third of the children belong to one user."""
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997 + 1)
    return spark.range(n).select("id", key.alias("user_id")).repartition(8)


def versions(spark, entity, n, **columns):
    out = []
    for f in entity.stored_schema:
        value = columns.get(f.name, F.lit(None))
        out.append(value.cast(f.dataType).alias(f.name))
    return spark.range(1, n + 1).withColumn("open", F.lit(str(OPEN)).cast("timestamp_ntz")).select(*out)


def test_hot_parent_is_split(spark, tiny_skew):
    key, end = F.col("id"), F.col("open")
    parents = {
        "users": versions(spark, USERS, 997, user_sk=key, user_id=key, end_date=end),
        "courses": versions(spark, ENTITIES["courses"], 5, course_sk=key, course_id=key, end_date=end),
    }
    children = skewed_users(spark).select(
        F.col("id").alias("enrollment_id"),
        "user_id",
        (F.col("id") % 5 + 1).alias("course_id"),
        F.lit(str(at("2020-01-01"))).cast("timestamp_ntz").alias("enrolled_at"),
        F.lit("active").alias("status"),
    )
    out = resolve_parents(children, ENROLLMENTS, parents)
    assert "skew=true" in final_plan(out)
    assert out.count() == 30000


def test_parents_are_sent_to_all_tasks_by_the_size_of_their_rows(spark, tmp_path):
    """100,000 courses have 0.4 MB in their file and 7 in a hash table; the driver would build it."""
    key, end = F.col("id"), F.col("open")
    courses = versions(spark, ENTITIES["courses"], 100000, course_sk=key, course_id=key, end_date=end)
    users = versions(spark, USERS, 100000, user_sk=key, user_id=key, end_date=end)
    parents = {t: stage_compact(df, t, str(tmp_path / t)) for t, df in (("courses", courses), ("users", users))}
    few = {t: stage_compact(df.filter(f"{t[:-1]}_id < 100"), t, str(tmp_path / f"few-{t}")) for t, df in parents.items()}
    children = spark.range(1000000).select(
        key.alias("enrollment_id"),
        key.alias("user_id"),
        key.alias("course_id"),
        F.lit(str(at("2020-01-01"))).cast("timestamp_ntz").alias("enrolled_at"),
        F.lit("active").alias("status"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        assert "BroadcastHashJoin" not in plan(resolve_parents(children, ENROLLMENTS, parents))
        assert plan(resolve_parents(children, ENROLLMENTS, few)).count("BroadcastHashJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_few_ended_versions_are_sent_to_all_tasks(spark, store, tmp_path):
    """A million keys take some 70 MB of the driver's memory in each read of a table."""
    users = versions(spark, USERS, 10, user_sk=F.col("id"), user_id=F.col("id"), end_date=F.col("open"))
    path = str(tmp_path / "users")
    users.write.parquet(path)

    def hinted(ended):
        entry = {"current": [path], "ended": [path], "closed": [path], "ended_rows": ended}
        df = store.current("users", {"tables": {"users": entry}})
        return "broadcast" in df._jdf.queryExecution().optimizedPlan().toString()

    assert hinted(100_000) and not hinted(500_000)


def test_hot_referral_key_is_split(spark, tiny_skew):
    """Many open versions of one key: the left join from the versions splits."""
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    when = F.lit(str(at("2020-01-01"))).cast("timestamp_ntz")
    active = versions(
        spark, USER_TRAFFIC, 30000, user_traffic_sk=F.col("id"), user_sk=key, traffic_source_sk=F.lit(1),
        referred_at=when, campaign_code=F.lit("A"), end_date=F.col("open"), user_id=key, source_id=F.lit(1),
    ).repartition(8)
    source = active.filter("user_traffic_sk = user_sk").select(*USER_TRAFFIC.payload).withColumn(
        "campaign_code", F.lit("B")
    )
    merged = scd2.merge_rows(source, active, USER_TRAFFIC, Batch(2, "2024-02-02 00:00:00"))
    assert "skew=true" in final_plan(merged)
    # Key 1 has 10,000 copies and its source row is filtered out with user_sk 3, 6, ...; the row of id 1 stays.
    counts = {r[scd2.STATE]: r["count"] for r in merged.groupBy(scd2.STATE).count().collect()}
    assert counts["closed"] == counts["opened"] == 30000


def test_bounds_use_no_cross_join(env):
    text = plan(star.date_bounds({t: env.loaded.current(t) for t in ENTITIES}))
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_hot_user_is_split_in_the_fact(spark, tiny_skew):
    n, end, key = 30000, F.col("open"), F.col("id")
    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997 + 1)
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 2).cast("int")).cast("timestamp_ntz")
    sales = versions(
        spark, ENTITIES["sales"], n, sale_sk=key, sale_id=key, enrollment_sk=key, sale_date=day, end_date=end,
        cost_in_rubbles=F.lit(1),
    )
    enrollments = versions(
        spark, ENROLLMENTS, n, enrollment_sk=key, user_sk=hot, course_sk=F.lit(1), end_date=end
    ).repartition(8)
    referrals = versions(
        spark, USER_TRAFFIC, n, user_traffic_sk=key, user_sk=hot, traffic_source_sk=key % 5, referred_at=day,
        end_date=end,
    )
    days = star.calendar(spark.sql("SELECT DATE '2020-01-01' AS first, DATE '2020-01-02' AS last"))
    latest = stage(star.latest_traffic(referrals), "latest")
    fact = star.fact_as_loaded(sales, enrollments, latest, days)
    assert "skew=true" in final_plan(fact)
    assert fact.count() == n


def test_hot_key_in_an_extract_is_split(spark, tiny_skew):
    from chronostar.operators.traffic import SEQ, merge_extract

    n, end, key = 30000, F.col("open"), F.col("id")
    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    day = F.lit(str(at("2020-01-01"))).cast("timestamp_ntz")
    users = versions(spark, USERS, n, user_sk=key, user_id=key, end_date=end)
    sources = versions(spark, ENTITIES["traffic_sources"], 1, traffic_source_sk=key, source_id=key, end_date=end)
    active = versions(
        spark, USER_TRAFFIC, n, user_traffic_sk=key, user_sk=hot, traffic_source_sk=F.lit(1), referred_at=day,
        campaign_code=F.lit("A"), end_date=end, user_id=hot, source_id=F.lit(1),
    ).repartition(8)
    extract = spark.range(1, n + 1).select(
        hot.alias("user_id"), F.lit(1).alias("source_id"), day.alias("referred_at"), F.lit("B").alias("campaign_code"),
        F.struct("id").alias(SEQ),
    ).repartition(8)
    out = merge_extract(extract, active, users, sources, Batch(2, "2024-02-02 00:00:00", 2))
    assert "skew=true" in final_plan(out)
    states = {r[scd2.STATE]: r["count"] for r in out.groupBy(scd2.STATE).count().collect()}
    assert states == {"closed": n, "opened": n - n // 3}  # one successor per key


def test_rules_are_checked_table_by_table(env):
    """One plan of all tables would hold the broadcasts of all in the driver at once."""
    from chronostar.catalog.queries import dq_declared_rules
    from chronostar.schemas import HISTORY, STAR

    found = dq_declared_rules(env)
    assert "Join" not in plan(found) and "Aggregate" not in plan(found)
    assert {r["table"] for r in found.select("table").distinct().collect()} == {*HISTORY, *STAR}


def test_lists_of_deleted_users_stay_off_the_driver(env):
    from chronostar.catalog.queries import delete_users_list

    plan = delete_users_list(env)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 2
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan

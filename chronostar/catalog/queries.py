"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronostar.catalog.lab import INC_ID, INC_TS, Lab, lab
from chronostar.functions.dates import batch_id_from_date, date_key, previous_month
from chronostar.functions.predicates import differs_null_as_empty, is_active, is_distinct_from, touched_by
from chronostar.operators import mutations, quality, scd2, star
from chronostar.operators.keys import assign_keys, attach_business_key, resolve_parents
from chronostar.operators.traffic import PASS, partial_key_matches, union_sources
from chronostar.plans import reports
from chronostar.plans.entities import ENROLLMENTS, ENTITIES, USER_TRAFFIC, USERS, Entity
from chronostar.plans.jobs import row_counts
from chronostar.schemas import HISTORY, SOURCE, STAR, Col, Table, timestamp
from chronostar.session import stage, stage_path
from chronostar.sources.fixtures import LINE_REPEATS
from chronostar.sources.extracts import read_extract, read_rejects
from chronostar.streaming.arrivals import fold_arrivals

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

CHANNELS = ("ads", "messaging", "referral", "web")


def query(name: str):
    """Register a function of a loaded lab."""

    def register(build: Callable[[Lab], DataFrame]) -> Callable[[Lab], DataFrame]:
        _QUERIES[name] = lambda spark, sf_dir: build(lab(spark, sf_dir))
        return build

    return register


def shown(df: DataFrame) -> DataFrame:
    """End dates and closing batches as text.

    On a pandas client year 9999 does not fit a nanosecond timestamp, and whole
    numbers with gaps would turn into floats.
    """
    if "end_date" not in df.columns:
        return df
    return df.withColumns(
        {
            "end_date": F.date_format("end_date", "yyyy-MM-dd HH:mm:ss"),
            "update_id": F.col("update_id").cast("string"),
        }
    )


def versions(df: DataFrame, entity: Entity, with_key: bool = True) -> DataFrame:
    names = HISTORY[entity.name].names
    return shown(df.select(*(names if with_key else names[1:])))


def _raw(env: Lab, name: str) -> DataFrame:
    return env.first._read(name)


# --- history merges: five views of every entity --------------------------------


def _register_entity(entity: Entity) -> None:
    name = entity.name

    @query(f"scd2_{name}_initial")
    def initial(env: Lab) -> DataFrame:
        rows = scd2.initial_rows(env.first_rows(entity), entity, env.full_batch)
        return versions(assign_keys(rows, entity.sk, entity.order)[0], entity)

    @query(f"scd2_{name}_new")
    def new(env: Lab) -> DataFrame:
        current = env.loaded.current(name)
        return versions(scd2.new_rows(env.second_rows(entity), current, entity, env.batch), entity, False)

    @query(f"scd2_{name}_changed")
    def changed(env: Lab) -> DataFrame:
        current = env.loaded.current(name)
        return versions(scd2.changed_rows(env.second_rows(entity), current, entity, env.batch), entity, False)

    @query(f"scd2_{name}_closed")
    def closed(env: Lab) -> DataFrame:
        current = env.loaded.current(name)
        return versions(scd2.closed_rows(env.second_rows(entity), current, entity, env.batch), entity)

    @query(f"scd2_{name}_merge")
    def merge(env: Lab) -> DataFrame:
        return versions(env.merge(entity), entity)


for _entity in ENTITIES.values():
    _register_entity(_entity)


@query("scd2_users_deleted")
def users_deleted(env: Lab) -> DataFrame:
    rows = scd2.deleted_rows(env.second_rows(USERS), env.loaded.current("users"), USERS, env.batch)
    return versions(rows, USERS)


@query("scd2_user_traffic_csv_initial")
def csv_initial(env: Lab) -> DataFrame:
    parents = {p.table: env.loaded.current(p.table) for p in USER_TRAFFIC.parents}
    keyed = resolve_parents(env.first.extract(), USER_TRAFFIC, parents)
    batch = type(env.csv_batch)(env.full_batch.batch_id, env.full_batch.ts, env.csv_batch.audit)
    rows = scd2.initial_rows(keyed, USER_TRAFFIC, batch)
    start = env.first_rows(USER_TRAFFIC).count()  # the extract is numbered after the operational referrals
    return versions(assign_keys(rows, USER_TRAFFIC.sk, USER_TRAFFIC.order, start)[0], USER_TRAFFIC)


@query("scd2_user_traffic_csv_new")
def csv_new(env: Lab) -> DataFrame:
    return versions(env.extract_rows().filter(F.col(PASS) == 0), USER_TRAFFIC, False)


@query("scd2_user_traffic_csv_changed")
def csv_changed(env: Lab) -> DataFrame:
    return versions(env.extract_rows().filter(F.col(PASS) == 1), USER_TRAFFIC, False)


@query("scd2_user_traffic_csv_closed")
def csv_closed(env: Lab) -> DataFrame:
    return versions(env.extract_rows().filter(F.col(scd2.STATE) == scd2.CLOSED), USER_TRAFFIC)


@query("scd2_user_traffic_csv_merge")
def csv_merge(env: Lab) -> DataFrame:
    return versions(env.merge_extract(), USER_TRAFFIC)


@query("user_traffic_union")
def traffic_union(env: Lab) -> DataFrame:
    return union_sources(env.first.table("user_traffic"), env.first.extract())


@query("user_traffic_partial_key_match")
def traffic_partial_key(env: Lab) -> DataFrame:
    source, current = env.second_rows(USER_TRAFFIC), env.loaded.current("user_traffic")
    opened = scd2.new_rows(source, current, USER_TRAFFIC, env.batch)
    return partial_key_matches(source, current.unionByName(opened.drop(scd2.STATE)))


# --- star ----------------------------------------------------------------------


def _register_dimension(name: str) -> None:
    table = star.DIMENSIONS[name][0]

    @query(name)
    def build(env: Lab) -> DataFrame:
        return star.dimension(name, env.loaded.history(table))

    @query(f"{name}_refresh")
    def refresh(env: Lab) -> DataFrame:
        return star.refresh_dimension(name, env.loaded.star(name), env.merged.history(table), INC_ID)

    if name in ("dim_user", "dim_traffic_source"):

        @query(f"{name}_fill_missing")
        def fill(env: Lab) -> DataFrame:
            return star.fill_missing(name, env.loaded.star(name), env.merged.history(table))


for _name in star.DIMENSIONS:
    _register_dimension(_name)


def _bounds(env: Lab) -> DataFrame:
    return star.date_bounds({t: env.loaded.history(t) for t in ENTITIES})


@query("dim_date")
def dim_date(env: Lab) -> DataFrame:
    return star.calendar(star.overall_bounds(_bounds(env)))


@query("dim_date_extend")
def dim_date_extend(env: Lab) -> DataFrame:
    """A calendar of the courses' days, widened to the batch's sales."""
    day = F.col("created_at").cast("date")
    short = star.calendar(env.loaded.history("courses").agg(F.min(day).alias("first"), F.max(day).alias("last")))
    return star.extend_calendar(short, env.merged.history("sales"), INC_ID)


@query("dim_date_day_count")
def dim_date_day_count(env: Lab) -> DataFrame:
    span = star.overall_bounds(_bounds(env))
    return span.select("first", "last", (F.datediff("last", "first") + 1).alias("days"))


def _latest(referrals: DataFrame, by: str = "user_sk", keep: str = "traffic_source_sk") -> DataFrame:
    return stage(star.latest_traffic(referrals, by, keep), "latest")


@query("fact_sales")
def fact_sales(env: Lab) -> DataFrame:
    h = env.loaded.history
    return star.fact_as_loaded(h("sales"), h("enrollments"), _latest(h("user_traffic")), env.loaded.star("dim_date"))


@query("fact_sales_rebuild")
def fact_sales_rebuild(env: Lab) -> DataFrame:
    h = env.merged.history
    latest = _latest(h("user_traffic"))
    return star.fact_as_loaded(h("sales"), h("enrollments"), latest, env.merged.star("dim_date"), True)


@query("fact_sales_current_keys")
def fact_sales_current_keys(env: Lab) -> DataFrame:
    tables = {t: env.merged.stored(t) for t in ENTITIES}
    latest = _latest(tables["user_traffic"], "user_id", "source_id")
    return star.fact_current(tables, latest, env.merged.star("dim_date"))


@query("latest_traffic_per_user")
def latest_traffic_per_user(env: Lab) -> DataFrame:
    return star.latest_traffic(env.merged.history("user_traffic"))


# --- predicates, joins, aggregates, scalar functions -----------------------------


@query("pred_is_distinct_from")
def pred_is_distinct_from(env: Lab) -> DataFrame:
    old = env.first.table("users").select("user_id", F.col("phone").alias("old_phone"))
    new = env.second.table("users").select("user_id", F.col("phone").alias("new_phone"))
    return old.join(new, "user_id").filter(is_distinct_from(F.col("old_phone"), F.col("new_phone")))


@query("pred_null_as_empty")
def pred_null_as_empty(env: Lab) -> DataFrame:
    old = env.first.table("courses").select("course_id", F.col("description").alias("old"))
    new = env.second.table("courses").select("course_id", F.col("description").alias("new"))
    both = old.join(new, "course_id")
    return both.select(
        "course_id",
        is_distinct_from(F.col("old"), F.col("new")).alias("null_safe"),
        differs_null_as_empty(F.col("old"), F.col("new")).alias("null_as_empty"),
    )


@query("join_inner_lookup")
def join_inner_lookup(env: Lab) -> DataFrame:
    rows = scd2.denormalise_courses(
        env.first.table("courses"), env.first.table("categories"), env.first.table("subcategories")
    )
    return rows.select("course_id", "category", "sub_category")


@query("join_active_lookup")
def join_active_lookup(env: Lab) -> DataFrame:
    return env.second_rows(ENROLLMENTS).select("enrollment_id", "user_sk", "course_sk")


@query("join_anti_new")
def join_anti_new(env: Lab) -> DataFrame:
    known = env.loaded.current("users").select("user_id")
    return env.second.table("users").join(known, "user_id", "left_anti").select("user_id", "email")


@query("join_composite_key")
def join_composite_key(env: Lab) -> DataFrame:
    key = list(USER_TRAFFIC.key)
    source = env.second_rows(USER_TRAFFIC).select(*key, F.col("campaign_code").alias("source_campaign"))
    stored = env.loaded.current("user_traffic").select(
        *key, "user_traffic_sk", F.col("campaign_code").alias("stored_campaign")
    )
    return source.join(stored, key)


@query("join_left_default")
def join_left_default(env: Lab) -> DataFrame:
    latest = _latest(env.loaded.current("user_traffic"))
    enrollments = env.loaded.current("enrollments").select("enrollment_sk", "user_sk")
    return enrollments.join(latest, "user_sk", "left").select(
        "enrollment_sk", F.coalesce("traffic_source_sk", F.lit(-1).cast("long")).alias("traffic_source_key")
    )


@query("join_date_dim")
def join_date_dim(env: Lab) -> DataFrame:
    days = env.loaded.star("dim_date").select("date", "date_key", "weekday")
    sales = env.loaded.current("sales").select("sale_id", F.col("sale_date").cast("date").alias("date"))
    return sales.join(days, "date").select("sale_id", "date_key", "weekday")


@query("join_semi_touched")
def join_semi_touched(env: Lab) -> DataFrame:
    touched = env.merged.history("users").filter(touched_by(INC_ID)).select(F.col("user_sk").alias("user_key"))
    return env.loaded.star("dim_user").join(touched, "user_key", "left_semi")


@query("join_scalar_subquery")
def join_scalar_subquery(env: Lab) -> DataFrame:
    rows = attach_business_key(
        env.merged.history("enrollments"), env.merged.history("users"), "user_sk", "user_id"
    )
    rows = attach_business_key(rows, env.merged.history("courses"), "course_sk", "course_id")
    return rows.select("enrollment_sk", "enrollment_id", "user_id", "course_id")


@query("agg_row_counts")
def agg_row_counts(env: Lab) -> DataFrame:
    return row_counts(env.merged.finished())


@query("full_load")
def full_load_counts(env: Lab) -> DataFrame:
    """Row counts after the full load job."""
    return row_counts(env.loaded.finished())


@query("incremental_load")
def incremental_load_rows(env: Lab) -> DataFrame:
    """Open, closed and batch-touched versions per table after the incremental job."""
    parts = []
    store = env.merged.finished()
    for table in HISTORY:
        counted = store.history(table).agg(
            F.count_if(is_active()).alias("open"),
            F.count_if(~is_active()).alias("closed"),
            F.count_if(F.coalesce(touched_by(INC_ID), F.lit(False))).alias("touched"),
        )
        parts.append(counted.select(F.lit(table).alias("table"), "open", "closed", "touched"))
    return reduce(DataFrame.unionByName, parts)


@query("csv_extract_scan")
def csv_extract_scan(env: Lab) -> DataFrame:
    """An extract of 80 columns in another order, with quotes and line breaks, read by name."""
    folder = stage_path(env.spark, "extract")
    rows = env.first.extract().select(
        F.concat(F.lit('say "'), "campaign_code", F.lit('",\ntwice')).alias("campaign_code"),
        *[F.lit(f"not needed, {i}").alias(f"remark{i}") for i in range(76)],
        F.date_format("referred_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("referred_at"),
        "source_id",
        "user_id",
    )
    rows.write.option("header", True).option("escape", '"').csv(folder)
    return read_extract(env.spark, folder).select("user_id", "source_id", "referred_at", "campaign_code")


@query("csv_extract_rejects")
def csv_extract_rejects(env: Lab) -> DataFrame:
    """An extract in which some records miss a field and some have one more."""
    folder = stage_path(env.spark, "extract")
    day = F.date_format("referred_at", "yyyy-MM-dd")
    rows = env.first.extract().select("user_id", "source_id", day.alias("day"), "campaign_code")
    short, long = F.col("user_id") % 13 == 4, F.col("user_id") % 17 == 6
    text = F.concat_ws(",", "user_id", F.when(~short, F.col("source_id")), "day", "campaign_code", F.when(long, F.lit("more")))
    # One column named like the whole header, so that each file begins with it; nothing is quoted.
    plain = {"header": True, "sep": "\u0001", "quote": "\u0000"}
    rows.select(text.alias("user_id,source_id,referred_at,campaign_code")).write.options(**plain).csv(folder)
    return read_rejects(env.spark, folder).select("n_fields", "n_columns", "record")


@query("stream_csv_arrivals")
def stream_csv_arrivals(env: Lab) -> DataFrame:
    """The second extract arriving as files on top of the full load."""
    folder = stage_path(env.spark, "arrivals")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    env.second.extract().drop("_seq").write.option("header", True).option("timestampNTZFormat", micros).csv(folder)
    store = env.loaded.branch(stage_path(env.spark, "stream-warehouse"))
    checkpoint = stage_path(env.spark, "stream-checkpoint")
    fold_arrivals(store, folder, checkpoint, INC_ID, clock=lambda: INC_TS).awaitTermination()
    return versions(store.history("user_traffic"), USER_TRAFFIC, with_key=False)


@query("agg_date_bounds")
def agg_date_bounds(env: Lab) -> DataFrame:
    return _bounds(env)


@query("agg_batch_sale_bounds")
def agg_batch_sale_bounds(env: Lab) -> DataFrame:
    return star.batch_sale_bounds(env.merged.history("sales"), INC_ID)


@query("agg_least_greatest")
def agg_least_greatest(env: Lab) -> DataFrame:
    return star.overall_bounds(_bounds(env))


@query("agg_merge_summary")
def agg_merge_summary(env: Lab) -> DataFrame:
    parts = [
        scd2.merge_summary(env.second_rows(e), env.loaded.current(e.name), e)
        for e in ENTITIES.values()
    ]
    # The extract's pass: versions opened for unknown keys and for known ones, versions closed.
    kind = F.when(F.col(scd2.STATE) == scd2.CLOSED, "closed").when(F.col(PASS) == 0, "new").otherwise("changed")
    extract = env.extract_rows().filter(F.col(scd2.STATE) != scd2.KEPT).groupBy(kind.alias("class"))
    counted = extract.agg(F.count(F.lit(1)).alias("rows"))
    parts.append(counted.select(F.lit("user_traffic_csv").alias("table"), "class", "rows"))
    return reduce(DataFrame.unionByName, parts)


@query("assign_surrogate_keys")
def assign_surrogate_keys(env: Lab) -> DataFrame:
    orders = _raw(env, "orders").select("o_orderkey", "o_orderdate")
    return assign_keys(orders, "order_sk", ("o_orderdate", "o_orderkey"), 1000)[0]


@query("limit_sample")
def limit_sample(env: Lab) -> DataFrame:
    return env.loaded.star("dim_course").orderBy("course_key").limit(5)


@query("top_users_by_id")
def top_users_by_id(env: Lab) -> DataFrame:
    return versions(env.loaded.history("users").orderBy(F.desc("user_id")).limit(5), USERS)


@query("insert_ignore_conflicts")
def insert_ignore_conflicts(env: Lab) -> DataFrame:
    """Order lines into the first snapshot's sales; a line key repeats in the input."""
    target = env.first.table("sales").select("sale_id", "manager_id", F.col("sale_date").cast("date").alias("day"))
    lines = _raw(env, "lineitem").select(
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * LINE_REPEATS).alias("sale_id"),
        F.col("l_suppkey").alias("manager_id"),
        F.col("l_shipdate").cast("date").alias("day"),
    )
    return star.insert_ignore_conflicts(target, lines, ["sale_id"], ["day", "manager_id"])


@query("scalar_casts")
def scalar_casts(env: Lab) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return _raw(env, "orders").select(
        "o_orderkey",
        day.alias("day"),
        date_key(day).alias("day_key"),
        F.floor("o_totalprice").cast("int").alias("price"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        timestamp("2024-02-01 10:20:30").alias("stamp"),
    )


@query("last_month_range")
def last_month_range(env: Lab) -> DataFrame:
    days = _raw(env, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    first, last = previous_month(F.col("day"))
    return days.select("day", first.alias("first_day"), last.alias("last_day"))


@query("batch_id_from_date")
def batch_ids(env: Lab) -> DataFrame:
    days = _raw(env, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select("day", batch_id_from_date(F.col("day")).alias("batch_id"))


# --- source mutations -------------------------------------------------------------


@query("upsert_users")
def upsert_users(env: Lab) -> DataFrame:
    return mutations.upsert(env.first.table("users"), env.second.table("users"), ["user_id"])


@query("update_traffic_sources")
def update_traffic_sources(env: Lab) -> DataFrame:
    changes = env.second.table("traffic_sources").filter("name <> 'click'").select("source_id", "channel", "details")
    return mutations.update_from(env.first.table("traffic_sources"), changes, ["source_id"])


@query("delete_users")
def delete_users(env: Lab) -> DataFrame:
    indebted = _raw(env, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return mutations.delete_ids(env.first.table("users"), "user_id", indebted)


@query("delete_users_list")
def delete_users_list(env: Lab) -> DataFrame:
    """Deletes by long lists: by number, then by text."""
    users = env.first.table("users")
    customers = _raw(env, "customer")
    ids = customers.filter("c_custkey % 3 = 1").select(F.col("c_custkey").alias("user_id"))
    emails = customers.select(F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"))
    kept = mutations.delete_ids(users, "user_id", ids)
    return mutations.delete_ids(kept, "email", emails.filter(F.col("email").endswith("7@example.com")))


@query("double_last_month_cost")
def double_last_month_cost(env: Lab) -> DataFrame:
    today = F.lit("1997-03-15").cast("date")
    return mutations.double_last_month(env.first.table("sales"), "cost_in_rubbles", "sale_date", today)


# --- reports ------------------------------------------------------------------------


@query("revenue_by_quarter")
def revenue_by_quarter(env: Lab) -> DataFrame:
    return reports.revenue_by_quarter(env.loaded.star("fact_sales"), env.loaded.star("dim_date"))


@query("traffic_source_pivot")
def traffic_source_pivot(env: Lab) -> DataFrame:
    s = env.loaded.star
    return reports.traffic_source_pivot(s("fact_sales"), s("dim_date"), s("dim_traffic_source"), CHANNELS)


@query("top_selling_courses")
def top_selling_courses(env: Lab) -> DataFrame:
    return reports.top_selling_courses(env.loaded.star("fact_sales"), env.loaded.star("dim_course"))


@query("filtered_revenue")
def filtered_revenue(env: Lab) -> DataFrame:
    s = env.loaded.star
    return reports.filtered_revenue(
        s("fact_sales"),
        s("dim_user"),
        s("dim_course"),
        s("dim_date"),
        categories=("ECONOMY", "PROMO", "STANDARD"),
        first=date(1995, 1, 1),
        last=date(1997, 6, 30),
        countries=("NATION_1", "NATION_2", "NATION_3"),
    )


@query("revenue_by_quarter_merged")
def revenue_by_quarter_merged(env: Lab) -> DataFrame:
    return reports.revenue_by_quarter(env.complete.star("fact_sales"), env.complete.star("dim_date"))


@query("traffic_source_pivot_merged")
def traffic_source_pivot_merged(env: Lab) -> DataFrame:
    s = env.complete.star
    return reports.traffic_source_pivot(s("fact_sales"), s("dim_date"), s("dim_traffic_source"), CHANNELS)


@query("top_selling_courses_merged")
def top_selling_courses_merged(env: Lab) -> DataFrame:
    return reports.top_selling_courses(env.complete.star("fact_sales"), env.complete.star("dim_course"))


@query("filtered_revenue_merged")
def filtered_revenue_merged(env: Lab) -> DataFrame:
    """All revenue after the merge, sales of deleted users included."""
    s = env.complete.star
    return reports.filtered_revenue(s("fact_sales", by_month=True), s("dim_user"), s("dim_course"), s("dim_date"))


@query("fact_reconciliation")
def fact_reconciliation(env: Lab) -> DataFrame:
    s = env.complete.star
    return reports.reconciliation(
        s("fact_sales"),
        env.complete.current("sales"),
        s("dim_user"),
        s("dim_course"),
        s("dim_date"),
        s("dim_traffic_source"),
        CHANNELS,
    )


# --- constraints --------------------------------------------------------------------

_STRICT_CUSTOMER = Table(
    "customer",
    (
        Col("c_name", SOURCE["users"].schema["email"].dataType, length=17),
        Col("c_mktsegment", SOURCE["users"].schema["email"].dataType, length=9),
    ),
    non_negative=("c_acctbal",),
)
_STRICT_ORDERS = Table("orders", (), enums={"o_orderstatus": ("F", "O"), "o_orderpriority": ("1-URGENT", "2-HIGH")})


@query("dq_not_null")
def dq_not_null(env: Lab) -> DataFrame:
    """Every history column of users, the optional ones included."""
    users = HISTORY["users"]
    strict = Table("users", tuple(Col(c.name, c.type) for c in users.columns))
    return quality.not_null(env.merged.history("users"), strict)


@query("dq_unique")
def dq_unique(env: Lab) -> DataFrame:
    return quality.repeated_keys(_raw(env, "lineitem"), ("l_orderkey", "l_linenumber"))


@query("dq_foreign_key")
def dq_foreign_key(env: Lab) -> DataFrame:
    """Keys of the rebuilt fact that no dimension row has any more."""
    fact = env.merged.star("fact_sales")
    parts = [
        quality.dangling(fact, env.merged.star(fk.parent), fk).select("column", "parent", "key", "rows")
        for fk in STAR["fact_sales"].foreign_keys
    ]
    return reduce(DataFrame.unionByName, parts)


@query("dq_max_length")
def dq_max_length(env: Lab) -> DataFrame:
    return quality.max_length(_raw(env, "customer"), _STRICT_CUSTOMER)


@query("dq_non_negative")
def dq_non_negative(env: Lab) -> DataFrame:
    return quality.non_negative(_raw(env, "customer"), _STRICT_CUSTOMER)


@query("dq_enum")
def dq_enum(env: Lab) -> DataFrame:
    return quality.allowed_values(_raw(env, "orders"), _STRICT_ORDERS)


@query("dq_single_active")
def dq_single_active(env: Lab) -> DataFrame:
    return quality.several_active(env.merged.stored("user_traffic"), ("user_id", "source_id", "referred_at"))


@query("dq_source_rules")
def dq_source_rules(env: Lab) -> DataFrame:
    """Every declared rule of the operational tables."""
    tables = {t: env.first.table(t) for t in SOURCE}
    return reduce(DataFrame.unionByName, [quality.check_table(df, SOURCE[t], tables) for t, df in tables.items()])


@query("dq_declared_rules")
def dq_declared_rules(env: Lab) -> DataFrame:
    """Every declared rule of the history and star tables after the incremental load."""
    store = env.merged.finished()
    history = {t: store.history(t) for t in HISTORY}
    stars = {t: store.star(t) for t in STAR}
    # A table's counts are written before the next table begins: in one plan, all its stages and broadcasts would
    # be in the driver at once.
    parts = [stage(quality.check_table(df, HISTORY[t], history), f"rules-{t}") for t, df in history.items()]
    parts += [stage(quality.check_table(df, STAR[t], stars), f"rules-{t}") for t, df in stars.items()]
    return reduce(DataFrame.unionByName, parts)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)



"""Merges into the history, run through the load jobs."""

import random
from datetime import timedelta
from pathlib import Path

import pytest
from support import OPEN, MemorySource, at, course, enrollment, extract, manager, referral, rows, sale, user

from chronostar.operators import keys, quality, scd2
from chronostar.operators.keys import active
from chronostar.plans import jobs
from chronostar.plans.entities import COURSES, ENTITIES, USERS, Batch
from chronostar.plans.jobs import AS_LOADED, CURRENT, full_load, incremental_load, load_extract, row_counts, source_rows
from chronostar.schemas import HISTORY, STAR
from chronostar.sources import warehouse
from chronostar.sources.warehouse import Warehouse

LITERAL = {"key_mode": AS_LOADED, "unknown_members": False}
T1, T2, T3 = "2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00"


_loaded = {}


def load(store, source, csv=None, **options):
    """Full load; the same system is loaded once and branched afterwards."""
    key = repr((sorted(source.rows.items()), options))
    if csv is None and key in _loaded:
        store.commit(_loaded[key].manifest())
        return
    full_load(store, source, csv, T1, "full", **options)
    if csv is None:
        _loaded[key] = Warehouse(store.spark, store.root, as_of=1)


def test_full_load_opens_every_row(spark, store):
    load(store, MemorySource(spark))
    assert rows(store.history("users"), "user_sk", "user_id", "end_date", "source_id", "insert_id", "update_id") == [
        (1, 1, OPEN, 1, 1, None),
        (2, 2, OPEN, 1, 1, None),
    ]
    assert rows(store.history("courses"), "category", "sub_category") == [("Cat", "Sub")]
    assert store.history("sales").columns == HISTORY["sales"].names


def test_orphans_drop(spark, store):
    load(store, MemorySource(spark, enrollments=[enrollment(1, 1), enrollment(2, 99)]))
    assert rows(store.history("enrollments"), "enrollment_id") == [(1,)]
    assert rows(store.history("sales"), "sale_id") == [(1,)]


def test_unchanged_source_is_a_no_op(spark, store):
    source = MemorySource(spark)
    load(store, source)
    before = {t: rows(store.history(t)) for t in HISTORY}
    incremental_load(store, source, None, 2, T2, "again")
    assert {t: rows(store.history(t)) for t in HISTORY} == before


def files(folder):
    return sorted(str(p) for p in Path(folder).rglob("*") if p.is_file() and "manifest" not in p.parts)


def test_unchanged_source_writes_no_table_file(spark, store):
    source = MemorySource(spark)
    load(store, source)
    before = files(store.root)
    counts = incremental_load(store, source, extract(spark, []), 2, T2, "again")
    assert files(store.root) == before
    assert all(n == 0 for of_table in counts.values() for n in of_table.values())
    assert store.has_run("again")


def test_counts_are_those_of_the_merge(spark, store):
    first = MemorySource(spark, users=[user(1), user(2), user(3)])
    load(store, first)
    before = {t: store.current(t) for t in ENTITIES}
    second = first.but(
        users=[user(1, "Y"), user(2), user(4)], sales=[sale(1, cost=7), sale(2)], user_traffic=[referral(1, campaign="B"), referral(2)]
    )
    counts = incremental_load(store, second, extract(spark, [referral(2, 2)]), 2, T2, "inc")
    for table, entity in ENTITIES.items():
        source = source_rows(second, entity, {p.table: store.current(p.table) for p in entity.parents})
        classes = {r["class"]: r["rows"] for r in scd2.merge_summary(source, before[table], entity).collect()}
        own = counts[table]
        assert (own["new"], own["changed"]) == (classes.get("new", 0), classes.get("changed", 0))
        assert own["missing"] == (classes.get("missing", 0) if entity.detect_deletes else 0)
        assert own["ended"] == own["changed"] + own["missing"]
        assert own["opened"] == own["new"] + own["changed"] + (table == "user_traffic")  # the extract's row
    assert load_extract(store, extract(spark, [referral(2, 2, campaign="Z")]), 3, T3, "csv")["user_traffic"] == {"opened": 1, "ended": 1}


def grown(rnd, source, step):
    """Some rows of each table changed, added or (users) gone."""

    def some(rows, change, add):
        return [change(r) if rnd.random() < 0.1 else r for r in rows] + add

    n = 100 + 10 * step
    t = source.rows
    ids = [u[0] for u in t["users"]]
    return source.but(
        users=[u for u in some(t["users"], lambda u: (*u[:4], str(step), *u[5:]), [user(n + k) for k in range(3)]) if rnd.random() > 0.05],
        sales_managers=some(t["sales_managers"], lambda m: (*m[:3], f"m{m[0]}-{step}@example.com", m[4]), []),
        courses=some(t["courses"], lambda c: (*c[:4], c[4] + step, *c[5:]), []),
        enrollments=some(t["enrollments"], lambda e: (e[0], rnd.choice(ids), *e[2:]), [enrollment(n + k, rnd.choice(ids), rnd.randint(1, 4)) for k in range(4)]),
        sales=some(t["sales"], lambda s: (*s[:3], s[3] + timedelta(days=rnd.choice([1, 40, 400])), s[4] + 1), [sale(n + k) for k in range(4)]),
        traffic_sources=[(i, name, channel if step % 2 else f"c{step}", d) for i, name, channel, d in t["traffic_sources"]],
        user_traffic=t["user_traffic"] + [referral(rnd.choice(ids), rnd.randint(1, 2), f"2021-0{step}-0{k + 1}") for k in range(3)],
    )


@pytest.mark.parametrize("share", [0.25, 10.0])
def test_fact_by_deltas_equals_a_rebuild(spark, store, monkeypatch, share):
    """Whatever changes; also with few ended versions or folders allowed, and from an extract alone."""
    monkeypatch.setattr(jobs, "FACT_SHARE", share)
    monkeypatch.setattr(warehouse, "FOLDERS", 2)
    rnd = random.Random(7)
    ids = range(1, 31)
    source = MemorySource(
        spark,
        users=[user(i) for i in ids],
        courses=[course(i) for i in range(1, 5)],
        enrollments=[enrollment(i, rnd.choice(ids), rnd.randint(1, 4)) for i in ids],
        sales=[sale(i, day=f"2020-{rnd.randint(1, 12):02}-03") for i in ids],
        user_traffic=[referral(i) for i in ids if i % 3],
    )
    load(store, source)
    for step in (1, 2):
        source = grown(rnd, source, step)
        incremental_load(store, source, None, 1 + step, f"2024-02-0{step + 1} 00:00:00", f"inc{step}")
        if step == 2:
            load_extract(store, extract(spark, [referral(4, 2, "2022-01-01"), referral(6, 2, "2022-01-01")]), 9, T3, "csv")
        other = store.branch(f"{store.root}-{step}")
        jobs.rebuild_star(other, "other", key_mode=AS_LOADED)
        jobs.rebuild_star(other, "again", key_mode=CURRENT)
        got = rows(store.star("fact_sales"))
        assert got == rows(other.star("fact_sales")) and len(got) == store.current("sales").count()
        for table in ("dim_user", "dim_traffic_source", "dim_course"):
            assert rows(store.star(table)) == rows(other.star(table))
    assert max(len(e["current"]) for e in store.manifest()["tables"].values()) <= 3
    for table, entity in ENTITIES.items():
        assert quality.several_active(store.history(table), entity.key).count() == 0


def test_changed_row_of_a_lost_parent_stays_open(spark, store):
    source = MemorySource(spark)
    load(store, source)
    gone = source.but(users=[user(2)], enrollments=[enrollment(1, 1, status="completed"), enrollment(2, 2), enrollment(3, 1)])
    incremental_load(store, gone, None, 2, T2, "inc")
    assert rows(store.history("enrollments"), "enrollment_id", "status", "end_date") == [(1, "active", OPEN), (2, "active", OPEN)]


def test_new_changed_and_deleted_users(spark, store):
    source = MemorySource(spark, users=[user(1), user(2), user(3)])
    load(store, source)
    incremental_load(store, source.but(users=[user(1, "Y"), user(2), user(4)]), None, 2, T2, "inc")
    assert rows(store.history("users"), "user_sk", "user_id", "country", "start_date", "end_date", "update_id") == [
        (1, 1, "X", at(T1), at(T2), 2),
        (2, 2, "X", at(T1), OPEN, None),
        (3, 3, "X", at(T1), at(T2), 2),
        (4, 1, "Y", at(T2), OPEN, None),
        (5, 4, "X", at(T2), OPEN, None),
    ]


def test_only_users_are_closed_when_missing(spark, store):
    source = MemorySource(spark, sales_managers=[manager(1), manager(2)])
    load(store, source)
    incremental_load(store, source.but(sales_managers=[manager(1)]), None, 2, T2, "inc")
    assert rows(active(store.history("sales_managers")), "manager_id") == [(1,), (2,)]


def test_key_that_returns_is_new_again(spark, store):
    source = MemorySource(spark)
    load(store, source)
    incremental_load(store, source.but(users=[user(2)]), None, 2, T2, "gone")
    incremental_load(store, source, None, 3, T3, "back")
    assert rows(store.history("users").filter("user_id = 1"), "user_sk", "start_date", "end_date", "insert_id") == [
        (1, at(T1), at(T2), 1),
        (3, at(T3), OPEN, 3),
    ]


def test_null_and_empty_text(spark, store):
    """Equal in a description, different in a phone number."""
    source = MemorySource(spark, users=[user(1), user(2)], courses=[course(1), course(2, description="d")])
    load(store, source)
    second = source.but(users=[user(1, phone=""), user(2)], courses=[course(1, description=""), course(2)])
    incremental_load(store, second, None, 2, T2, "inc")
    assert rows(store.history("users"), "user_id") == [(1,), (1,), (2,)]
    assert rows(store.history("courses"), "course_id") == [(1,), (2,), (2,)]


def test_child_changes_by_parents_business_key(spark, store):
    """A new version of the user alone leaves the enrollment as it is; another user does not."""
    source = MemorySource(spark)
    load(store, source)
    incremental_load(store, source.but(users=[user(1, "Y"), user(2)]), None, 2, T2, "user")
    assert store.closed("enrollments").count() == 0
    moved = source.but(users=[user(1, "Y"), user(2)], enrollments=[enrollment(1, 2), enrollment(2, 2)])
    incremental_load(store, moved, None, 3, T3, "moved")
    assert rows(store.history("enrollments"), "enrollment_id", "user_sk", "end_date") == [
        (1, 1, at(T3)),
        (1, 2, OPEN),
        (2, 2, OPEN),
    ]


def test_two_runs_with_one_batch_id(spark, store):
    source = MemorySource(spark)
    load(store, source)
    incremental_load(store, source.but(users=[user(1, "Y"), user(2)]), None, 2, T2, "a")
    incremental_load(store, source.but(users=[user(1, "Z"), user(2)]), None, 2, T3, "b")
    assert rows(store.history("users").filter("user_id = 1"), "country", "insert_id", "update_id") == [
        ("X", 1, 2),
        ("Y", 2, 2),
        ("Z", 2, None),
    ]
    for table, entity in ENTITIES.items():
        assert quality.several_active(store.history(table), entity.key).count() == 0
    assert rows(store.star("dim_user"), "user_id", "country") == [(-1, None), (1, "Z"), (2, "X")]


def test_repeated_run_changes_nothing(spark, store):
    source = MemorySource(spark)
    load(store, source)
    changed = source.but(users=[user(1, "Y"), user(2)])
    incremental_load(store, changed, None, 2, T2, "inc")
    version = store.manifest()["version"]
    incremental_load(store, changed, None, 2, T3, "inc")
    assert store.manifest()["version"] == version


def test_failed_run_leaves_the_old_state(spark, store):
    source = MemorySource(spark)
    load(store, source)
    before = rows(store.history("users"))

    class Broken(MemorySource):
        def table(self, name):
            if name == "sales":
                raise OSError("source went away")
            return super().table(name)

    broken = Broken(spark, users=[user(1, "Y")])
    with pytest.raises(OSError):
        incremental_load(store, broken, None, 2, T2, "inc")
    assert rows(store.history("users")) == before
    incremental_load(store, source.but(users=[user(1, "Y"), user(2)]), None, 2, T2, "inc")
    assert rows(active(store.history("users")), "user_id", "country") == [(1, "Y"), (2, "X")]


def test_two_writers_cannot_publish_the_same_version(store):
    one, two = store.begin("one"), store.begin("two")
    one.commit()
    with pytest.raises(RuntimeError):
        two.commit()


def test_full_load_again_goes_on_counting_keys(spark, store):
    source = MemorySource(spark)
    load(store, source)
    full_load(store, source, None, T2, "full2")
    assert rows(store.history("users"), "user_sk", "insert_id") == [(3, 1), (4, 1)]
    assert store.closed("users").count() == 0
    store.reset_layer("warehouse")
    assert store.history("users").count() == 0 and store.star("fact_sales").count() == 0
    full_load(store, source, None, T3, "full3")
    assert rows(store.history("users"), "user_sk") == [(1,), (2,)]


def test_reset_of_the_star_empties_all_its_tables(spark, store):
    load(store, MemorySource(spark))
    store.reset_layer("star_schema")
    assert [store.star(t).count() for t in STAR] == [0] * len(STAR)
    assert store.history("users").count() == 2


def test_empty_sources(spark, store):
    empty = {t: [] for t in ("users", "sales_managers", "courses", "enrollments", "sales", "traffic_sources")}
    load(store, MemorySource(spark, **empty, user_traffic=[]), extract(spark, []), **LITERAL)
    counts = {r.table: r.rows for r in row_counts(store).collect()}
    assert counts.pop("dim_date") == 1  # no dates at all: today
    assert set(counts.values()) == {0}
    incremental_load(store, MemorySource(spark), extract(spark, []), 2, T2, "inc")
    assert store.star("dim_user").count() == 3  # with the unknown member


def test_versions_of_a_key_do_not_overlap(spark, store):
    source = MemorySource(spark)
    load(store, source)
    for n, ts in ((2, T2), (3, T3)):
        incremental_load(store, source.but(users=[user(1, f"C{n}"), user(2)]), None, n, ts, f"r{n}")
    spans = sorted((r.user_id, r.start_date, r.end_date) for r in store.history("users").collect())
    for (k1, _, end), (k2, start, _) in zip(spans, spans[1:]):
        assert k1 != k2 or end <= start


def test_merge_equals_its_single_steps(spark, store):
    first = MemorySource(spark, users=[user(1), user(2), user(3)])
    load(store, first)
    source = source_rows(first.but(users=[user(1, "Y"), user(2), user(4)]), USERS, {})
    current, batch = store.current("users"), Batch(2, T2)
    merged = scd2.merge_rows(source, current, USERS, batch)
    columns = USERS.stored_schema.names
    opened = scd2.new_rows(source, current, USERS, batch).union(scd2.changed_rows(source, current, USERS, batch))
    closed = scd2.closed_rows(source, current, USERS, batch).union(scd2.deleted_rows(source, current, USERS, batch))
    assert rows(merged.filter("row_state = 'opened'"), *columns) == rows(opened, *columns)
    assert rows(merged.filter("row_state = 'closed'"), *columns) == rows(closed, *columns)
    summary = {r["class"]: r["rows"] for r in scd2.merge_summary(source, current, USERS).collect()}
    assert summary == {"new": 1, "changed": 1, "unchanged": 1, "missing": 1}


def test_mismatched_subcategory_is_kept(spark):
    source = MemorySource(
        spark,
        courses=[course(1, category=2, subcategory=1)],
        categories=[(1, "A"), (2, "B")],
        subcategories=[(1, 1, "S")],
    )
    assert rows(source_rows(source, COURSES, {}), "category", "sub_category") == [("B", "S")]


def test_sales_of_changed_enrollments(spark, store):
    """Literal keys lose such sales in the incremental fact; current keys keep them."""
    source = MemorySource(spark)
    load(store, source)
    changed = source.but(enrollments=[enrollment(1, status="completed"), enrollment(2, 2)])
    incremental_load(store, changed, None, 2, T2, "literal", **LITERAL)
    assert rows(store.star("fact_sales"), "sale_id") == [(2,)]
    incremental_load(store, changed, None, 3, T3, "current")
    assert rows(store.star("fact_sales"), "sale_id") == [(1,), (2,)]


def test_current_keys_point_at_open_versions(spark, store):
    source = MemorySource(spark)
    load(store, source, key_mode=CURRENT, unknown_members=True)
    second = source.but(users=[user(1, "Y")], courses=[course(1, 200)], sales_managers=[manager(1, "new@example.com")])
    incremental_load(store, second, None, 2, T2, "inc", key_mode=CURRENT, unknown_members=True)
    fact = store.star("fact_sales")
    assert rows(fact, "sale_id", "user_key", "course_key", "sales_manager_key", "traffic_source_key") == [
        (1, 3, 2, 2, 1),
        (2, -1, 2, 2, -1),
    ]
    for fk in STAR["fact_sales"].foreign_keys:
        assert quality.dangling(fact, store.star(fk.parent), fk).count() == 0


def test_literal_keys_dangle_after_a_user_change(spark, store):
    source = MemorySource(spark)
    load(store, source, **LITERAL)
    incremental_load(store, source.but(users=[user(1, "Y"), user(2)]), None, 2, T2, "inc", **LITERAL)
    fk = next(f for f in STAR["fact_sales"].foreign_keys if f.column == "user_key")
    assert rows(quality.dangling(store.star("fact_sales"), store.star("dim_user"), fk), "key", "rows") == [(1, 1)]


def test_extract_alone(spark, store):
    source = MemorySource(spark, user_traffic=[])
    load(store, source)
    load_extract(store, extract(spark, [referral(2, 2, campaign="Z")]), 2, T2, "csv")
    assert rows(store.history("user_traffic"), "user_sk", "traffic_source_sk", "source_id_audit") == [(2, 2, 2)]
    assert rows(store.star("fact_sales"), "sale_id", "traffic_source_key") == [(1, -1), (2, 2)]


def test_operational_and_extract_rows_share_the_history(spark, store):
    source = MemorySource(spark, user_traffic=[referral(1)])
    load(store, source, extract(spark, [referral(1, campaign="B"), referral(1, campaign="B")]))
    assert rows(store.history("user_traffic"), "user_traffic_sk", "campaign_code", "source_id_audit") == [
        (1, "A", 1),
        (2, "B", 2),
        (3, "B", 2),
    ]


def test_pinned_warehouse_reads_an_old_state(spark, store):
    source = MemorySource(spark)
    load(store, source)
    version = store.manifest()["version"]
    incremental_load(store, source.but(users=[user(1, "Y"), user(2)]), None, 2, T2, "inc")
    assert Warehouse(spark, store.root, as_of=version).history("users").count() == 2
    assert store.history("users").count() == 3


def test_sale_date_and_cost_changes(spark, store):
    source = MemorySource(spark)
    load(store, source)
    incremental_load(store, source.but(sales=[sale(1, cost=200), sale(2)]), None, 2, T2, "inc")
    assert rows(store.star("fact_sales"), "sale_key", "sale_id", "total_in_rubbles") == [(2, 2, 100), (3, 1, 200)]


def test_repeated_source_key_fails_both_loads(spark, store):
    source = MemorySource(spark)
    twice = source.but(users=[user(1), user(1, "Y"), user(2)])
    with pytest.raises(ValueError, match="repeated source keys in users"):
        full_load(store, twice, None, T1, "twice")
    load(store, source)
    with pytest.raises(Exception, match="repeated source key user_id"):
        incremental_load(store, twice, None, 2, T2, "inc")
    traffic = source.but(user_traffic=[referral(1), referral(1, campaign="B")])
    with pytest.raises(ValueError, match="repeated source keys in user_traffic"):
        full_load(store, traffic, None, T1, "traffic")
    with pytest.raises(ValueError, match="repeated source keys in user_traffic"):
        full_load(store, traffic, extract(spark, [referral(1, campaign="C")]), T1, "traffic-extract")
    with pytest.raises(ValueError, match="repeated source keys in user_traffic"):
        incremental_load(store, traffic, None, 2, T2, "inc")
    assert store.history("users").count() == 2


def test_a_full_load_writes_each_row_twice(spark, store, monkeypatch):
    # Into its place of the order, and with its number.
    staged = []
    written = keys.stage
    monkeypatch.setattr(keys, "stage", lambda df, label, path: staged.append(label) or written(df, label, path))
    monkeypatch.setattr(jobs, "stage", lambda df, label, path: staged.append(label) or written(df, label, path))
    full_load(store, MemorySource(spark), None, T1, "full")
    assert sorted(staged) == sorted(["latest", *(f"{e.sk}-keys" for e in ENTITIES.values())])

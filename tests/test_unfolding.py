"""Loads taken step by step, as far as a reader asks for."""

import pytest
from support import MemorySource, extract, referral, rows, sale, user

from chronostar.catalog.lab import INC_ID, INC_TS, FULL_TS, LITERAL, Unfolding
from chronostar.plans.jobs import full_load, full_steps, incremental_load, incremental_steps, rebuild_steps
from chronostar.schemas import HISTORY, STAR
from chronostar.sources.warehouse import Warehouse


def states(spark, root, source, later, csv, more):
    first = Unfolding(full_steps(Warehouse(spark, root).begin("full", truncate=True), source, csv, FULL_TS, **LITERAL))
    run = Warehouse(spark, root).begin("incremental")
    return first, Unfolding(incremental_steps(run, later, more, INC_ID, INC_TS, **LITERAL, before=first.load), first)


@pytest.fixture
def sources(spark):
    source = MemorySource(spark)
    later = source.but(users=[user(1, country="Y"), user(3)], sales=[sale(1, cost=7), sale(2)])
    return source, later, extract(spark, [referral(2, 1)]), extract(spark, [referral(1, 2), referral(2, 1, campaign="B")])


def test_a_table_takes_its_own_steps_and_no_others(spark, tmp_path, sources):
    loaded, merged = states(spark, str(tmp_path / "w"), *sources)
    assert rows(merged.history("users"), "user_id", "country") == [(1, "X"), (1, "Y"), (2, "X"), (3, "X")]
    assert rows(loaded.star("dim_user"), "user_id") == [(1,), (2,)]
    assert set(loaded.load.run.manifest["tables"]) == set(merged.load.run.manifest["tables"]) == {"users"}
    assert merged.history("enrollments").count() == 2
    assert set(merged.load.run.manifest["tables"]) == {"users", "courses", "enrollments"}


def test_steps_end_at_what_the_jobs_write(spark, store, tmp_path, sources):
    source, later, csv, more = sources
    full_load(store, source, csv, FULL_TS, "full", **LITERAL)
    whole = [Warehouse(spark, store.root, as_of=1)]
    incremental_load(store, later, more, INC_ID, INC_TS, "incremental", **LITERAL)
    whole.append(Warehouse(spark, store.root, as_of=2))
    for state, want in zip(states(spark, str(tmp_path / "w"), *sources), whole):
        for name in ("fact_sales", "dim_user"):
            assert rows(state.star(name)) == rows(want.star(name))
        done = state.finished()
        assert done.manifest()["runs"] == want.manifest()["runs"]
        for table in HISTORY:
            assert rows(done.history(table)) == rows(want.history(table)) == rows(state.history(table))
        for name in STAR:
            assert rows(done.star(name)) == rows(want.star(name))


def test_a_star_made_anew_asks_for_no_earlier_fact(spark, tmp_path, sources):
    loaded, merged = states(spark, str(tmp_path / "w"), *sources)
    complete = Unfolding(rebuild_steps(Warehouse(spark, str(tmp_path / "c")).begin("complete"), before=merged.load))
    assert complete.star("fact_sales").count() == 2
    assert "fact_sales" not in loaded.load.run.manifest["star"] and "fact_sales" not in merged.load.run.manifest["star"]


def test_a_failed_step_can_be_taken_again(spark, tmp_path):
    source = MemorySource(spark, users=[user(1), user(1)])
    load = full_steps(Warehouse(spark, str(tmp_path / "w")).begin("full", truncate=True), source, None, FULL_TS)
    for _ in range(2):
        with pytest.raises(ValueError, match="repeated source keys in users"):
            load.need("users")
    source.rows["users"] = [user(1)]
    load.need("users")
    assert Unfolding(load).history("users").count() == 1

"""The two loads: everything from scratch, or one batch of changes."""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronostar.operators.keys import resolve_parents
from chronostar.operators.quality import repeated_keys
from chronostar.operators.scd2 import TIE, acting_pairs, denormalise_courses, fates, initial_rows, with_parents
from chronostar.operators.star import (
    CALENDAR_COLUMNS,
    DIMENSIONS,
    calendar,
    date_bounds,
    dimension,
    extend_calendar,
    fact_as_loaded,
    fact_current,
    latest_traffic,
    overall_bounds,
    with_unknown_member,
)
from chronostar.operators.traffic import KEY, PASS, SEQ, merge_extract
from chronostar.plans.entities import ENTITIES, PARENTS, USER_TRAFFIC, Batch, Entity
from chronostar.schemas import CSV_AUDIT, HISTORY, MONTH, STAR
from chronostar.session import stage
from chronostar.sources.warehouse import Run, Warehouse

AS_LOADED, CURRENT = "as_loaded", "current"
FULL_BATCH_ID = 1


#: Share of the sales beyond which a run builds the whole fact instead of the touched months.
FACT_SHARE = 0.25

Counts = dict[str, dict[str, int]]


def business_rows(source, entity: Entity) -> DataFrame:
    """An entity's source rows by business keys, names denormalised."""
    rows = source.table(entity.name)
    if entity.name == "courses":
        rows = denormalise_courses(rows, source.table("categories"), source.table("subcategories"))
    return rows


def source_rows(source, entity: Entity, parents: dict[str, DataFrame]) -> DataFrame:
    """An entity's source rows in history shape: names denormalised, parent keys attached."""
    return resolve_parents(business_rows(source, entity), entity, parents)


def _together(step: Callable[[str], None], tables: Iterable[str], after: dict[str, list[str]] | None = None) -> None:
    """Run table loads at the same time, each once the tables it builds on are done.

    Small tables fill the gaps of big ones. Tables are listed after the ones they
    build on, so one thread per table cannot wait in a circle.
    """
    tables, done = list(tables), {}
    with ThreadPoolExecutor(len(tables)) as pool:

        def when_ready(table: str) -> None:
            for other in (after or {}).get(table, []):
                done[other].result()
            step(table)

        for table in tables:
            done[table] = pool.submit(when_ready, table)
    for finished in done.values():
        finished.result()


class Load:
    """The steps of a run, by the table that each brings up to date.

    ``after`` names for each step the tables that it reads as this run leaves them; a step comes after those. A
    table without a step stays as it was before. Jobs take all steps at once (``need()``); a caller that reads
    some tables only names them, and every step that these build on is taken, once.

    ``before`` is the load whose result this one starts from, where that is not taken whole either: its
    tables are asked for as steps come to them, but for those that ``anew`` names, which are written without a look
    at what was there.
    """

    def __init__(
        self,
        run: Run,
        steps: dict[str, Callable[[], None]],
        after: dict[str, list[str]],
        before: Load | None = None,
        anew: Callable[[], set[str]] = set,
    ):
        self.run, self.before = run, before
        self._steps, self._after, self._anew = steps, after, anew
        self._done: set[str] = set()
        if before:
            run.before["star"]["made"] = before.run.manifest["star"]["made"]

    def need(self, *tables: str) -> None:
        """Take the steps of these tables (of all, if none is named) that have not been taken."""
        wanted = self._closed(tables or (*HISTORY, *STAR))
        if self.before and (old := wanted - self._anew()):
            self.before.need(*old)
            for table in old:
                self._take_over(table)
        pending = [t for t in self._steps if t in wanted]
        if pending:
            _together(self._step, pending, {t: [o for o in self._after[t] if o in pending] for t in pending})
        self._done |= wanted

    def _closed(self, tables: Iterable[str]) -> set[str]:
        """These tables and all that they build on, without those done."""
        found, look = set(), list(tables)
        while look:
            table = look.pop()
            if table not in found and table not in self._done:
                found.add(table)
                look += self._after.get(table, [])
        return found

    def _take_over(self, table: str) -> None:
        layer = "tables" if table in HISTORY else "star"
        if table in self.before.run.manifest[layer]:
            for manifest in (self.run.manifest, self.run.before):
                manifest[layer][table] = copy.deepcopy(self.before.run.manifest[layer][table])

    def _step(self, table: str) -> None:
        try:
            self._steps[table]()
        except BaseException:
            self.run.move()  # what is tried again never meets the files of this attempt
            raise
        self._done.add(table)


def _parents(run: Run, entity: Entity) -> dict[str, DataFrame]:
    return {p.table: run.current(p.table) for p in entity.parents}


def _require_unique(rows: DataFrame, entity: Entity) -> None:
    """Fail on a source key that comes twice, as the declared constraint would."""
    repeated = repeated_keys(rows, entity.key).limit(3).collect()
    if repeated:
        raise ValueError(f"repeated source keys in {entity.name}: {repeated}")


def full_load(
    store: Warehouse,
    source,
    extract: DataFrame | None,
    batch_ts: str,
    run_id: str,
    batch_id: int = FULL_BATCH_ID,
    key_mode: str = CURRENT,
    unknown_members: bool = True,
) -> Counts:
    """Replace the warehouse and the star by the state of the sources; returns the rows opened by table.

    Rows get their surrogate keys in the order of their source keys, and there a key that comes twice is found;
    records of the extract may repeat one another, as they count in the order they came.
    """
    if store.has_run(run_id):
        return {}
    load = full_steps(store.begin(run_id, truncate=True), source, extract, batch_ts, batch_id, key_mode, unknown_members)
    load.need()
    load.run.commit()
    return load.run.counts


def full_steps(
    run: Run,
    source,
    extract: DataFrame | None,
    batch_ts: str,
    batch_id: int = FULL_BATCH_ID,
    key_mode: str = CURRENT,
    unknown_members: bool = True,
) -> Load:
    """The full load's steps."""
    batch = Batch(batch_id, batch_ts)

    def load(table: str) -> None:
        entity = ENTITIES[table]
        rows = initial_rows(source_rows(source, entity, _parents(run, entity)), entity, batch)
        order = entity.order
        if entity is USER_TRAFFIC and extract is not None:
            keyed = resolve_parents(extract, entity, _parents(run, entity), SEQ)
            delivered = initial_rows(keyed, entity, Batch(batch_id, batch_ts, CSV_AUDIT), SEQ)
            rows = rows.unionByName(delivered, allowMissingColumns=True)
            order = (entity.audit, *KEY, SEQ)
        run.load(table, rows, order)

    def days() -> DataFrame:
        return calendar(overall_bounds(date_bounds({t: run.current(t) for t in ENTITIES})))

    star, after, _ = _star_steps(run, days, list(CALENDAR_COLUMNS), key_mode, unknown_members, False)
    return Load(run, {t: partial(load, t) for t in ENTITIES} | star, PARENTS | after)


def incremental_load(
    store: Warehouse,
    source,
    extract: DataFrame | None,
    batch_id: int,
    batch_ts: str,
    run_id: str,
    key_mode: str = CURRENT,
    unknown_members: bool = True,
) -> Counts:
    """Merge one batch into the history and bring the star up to date.

    ``run_id`` names the run, ``batch_id`` the day; repeating a committed run
    changes nothing. Returns by table how many versions were opened and ended, and how many source
    rows were new, changed or (where deletes count) missing; the extract's are not told apart.

    Source rows are compared with the open versions by the business keys that these carry; parents are looked up
    for new and changed rows alone. Only referrals, whose key is made of their parents' surrogate keys, need
    them before.
    """
    if store.has_run(run_id):
        return {}
    load = incremental_steps(store.begin(run_id), source, extract, batch_id, batch_ts, key_mode, unknown_members)
    load.need()
    load.run.commit()
    return load.run.counts


def incremental_steps(
    run: Run,
    source,
    extract: DataFrame | None,
    batch_id: int,
    batch_ts: str,
    key_mode: str = CURRENT,
    unknown_members: bool = True,
    before: Load | None = None,
) -> Load:
    """The incremental load's steps."""
    batch = Batch(batch_id, batch_ts)

    def merge(table: str) -> None:
        entity = ENTITIES[table]
        with run.scratch(f"{table}-source") as scratch:
            if entity.unique_active:  # the merge itself checks that keys come once
                pairs = acting_pairs(business_rows(source, entity), run.current(table), entity)
                if entity.parents:
                    pairs = with_parents(stage(pairs, table, scratch), entity, _parents(run, entity))
                run.land(table, fates(pairs, entity, batch, "class"), entity.order)
            else:
                fresh = stage(source_rows(source, entity, _parents(run, entity)), table, scratch)
                _require_unique(fresh, entity)
                pairs = acting_pairs(fresh, run.current(table), entity)
                run.land(table, fates(pairs, entity, batch, "class"), (*entity.order, TIE))
        if entity is USER_TRAFFIC and extract is not None:
            land_extract(run, extract, Batch(batch_id, batch_ts, CSV_AUDIT))

    def days() -> DataFrame | None:
        return extend_calendar(run.star("dim_date"), run.current("sales"), batch_id) if run.touched("sales") else None

    star, after, anew = _star_steps(run, days, ["sales"], key_mode, unknown_members, True)
    return Load(run, {t: partial(merge, t) for t in ENTITIES} | star, PARENTS | after, before, anew)


def rebuild_star(
    store: Warehouse, run_id: str, key_mode: str = CURRENT, unknown_members: bool = True
) -> None:
    """Derive dimensions and fact anew from the stored history; the calendar stays as it is."""
    if store.has_run(run_id):
        return
    load = rebuild_steps(store.begin(run_id), key_mode, unknown_members)
    load.need()
    load.run.commit()


def rebuild_steps(run: Run, key_mode: str = CURRENT, unknown_members: bool = True, before: Load | None = None) -> Load:
    """The steps that derive the star anew."""
    steps, after, anew = _star_steps(run, lambda: None, [], key_mode, unknown_members, True)
    return Load(run, steps, after, before, anew)


def load_extract(
    store: Warehouse,
    extract: DataFrame,
    batch_id: int,
    batch_ts: str,
    run_id: str,
    key_mode: str = CURRENT,
) -> Counts:
    """Fold one extract into the referrals and bring the fact up to date; dimensions and calendar stay as they are."""
    if store.has_run(run_id):
        return {}
    run = store.begin(run_id)
    land_extract(run, extract, Batch(batch_id, batch_ts, CSV_AUDIT))
    _bring_fact(run, key_mode, True)
    run.commit()
    return run.counts


def land_extract(run: Run, extract: DataFrame, batch: Batch) -> None:
    with run.scratch("extract") as scratch:
        rows = merge_extract(
            extract,
            run.current("user_traffic"),
            run.current("users"),
            run.current("traffic_sources"),
            batch,
            scratch,
        )
        run.land("user_traffic", rows, (PASS, *KEY, SEQ), label="extract")


def _star_steps(
    run: Run,
    days: Callable[[], DataFrame | None],
    dated: list[str],
    key_mode: str,
    unknown_members: bool,
    active_enrollments_only: bool,
) -> tuple[dict[str, Callable[[], None]], dict[str, list[str]], Callable[[], set[str]]]:
    """The steps that bring dimensions, calendar and fact up to date, what they come after, and which write anew.

    Dropping a batch's touched keys, adding its open versions and filling in
    missing members always ends at one row per open version, so a dimension whose table has changed
    is projected from the open versions; no join, and no read of closed history. What the run leaves
    as it was is not written. ``days`` gives the calendar, None if it stays; ``dated`` are the tables it is made of.
    """
    made = {"key_mode": key_mode, "unknown_members": unknown_members}

    def alike() -> bool:
        return run.before["star"].get("made") == made

    run.manifest["star"]["made"] = made

    def write_days() -> None:
        found = days()
        if found is not None and (not alike() or _span(found) != _span(run.star("dim_date"))):
            run.write_star("dim_date", found)

    def write(name: str) -> None:
        if not alike() or run.touched(DIMENSIONS[name][0]) or name not in run.manifest["star"]:
            dim = dimension(name, run.current(DIMENSIONS[name][0]))
            run.write_star(name, with_unknown_member(name, dim) if unknown_members else dim)

    steps = {
        "dim_date": write_days,
        "fact_sales": lambda: _bring_fact(run, key_mode, active_enrollments_only, whole=not alike()),
        **{name: partial(write, name) for name in DIMENSIONS},
    }
    read = list(ENTITIES) if key_mode == CURRENT else ["sales", "enrollments", "user_traffic"]
    after = {"dim_date": dated, "fact_sales": ["dim_date", *read], **{n: [t] for n, (t, _) in DIMENSIONS.items()}}

    def anew() -> set[str]:
        return set() if alike() and key_mode == CURRENT else {"fact_sales"} if alike() else {"fact_sales", *DIMENSIONS}

    return steps, after, anew


def _span(days: DataFrame) -> tuple:
    """First and last day of a calendar."""
    return tuple(days.agg(F.min("date"), F.max("date")).first())


def _bring_fact(run: Run, key_mode: str, active_enrollments_only: bool, whole: bool = False) -> None:
    """Write the fact rows of the sales that the run has touched, or all of them.

    The whole fact is written where none is stored, where it was made in another way or with the keys rows
    were loaded with, and where a large share of the sales is touched.
    """
    if whole or key_mode != CURRENT or not run.manifest["star"].get("fact_sales"):
        _write_fact(run, key_mode, active_enrollments_only)
        return
    if not any(run.touched(t) for t in ENTITIES) and run.manifest["star"].get("dim_date") == run.before["star"].get("dim_date"):
        return
    with run.scratch("touched") as scratch:
        touched = stage(touched_sales(run), "touched", scratch)
        number = touched.count()
        if not number:
            return
        if number > FACT_SHARE * run.manifest["tables"]["sales"]["opened_rows"]:
            _write_fact(run, key_mode, active_enrollments_only)
        else:
            _replace_facts(run, touched)


def touched_sales(run: Run) -> DataFrame:
    """sale_id of every sale whose fact row a run may change, found from the versions it opened or ended.

    Those are sales of touched enrollments, managers and, by their enrollments, of touched courses and users; a user is
    touched by a referral too, or by a source that has referred the user. If the calendar
    has grown, the sales outside the former one count as well.
    """
    users = run.delta("users").select("user_id").union(run.delta("user_traffic").select("user_id"))
    if run.touched("traffic_sources"):
        sources = run.delta("traffic_sources").select("source_id").distinct()
        users = users.union(run.current("user_traffic").join(sources, "source_id", "left_semi").select("user_id"))
    enrollments, sales = run.current("enrollments"), run.current("sales")
    courses = run.delta("courses").select("course_id").distinct()
    by_enrollment = reduce(
        DataFrame.union,
        [
            run.delta("enrollments").select("enrollment_id"),
            enrollments.join(users.distinct(), "user_id", "left_semi").select("enrollment_id"),
            enrollments.join(courses, "course_id", "left_semi").select("enrollment_id"),
        ],
    ).distinct()
    managers = run.delta("sales_managers").select("manager_id").distinct()
    found = [
        run.delta("sales").select("sale_id"),
        sales.join(by_enrollment, "enrollment_id", "left_semi").select("sale_id"),
        sales.join(managers, "manager_id", "left_semi").select("sale_id"),
    ]
    if run.manifest["star"].get("dim_date") != run.before["star"].get("dim_date"):
        first, last = _span(run.store.star("dim_date", run.before))
        day = F.col("sale_date").cast("date")
        outside = F.lit(True) if first is None else (day < F.lit(first)) | (day > F.lit(last))
        found.append(sales.filter(outside).select("sale_id"))
    return reduce(DataFrame.union, found).distinct()


def _replace_facts(run: Run, touched: DataFrame) -> None:
    """Build the fact rows of some sales (written) anew and write the months that had or have such rows."""
    with run.scratch("facts") as scratch:
        tables = {t: run.current(t) for t in ENTITIES}
        tables["sales"] = tables["sales"].join(touched, "sale_id", "left_semi")
        # Written in between, so that the few rows decide how the next table is joined.
        tables["sales"] = stage(tables["sales"], "sales", f"{scratch}/sales")
        wanted = tables["sales"].select("enrollment_id").distinct()
        tables["enrollments"] = stage(
            tables["enrollments"].join(wanted, "enrollment_id", "left_semi"), "enrollments", f"{scratch}/enrollments"
        )
        of_users = tables["enrollments"].select("user_id").distinct()
        referrals = tables["user_traffic"].join(of_users, "user_id", "left_semi")
        latest = stage(latest_traffic(referrals, "user_id", "source_id"), "latest", f"{scratch}/latest")
        fresh = stage(fact_current(tables, latest, run.star("dim_date")), "fresh", f"{scratch}/fresh")
        stored = run.star("fact_sales", by_month=True)
        month = F.call_function("div", F.col("date_key"), F.lit(100)).cast("int").alias(MONTH)
        had = stored.join(touched, "sale_id", "left_semi").select(MONTH)
        # At most as many numbers as the calendar has months.
        months = sorted(r[0] for r in had.union(fresh.select(month)).distinct().collect())
        stays = stored.filter(F.col(MONTH).isin(months)).join(touched, "sale_id", "left_anti").drop(MONTH)
        run.write_fact(stays.unionByName(fresh), months)


def _write_fact(run: Run, key_mode: str, active_enrollments_only: bool) -> None:
    days, referrals = run.star("dim_date"), run.current("user_traffic")
    with run.scratch("latest") as scratch:
        if key_mode == CURRENT:
            latest = stage(latest_traffic(referrals, "user_id", "source_id"), "latest", scratch)
            fact = fact_current({t: run.current(t) for t in ENTITIES}, latest, days)
        else:
            # An open sale may refer to an enrollment version that ended: the full
            # build keeps such sales, and right after a full load nothing has ended.
            latest = stage(latest_traffic(referrals, "user_sk", "traffic_source_sk"), "latest", scratch)
            fact = fact_as_loaded(
                run.current("sales"), run.current("enrollments"), latest, days, active_enrollments_only
            )
        run.write_fact(fact)


def row_counts(store: Warehouse) -> DataFrame:
    """Rows of every warehouse and star table."""
    parts = [("warehouse", t, store.history(t)) for t in HISTORY] + [("star_schema", t, store.star(t)) for t in STAR]
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows")
        for layer, name, df in parts
    ]
    return reduce(DataFrame.unionByName, counts)

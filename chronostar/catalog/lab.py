"""A warehouse loaded from the test tables: the full load, then one incremental run.

Built once per session and data folder under the shared staging folder, by the
steps of the jobs a deployment runs. A query that reads some tables takes the steps of those and of what
they build on; one that asks for the whole state (``finished``) takes all.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from chronostar.operators.keys import active, assign_keys
from chronostar.operators.scd2 import CLOSED, KEPT, OPENED, STATE, TIE, merge_rows
from chronostar.operators.traffic import KEY, PASS, SEQ, merge_extract
from chronostar.plans.entities import USER_TRAFFIC, Batch, Entity
from chronostar.plans.jobs import AS_LOADED, Load, full_steps, incremental_steps, rebuild_steps, source_rows
from chronostar.schemas import CSV_AUDIT
from chronostar.session import stage, staging_root, tune
from chronostar.sources.fixtures import FixtureSource
from chronostar.sources.warehouse import Warehouse

FULL_TS, INC_TS = "2024-02-01 00:00:00", "2024-02-02 00:00:00"
FULL_ID, INC_ID = 1, 20240202
#: The mode that keeps the keys rows were loaded with, for the queries that show it.
LITERAL = {"key_mode": AS_LOADED, "unknown_members": False}


class Unfolding(Warehouse):
    """The state that a load leads to: a table's steps are taken when it is first read."""

    def __init__(self, load: Load, after: Unfolding | None = None) -> None:
        super().__init__(load.run.store.spark, load.run.store.root)
        self.load = load
        self._after = after  # the state before, if it is published in the same folder
        self._finished: Warehouse | None = None

    def _made(self, table: str) -> dict:
        self.load.need(table)
        return self.load.run.manifest

    def current(self, table: str, manifest: dict | None = None) -> DataFrame:
        return super().current(table, manifest or self._made(table))

    def closed(self, table: str, manifest: dict | None = None) -> DataFrame:
        return super().closed(table, manifest or self._made(table))

    def stored(self, table: str) -> DataFrame:
        manifest = self._made(table)
        return self.current(table, manifest).unionByName(self.closed(table, manifest))

    def last_key(self, table: str, manifest: dict | None = None) -> int:
        return super().last_key(table, manifest or self._made(table))

    def star(self, table: str, manifest: dict | None = None, by_month: bool = False) -> DataFrame:
        return super().star(table, manifest or self._made(table), by_month)

    def manifest(self) -> dict:
        return self.finished().manifest()

    def finished(self) -> Warehouse:
        """The state after the whole load, all steps taken and published."""
        if not self._finished:
            run = self.load.run
            if self._after:
                published = self._after.manifest()
                run.manifest |= {"version": published["version"], "runs": published["runs"]}
            self.load.need()
            run.commit()
            self._finished = Warehouse(self.spark, self.root, as_of=run.manifest["version"])
        return self._finished


class Lab:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = tune(spark)
        self.first = FixtureSource(spark, sf_dir, 1)
        self.second = FixtureSource(spark, sf_dir, 2)
        self.full_batch = Batch(FULL_ID, FULL_TS)
        self.batch = Batch(INC_ID, INC_TS)
        self.csv_batch = Batch(INC_ID, INC_TS, CSV_AUDIT)
        self._root = f"{staging_root(spark)}/lab-{uuid.uuid4().hex[:12]}"

    @cached_property
    def loaded(self) -> Unfolding:
        """State after the full load."""
        run = Warehouse(self.spark, self._root).begin("full", truncate=True)
        return Unfolding(full_steps(run, self.first, self.first.extract(), FULL_TS, **LITERAL))

    @cached_property
    def merged(self) -> Unfolding:
        """State after the incremental run."""
        run = Warehouse(self.spark, self._root).begin("incremental")
        extract = self.second.extract()
        load = incremental_steps(run, self.second, extract, INC_ID, INC_TS, **LITERAL, before=self.loaded.load)
        return Unfolding(load, self.loaded)

    @cached_property
    def complete(self) -> Unfolding:
        """The merged state with the star as loads make it by default: current keys, unknown members."""
        run = Warehouse(self.spark, f"{self._root}-complete").begin("complete")
        return Unfolding(rebuild_steps(run, before=self.merged.load))

    # --- inputs of the second snapshot's merge --------------------------------

    def first_rows(self, entity: Entity) -> DataFrame:
        return source_rows(self.first, entity, {p.table: self.loaded.current(p.table) for p in entity.parents})

    def second_rows(self, entity: Entity) -> DataFrame:
        """Source rows of the second snapshot with their parents' keys after the merge."""
        return source_rows(self.second, entity, {p.table: self.merged.current(p.table) for p in entity.parents})

    def merge(self, entity: Entity) -> DataFrame:
        """Whole history after merging the second snapshot: what the run stored; of the referrals before the extract's."""
        return self.merged.stored(entity.name) if entity.unique_active else self.referrals[0]

    def _numbered(self, entity: Entity, rows: DataFrame, order, start: int) -> tuple[DataFrame, int]:
        columns = entity.stored_schema.names
        rows = stage(rows, f"{entity.name}-merge")
        opened, last = assign_keys(rows.filter(f"{STATE} = '{OPENED}'"), entity.sk, order, start)
        rest = rows.filter(f"{STATE} IN ('{KEPT}', '{CLOSED}')")
        return rest.select(*columns).unionByName(opened.select(*columns)), last

    @cached_property
    def referrals(self) -> tuple[DataFrame, int]:
        """All referrals after the operational pass and before the extract's, and the last key given."""
        entity = USER_TRAFFIC
        rows = merge_rows(self.second_rows(entity), self.loaded.current(entity.name), entity, self.batch)
        history, last = self._numbered(entity, rows, (*entity.order, TIE), self.loaded.last_key(entity.name))
        return stage(history, "referrals"), last

    def extract_rows(self) -> DataFrame:
        return merge_extract(
            self.second.extract(),
            active(self.referrals[0]),
            self.merged.current("users"),
            self.merged.current("traffic_sources"),
            self.csv_batch,
        )

    def merge_extract(self) -> DataFrame:
        history, last = self.referrals
        merged, _ = self._numbered(USER_TRAFFIC, self.extract_rows(), (PASS, *KEY, SEQ), last)
        return merged.unionByName(history.filter("end_date < TIMESTAMP_NTZ '9999-12-31 00:00:00'"))


_labs: dict[tuple[str, str], Lab] = {}


def lab(spark: SparkSession, sf_dir: str) -> Lab:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _labs:
        _labs[key] = Lab(spark, sf_dir)
    return _labs[key]

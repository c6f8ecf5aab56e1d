"""The stored warehouse: immutable run folders and a manifest that names the live ones.

A run writes new folders only and becomes visible by one manifest entry, so a
failed run leaves the previous state readable and can simply be repeated.

History only grows: a run adds the versions it opened and the versions it ended. The open
versions are the opened ones without the ended ones, a join with a side of a checked size; once
too many have ended since, the run that finds it writes the open versions anew.
So a run writes as much as has changed, and nothing where nothing has.
"""

from __future__ import annotations

import copy
import json
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronostar.functions.predicates import is_active
from chronostar.operators.keys import TiedRows, assign_keys
from chronostar.operators.scd2 import CLASSES, CLOSED, KEPT, OPENED, STATE
from chronostar.plans.entities import ENTITIES
from chronostar.schemas import HISTORY, MONTH, STAR
from chronostar.session import COMPACT

_EMPTY = {"version": 0, "runs": [], "tables": {}, "star": {}}
_NEW_TABLE = {"current": [], "ended": [], "closed": [], "last_key": 0, "opened_rows": 0, "ended_rows": 0}

#: Ended versions up to which their keys are sent to all tasks (some 70 bytes each in the driver, for every read of the
#: table); with more, open versions are written anew.
ENDED_ROWS = 200_000
#: The same if they are more than this share of the versions opened, or in more than so many folders.
ENDED_SHARE = 0.25
FOLDERS = 48


@dataclass
class Warehouse:
    """``as_of`` pins the readers to one manifest version; by default they see the latest."""

    spark: SparkSession
    root: str
    as_of: int | None = None

    # --- manifest -------------------------------------------------------------

    def _files(self, name: str = ""):
        """Hadoop file system and path of a manifest file (or of their folder)."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _versions(self) -> list[int]:
        """Published manifest versions (a listing of names, no data)."""
        fs, folder = self._files()
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return [int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")]

    def manifest(self) -> dict:
        version = self.as_of or max(self._versions(), default=0)
        if not version:
            return json.loads(json.dumps(_EMPTY))
        fs, path = self._files(f"v{version:08d}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, manifest: dict) -> None:
        """Publish the next state; fails if another run published that version first."""
        manifest["version"] += 1
        fs, path = self._files(f"v{manifest['version']:08d}.json")
        taken = f"manifest version {manifest['version']} exists: another run was faster, start again"
        try:
            stream = fs.create(path, False)  # creates or fails in one step, also on object stores
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                raise RuntimeError(taken) from error
            raise
        stream.write(bytearray(json.dumps(manifest), "utf-8"))
        stream.close()

    def exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def remove(self, path: str) -> None:
        """Delete a folder this run wrote."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def partitions(self, path: str, column: str) -> list[str]:
        """Values of a written table's partition folders (a listing of names, no data)."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        names = [s.getPath().getName() for s in folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(folder)]
        return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))

    def branch(self, root: str) -> Warehouse:
        """A warehouse of its own that starts from this one's state and shares its immutable files."""
        other = Warehouse(self.spark, root)
        other.commit(self.manifest())
        return other

    def has_run(self, run_id: str) -> bool:
        return run_id in self.manifest()["runs"]

    # --- tables ---------------------------------------------------------------

    def _read(self, table: str, folders: list[str]) -> DataFrame:
        schema = ENTITIES[table].stored_schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def _entry(self, table: str, manifest: dict | None) -> dict:
        return (manifest or self.manifest())["tables"].get(table, _NEW_TABLE)

    def current(self, table: str, manifest: dict | None = None) -> DataFrame:
        """Open versions, with the parents' business keys."""
        entry, sk = self._entry(table, manifest), ENTITIES[table].sk
        opened = self._read(table, entry["current"])
        if not entry["ended"]:
            return opened
        ended = self._read(table, entry["ended"]).select(sk)  # at most ENDED_ROWS, see Run.compact
        return opened.join(F.broadcast(ended) if entry["ended_rows"] <= ENDED_ROWS else ended, sk, "left_anti")

    def closed(self, table: str, manifest: dict | None = None) -> DataFrame:
        """Ended versions of all runs since the last full load."""
        return self._read(table, self._entry(table, manifest)["closed"])

    def stored(self, table: str) -> DataFrame:
        manifest = self.manifest()
        return self.current(table, manifest).unionByName(self.closed(table, manifest))

    def history(self, table: str) -> DataFrame:
        """All versions in the declared columns."""
        return self.stored(table).select(*HISTORY[table].names)

    def last_key(self, table: str, manifest: dict | None = None) -> int:
        return self._entry(table, manifest)["last_key"]

    def star(self, table: str, manifest: dict | None = None, by_month: bool = False) -> DataFrame:
        """A star table. ``by_month``: the fact with the column its files are partitioned by."""
        stored = (manifest or self.manifest())["star"].get(table)
        schema = STAR[table].schema
        if table != "fact_sales":
            return self.spark.read.schema(schema).parquet(stored) if stored else self.spark.createDataFrame([], schema)
        schema = T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())])
        months = (stored or {}).items()
        if not months:
            fact = self.spark.createDataFrame([], schema)
        else:
            fact = self._months(schema, months)
        return fact if by_month else fact.drop(MONTH)

    def _months(self, schema: T.StructType, months) -> DataFrame:
        """The fact's months, each from the run that last wrote it."""
        runs: dict[str, list[int]] = {}
        for month, base in months:
            runs.setdefault(base, []).append(int(month))
        parts = [self.spark.read.schema(schema).parquet(b).filter(F.col(MONTH).isin(m)) for b, m in runs.items()]
        return reduce(DataFrame.unionByName, parts)

    def table(self, layer: str, name: str) -> DataFrame:
        return self.history(name) if layer == "warehouse" else self.star(name)

    def sample(self, layer: str, name: str, limit: int = 5) -> DataFrame:
        """Some rows of a table."""
        return self.table(layer, name).limit(limit)

    # --- layer operations -----------------------------------------------------

    def reset_layer(self, layer: str, restart_keys: bool = True) -> None:
        """Empty every table of a layer; surrogate keys start again unless told otherwise.

        The star builds on the history, so emptying the history empties both.
        """
        manifest = self.manifest()
        if layer == "warehouse":
            for entry in manifest["tables"].values():
                entry |= _NEW_TABLE | {"last_key": 0 if restart_keys else entry["last_key"]}
        manifest["star"] = {}
        self.commit(manifest)

    def begin(self, run_id: str, truncate: bool = False) -> Run:
        """Start a run. ``truncate`` drops all versions but goes on counting keys."""
        manifest = self.manifest()
        if truncate:
            for entry in manifest["tables"].values():
                entry |= _NEW_TABLE | {"last_key": entry["last_key"]}
        return Run(self, run_id, manifest)


@dataclass
class Run:
    """The next state of the warehouse while it is being written."""

    store: Warehouse
    run_id: str
    manifest: dict
    folder: str = field(init=False)
    before: dict = field(init=False)
    #: Rows by table: opened and ended versions, and of the merged ones the classes new, changed and missing.
    counts: dict[str, dict[str, int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.move()
        self.before = copy.deepcopy(self.manifest)

    def move(self) -> None:
        """Write to a new folder from here on: a repeated attempt of the same run never meets files of an earlier one."""
        self.folder = f"{self.store.root}/runs/{self.run_id}-{uuid.uuid4().hex[:8]}"

    def land(self, table: str, rows: DataFrame, order: tuple = (), label: str = "rows") -> None:
        """Write the opened and ended rows of a merge once, then number the opened ones.

        What was written is counted, by class where the rows have one: as much as has changed, and so
        nothing to speak of where nothing has.
        """
        path = f"{self.folder}/{table}/{label}"
        rows.filter(F.col(STATE) != KEPT).write.options(**COMPACT).partitionBy(STATE).parquet(path)
        columns = T.StructType([f for f in rows.schema if f.name != STATE])
        written = self.store.spark.read.schema(rows.schema).parquet(path)
        kinds = {"opened": F.col(STATE) == OPENED, "ended": F.col(STATE) == CLOSED}
        if "class" in rows.columns:
            kinds |= {k: (F.col("class") == k) & (F.col(STATE) == (CLOSED if k == "missing" else OPENED)) for k in CLASSES}
        counts = written.agg(*[F.count_if(v).alias(k) for k, v in kinds.items()]).first().asDict()
        if not counts["opened"] and not counts["ended"]:
            self.store.remove(path)
            self._count(table, counts)
            return
        opened = f"{path}/{STATE}={OPENED}"
        last = self.store.last_key(table, self.manifest)
        if counts["opened"]:
            once = self.store.spark.read.schema(columns).parquet(opened)
            last = self._append(table, once, path, order, last)
            self.store.remove(opened)
        self._enter(table, path, last, counts)

    def load(self, table: str, rows: DataFrame, order: tuple) -> None:
        """Write rows that are all newly opened, without the merge detour; a row that ties with another in
        the order fails the load.

        Each row is written twice: in its place, and with its number.
        """
        path = f"{self.folder}/{table}/rows"
        before = self.store.last_key(table, self.manifest)
        try:
            last = self._append(table, rows, path, order, before, ENTITIES[table].key)
        except TiedRows as tied:
            raise ValueError(f"repeated source keys in {table}: {tied}") from tied
        self._enter(table, path, last, {"opened": last - before, "ended": 0})

    def _append(self, table: str, opened: DataFrame, path: str, order: tuple, start: int, ties: tuple | None = None) -> int:
        entity = ENTITIES[table]
        with self.scratch(f"{table}-keys") as scratch:
            keyed, last = assign_keys(opened, entity.sk, order, start, scratch, ties)
            state = F.when(is_active(), KEPT).otherwise(CLOSED).alias(STATE)
            rows = keyed.select(*entity.stored_schema.names, state)
            rows.write.options(**COMPACT).mode("append").partitionBy(STATE).parquet(path)
        return last

    def _count(self, table: str, counts: dict[str, int]) -> None:
        total = self.counts.setdefault(table, {})
        for kind, rows in counts.items():
            total[kind] = total.get(kind, 0) + rows

    def _enter(self, table: str, path: str, last_key: int, counts: dict[str, int]) -> None:
        kept, closed = ([p] if self.store.exists(p) else [] for p in _folders(path))
        was = self.manifest["tables"].get(table, _NEW_TABLE)
        self.manifest["tables"][table] = {
            "current": [*was["current"], *kept],
            "ended": [*was["ended"], *closed],
            "closed": [*was["closed"], *closed],
            "last_key": last_key,
            "opened_rows": was["opened_rows"] + counts["opened"],
            "ended_rows": was["ended_rows"] + counts["ended"],
        }
        self._count(table, counts)

    def touched(self, table: str) -> bool:
        """Whether this run has opened or ended versions of a table."""
        return self.manifest["tables"].get(table) != self.before["tables"].get(table)

    def delta(self, table: str) -> DataFrame:
        """The versions that this run has opened or ended."""
        was = self.before["tables"].get(table, _NEW_TABLE)
        now = self.manifest["tables"].get(table, _NEW_TABLE)
        return self.store._read(table, [p for k in ("current", "closed") for p in now[k] if p not in was[k]])

    def compact(self, table: str) -> None:
        """Write the open versions anew if too many of those stored have ended, or they lie in too many folders."""
        entry = self.manifest["tables"].get(table)
        if not entry or not entry["ended"] and len(entry["current"]) <= FOLDERS:
            return
        ended, opened = entry["ended_rows"], entry["opened_rows"]
        folders = max(len(entry["current"]), len(entry["ended"]))
        if ended <= min(ENDED_ROWS, ENDED_SHARE * opened) and folders <= FOLDERS:
            return
        path = f"{self.folder}/{table}/compact"
        self.current(table).write.options(**COMPACT).parquet(path)
        entry |= {"current": [path], "ended": [], "opened_rows": max(0, opened - ended), "ended_rows": 0}
        recent = entry["closed"][-FOLDERS:]
        if len(recent) == FOLDERS:
            merged = f"{self.folder}/{table}/compact-closed"
            self.store._read(table, recent).write.options(**COMPACT).parquet(merged)
            entry["closed"] = [*entry["closed"][:-FOLDERS], merged]

    @contextmanager
    def scratch(self, label: str):
        """A folder for staged rows that goes away once they have been used."""
        path = f"{self.folder}/scratch/{label}-{uuid.uuid4().hex[:8]}"
        try:
            yield path
        finally:
            self.store.remove(path)

    def current(self, table: str) -> DataFrame:
        return self.store.current(table, self.manifest)

    def closed(self, table: str) -> DataFrame:
        return self.store.closed(table, self.manifest)

    def write_star(self, table: str, df: DataFrame) -> None:
        path = f"{self.folder}/star/{table}"
        df.select(*STAR[table].names).write.options(**COMPACT).parquet(path)
        self.manifest["star"][table] = path

    def write_fact(self, fact: DataFrame, replaced: list[int] | None = None) -> None:
        """Write the fact by months; with ``replaced``, these months only, and the others stay.

        Files are split and merged by size within their months, and sorted, so that date ranges skip
        months, then row groups and pages.
        """
        path = f"{self.folder}/star/fact_sales"
        month = F.call_function("div", F.col("date_key"), F.lit(100)).cast("int").alias(MONTH)
        rows = fact.select(*STAR["fact_sales"].names, month)
        sorted_rows = rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "date_key")
        sorted_rows.write.options(**COMPACT).partitionBy(MONTH).parquet(path)
        stays = {} if replaced is None else dict(self.manifest["star"].get("fact_sales") or {})
        for number in replaced or ():
            stays.pop(str(number), None)
        self.manifest["star"]["fact_sales"] = stays | {m: path for m in self.store.partitions(path, MONTH)}

    def star(self, table: str, by_month: bool = False) -> DataFrame:
        return self.store.star(table, self.manifest, by_month)

    def commit(self) -> None:
        for table in list(self.manifest["tables"]):
            if self.touched(table):
                self.compact(table)
        self.manifest["runs"].append(self.run_id)
        self.store.commit(self.manifest)


def _folders(path: str) -> tuple[str, str]:
    return f"{path}/{STATE}={KEPT}", f"{path}/{STATE}={CLOSED}"

"""Operational tables as frames."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronostar.operators import mutations
from chronostar.schemas import SOURCE

def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


@dataclass
class ParquetSource:
    """One Parquet dataset per operational table under a common folder.

    Changes write the files anew that hold a changed row, and no others. New files are written
    beside the table, then a note names what goes and what comes; whoever meets a note of a
    writer that was lost finishes it first, so a change is made wholly or not at all.
    One change of a table at a time.
    """

    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        self._finish(name)
        return conform(self.spark.read.parquet(f"{self.root}/{name}"), SOURCE[name].schema)

    def create_missing(self) -> None:
        """Write every declared table that does not exist as an empty dataset."""
        self._write_empty("ignore")

    def clear(self) -> None:
        """Empty every declared table."""
        self._write_empty("overwrite")

    def _write_empty(self, mode: str) -> None:
        for name, table in SOURCE.items():
            self.spark.createDataFrame([], table.schema).write.mode(mode).parquet(f"{self.root}/{name}")

    # --- changes; each returns the number of rows affected ----------------------

    def upsert(self, name: str, rows: DataFrame) -> int:
        """Insert rows; one whose key exists replaces the old one."""
        key = list(SOURCE[name].unique[0])
        rows = conform(rows, SOURCE[name].schema)
        return self._replace(name, self._holding(name, rows.select(key)), lambda old: mutations.upsert(old, rows, key), rows)

    def update(self, name: str, changes: DataFrame) -> int:
        """Overwrite the columns of ``changes`` beside the key on matching rows, also with NULL."""
        key = list(SOURCE[name].unique[0])
        hit = self.table(name).join(changes.select(key), key, "left_semi")
        return self._replace(name, self._holding(name, changes.select(key)), lambda old: mutations.update_from(old, changes, key), hit)

    def delete(self, name: str, ids: DataFrame) -> int:
        """Drop the rows whose key is in a frame of one column named like it."""
        (column,) = ids.columns
        hit = self.table(name).join(ids, column, "left_semi")
        return self._replace(name, self._holding(name, ids), lambda old: mutations.delete_ids(old, column, ids), hit)

    def double_last_month(self, name: str, amount: str, at: str, today: Column) -> int:
        """Double an amount on the rows dated in the month before ``today``."""
        last_month = F.col(at).cast("date").between(*mutations.previous_month(today))
        files = self._with_files(name).filter(last_month)
        hit = self.table(name).filter(last_month)
        return self._replace(name, files, lambda old: mutations.double_last_month(old, amount, at, today), hit)

    def _with_files(self, name: str) -> DataFrame:
        self._finish(name)
        return self.spark.read.parquet(f"{self.root}/{name}").withColumn("_file", F.col("_metadata.file_path"))

    def _holding(self, name: str, keys: DataFrame) -> DataFrame:
        return self._with_files(name).join(keys.distinct(), keys.columns, "left_semi")

    def _replace(self, name: str, hit: DataFrame, change: Callable[[DataFrame], DataFrame], affected: DataFrame) -> int:
        """Change the files of the rows in ``hit``; returns the number of ``affected`` rows, counted before."""
        # No more names than the listing of files that the driver holds for the scan.
        files = sorted(r[0] for r in hit.select("_file").distinct().collect())
        number = affected.count()
        if not number:
            return 0
        schema, path = SOURCE[name].schema, self.spark._jvm.org.apache.hadoop.fs.Path
        paths = [path(self.spark._jvm.java.net.URI(f)).toString() for f in files]
        old = conform(self.spark.read.parquet(*paths), schema) if paths else self.spark.createDataFrame([], schema)
        mark = uuid.uuid4().hex[:12]
        added = f"{self.root}/{name}/_new-{mark}"
        change(old).select(*schema.names).write.parquet(added)
        fs = self._fs(name)
        comes = [s.getPath().getName() for s in fs.listStatus(path(added)) if s.getPath().getName().endswith(".parquet")]
        note = fs.create(path(f"{self.root}/{name}/_change-{mark}.json"), False)
        note.write(bytearray(json.dumps({"goes": paths, "comes": comes, "from": added}), "utf-8"))
        note.close()
        self._finish(name)
        return number

    def _fs(self, name: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _finish(self, name: str) -> None:
        """Carry out the changes that are noted: every step may have been taken already."""
        fs, path = self._fs(name), self.spark._jvm.org.apache.hadoop.fs.Path
        folder = f"{self.root}/{name}"
        listed = [s.getPath().getName() for s in fs.listStatus(path(folder))] if fs.exists(path(folder)) else []
        for note in sorted(n for n in listed if n.startswith("_change-")):
            stream = fs.open(path(f"{folder}/{note}"))
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                todo = json.loads(text)
            except ValueError:  # lost while it was written: nothing has been moved
                fs.delete(path(f"{folder}/{note}"), False)
                continue
            for file in todo["goes"]:
                fs.delete(path(file), False)
            for file in todo["comes"]:
                if fs.exists(path(f"{todo['from']}/{file}")):
                    fs.rename(path(f"{todo['from']}/{file}"), path(f"{folder}/{file}"))
            fs.delete(path(todo["from"]), True)
            fs.delete(path(f"{folder}/{note}"), False)


@dataclass
class JdbcSource:
    """Operational tables read over JDBC by many tasks.

    Tables with a unique numeric key are read in ranges of it; ``bounds`` gives
    ``(lower, upper)`` where the database should not be asked for them.
    Referrals have no such key and one user may own very many, so they are spread
    by user, source and second together.
    """

    spark: SparkSession
    url: str
    schema: str = "source"
    partitions: int = 64
    bounds: dict[str, tuple[int, int]] = field(default_factory=dict)
    options: dict[str, str] = field(default_factory=dict)

    def _reader(self, **extra: str):
        return self.spark.read.format("jdbc").options(
            url=self.url, preferTimestampNTZ="true", **self.options, **extra
        )

    def range_options(self, name: str, low: int, high: int) -> dict[str, str]:
        return {
            "partitionColumn": SOURCE[name].columns[0].name,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(self.partitions),
        }

    def _bounds(self, name: str) -> tuple[int, int] | None:
        if name in self.bounds:
            return self.bounds[name]
        key = SOURCE[name].columns[0].name
        query = f"SELECT min({key}) AS low, max({key}) AS high FROM {self.schema}.{name}"
        row = self._reader(query=query).load().first()
        return None if row.low is None else (row.low, row.high)

    def spread(self, name: str) -> list[str]:
        """One condition per task that together cover every row once."""
        mix = "CAST(EXTRACT(EPOCH FROM referred_at) AS BIGINT) + user_id + source_id"
        n = self.partitions
        return [f"MOD(MOD({mix}, {n}) + {n}, {n}) = {i}" for i in range(n)]

    def table(self, name: str) -> DataFrame:
        qualified = f"{self.schema}.{name}"
        if name == "user_traffic":
            properties = {"preferTimestampNTZ": "true", **self.options}
            rows = self.spark.read.jdbc(self.url, qualified, predicates=self.spread(name), properties=properties)
        else:
            bounds = self._bounds(name)
            ranges = self.range_options(name, *bounds) if bounds else {}
            rows = self._reader(dbtable=qualified, **ranges).load()
        return conform(rows, SOURCE[name].schema)

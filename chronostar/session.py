"""Session settings and the shared staging area."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans rely on: skewed join partitions are split even when
# that costs a later shuffle, and small shuffles are coalesced. Spark takes the size of files for that of rows
# when it chooses what to broadcast; but a key column of the warehouse has half a byte a row on disk, over 60 in
# the driver's hash table. With the factor, estimates are those of rows, so the size limit holds; what is small
# after all is broadcast from its shuffle, whose size is known.
RUNTIME_CONF = {
    "spark.sql.sources.fileCompressionFactor": "40",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: How the large tables of the warehouse are written: a third smaller than with Spark's default codec.
COMPACT = {"compression": "zstd"}


def build_session(app: str = "chronostar", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the runtime settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@cache
def _ship(context: object) -> None:
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    file = os.path.join(tempfile.mkdtemp(prefix="chronostar-"), "chronostar.zip")
    with zipfile.ZipFile(file, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "chronostar")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, top))
    context.addPyFile(file)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session: tasks that run Python import it there."""
    _ship(spark.sparkContext)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="chronostar-")


def staging_root(spark: SparkSession) -> str:
    """Folder for staged tables, inside the checkpoint folder the cluster names.

    Only a local session may fall back to a folder of this machine; on a cluster
    the executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/chronostar/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str, path: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage, survives lost executors, and gives later joins the real
    size of the data. Parquet rather than ``checkpoint()`` so that readers can
    still prune columns.
    """
    spark = df.sparkSession
    path = path or stage_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_compact(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """``stage`` for what is as large as a table of the warehouse."""
    return stage(df, label, path, **COMPACT)

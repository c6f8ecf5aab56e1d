"""Referral extracts that keep arriving as files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from chronostar.plans.jobs import CURRENT, load_extract
from chronostar.sources.extracts import number_rows, open_extract
from chronostar.sources.warehouse import Warehouse


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of the rows of extract files, each with the file and block it came from."""
    return open_extract(spark.readStream, folder)


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def fold_arrivals(
    store: Warehouse,
    folder: str,
    checkpoint: str,
    batch_id: int,
    name: str = "referrals",
    clock: Callable[[], str] = _now,
    key_mode: str = CURRENT,
) -> StreamingQuery:
    """Fold every file that arrived since the last call into the referrals, then stop.

    All these files are one micro-batch and count as one extract, in the order of their
    names; no limit on files cuts them into several, which would change the history.
    Each micro-batch is one run named after the stream and the batch number. A
    micro-batch that is repeated after a crash finds its run committed and does
    nothing, so files count exactly once.
    """

    def fold(rows: DataFrame, number: int) -> None:
        load_extract(store, number_rows(rows), batch_id, clock(), f"{name}-{number}", key_mode)

    return (
        arrivals(store.spark, folder)
        .writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

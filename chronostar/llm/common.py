"""Helpers that several operators share: sliced Arrow batches and words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that a task works on at once; a single longer text is worked on whole.
SLICE_BYTES = 4 << 20

#: Byte table of words: a-z, 0-9 and all bytes of non-ASCII characters stay, A-Z become lower case.
WORD_BYTES = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words (UTF-8) of a text; null has none."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `limit` bytes in a text column each, at least one row."""
    sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(column)]
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(
    df: DataFrame,
    key: str,
    text: str,
    work: Callable[[], Callable[[list, list[str]], dict]],
    schema: str,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Columns of `schema` for each row. `work()` runs once a task and gives a function
    from keys and texts (null as empty) of a slice to a dict of columns."""

    def run(batches):
        step = work()
        names = types.names
        for batch in batches:
            for part in slices(batch, "_text", limit):
                out = step(part.column("_key").to_pylist(), [x or "" for x in part.column("_text").to_pylist()])
                yield pa.RecordBatch.from_pydict({n: out[n] for n in names}, schema=types)

    types = arrow_schema(df.sparkSession, schema)
    return df.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    """The Arrow types that Spark uses for a DDL schema."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def hash_sample(df: DataFrame, keys: list[str], rows: int, count: int) -> DataFrame:
    """About `rows` of `count` rows, twice as many at most, drawn by a hash of some columns: nothing
    is sorted, and tasks send only the drawn rows."""
    share = min(1.0, rows / max(1, count))
    return df.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * rows)

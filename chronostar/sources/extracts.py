"""Referral extracts: CSV files read by the names in their headers, split over tasks also where fields hold line breaks.

Files are read as lines. A line begins inside a quoted field if the number of quotes before it is
odd: each block counts its own, sums over the blocks of a file tell with which parity a block
begins, and the lines of a record are put together from there. Records are cut into fields by
expressions, so headers may have any width and every record's fields are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronostar.operators.traffic import SEQ

CSV_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("source_id", T.IntegerType()),
        T.StructField("referred_at", T.TimestampNTZType()),
        T.StructField("campaign_code", T.StringType()),
    ]
)

#: What a record with another number of fields than its header does: fail the load, or be left out (see ``rejects``).
FAIL, SKIP = "fail", "skip"
#: Stands for a separator between fields while a record is cut; no record may contain it.
_CUT = "\u0000"
#: A byte order mark before the header.
_MARK = "^\ufeff"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def clean_extract(df: DataFrame) -> DataFrame:
    """An empty campaign field is the empty text, never NULL."""
    return df.withColumn("campaign_code", F.coalesce("campaign_code", F.lit("")))


def open_extract(reader, path: str) -> DataFrame:
    """The lines of extract files with their file and block; ``reader`` is that of a batch or a stream."""
    return reader.format("text").load(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )


def _odd(text: Column) -> Column:
    """1 if a text has an odd number of quotes, else 0."""
    return (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2


def records(lines: DataFrame) -> DataFrame:
    """The records of extract files: text, file, and place (file, block and row of the first line).

    Where no line has an odd number of quotes, lines are records. Otherwise they are
    numbered within their blocks, and only sums by block (not lines) are compared across a file.
    A file that ends inside a quoted field fails the load.
    """
    row = F.monotonically_increasing_id().bitwiseAND((1 << _ROW_BITS) - 1)
    placed = lines.select("_file", "_block", row.alias("_row"), "value", _odd(F.col("value")).alias("_odd"))
    if not placed.filter("_odd = 1").take(1):
        return placed.select("value", "_file", F.struct("_file", "_block", "_row").alias(SEQ))
    before_block = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    in_block = W.partitionBy("_file", "_block").orderBy("_row")
    odd = placed.groupBy("_file", "_block").agg(F.sum("_odd").alias("_sum"))
    sums = odd.withColumn("_earlier", F.coalesce(F.sum("_sum").over(before_block), F.lit(0)))
    whole = odd.groupBy("_file").agg(F.sum("_sum").alias("_all"))
    unclosed = [r[0] for r in whole.filter("_all % 2 = 1").select("_file").take(3)]
    if unclosed:
        raise ValueError(f"malformed extract: a quoted field has no end in {unclosed}")
    own = F.coalesce(F.sum("_odd").over(in_block.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    joined = placed.withColumn("_own", own).join(sums.select("_file", "_block", "_earlier"), ["_file", "_block"])
    starts = joined.withColumn("_start", F.when((F.col("_own") + F.col("_earlier")) % 2 == 0, F.struct("_block", "_row")))
    last = F.last("_start", ignorenulls=True)
    # A record that began in an earlier block began at the last start there.
    ends = starts.groupBy("_file", "_block").agg(F.max("_start").alias("_start"))
    ends = ends.select("_file", "_block", last.over(before_block).alias("_carried"))
    found = starts.withColumn("_begun", last.over(in_block.rowsBetween(W.unboundedPreceding, W.currentRow)))
    found = found.join(ends, ["_file", "_block"]).withColumn("_begun", F.coalesce("_begun", "_carried"))
    parts = F.sort_array(F.collect_list(F.struct("_block", "_row", "value")))
    text = F.array_join(F.transform(parts, lambda p: p.value), "\n")
    grouped = found.groupBy("_file", "_begun").agg(text.alias("value"))
    return grouped.select("value", "_file", F.struct("_file", "_begun._block", "_begun._row").alias(SEQ))


def fields(record: Column) -> Column:
    """The fields of a record. Quoted ones may hold separators, doubled quotes and line breaks; empty ones without quotes are null."""
    pieces = F.split(record, '"')  # every second one is inside quotes
    marked = F.transform(pieces, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(","), F.lit(_CUT))).otherwise(p))
    foreign = F.raise_error(F.concat(F.lit("malformed record with a zero character: "), record)).cast("array<string>")
    cut = F.when(F.contains(record, F.lit(_CUT)), foreign).otherwise(F.split(F.array_join(marked, '"'), _CUT))

    def bare(f: Column) -> Column:
        inner = F.replace(F.substr(f, F.lit(2), F.char_length(f) - 2), F.lit('""'), F.lit('"'))
        quoted = F.startswith(f, F.lit('"')) & F.endswith(f, F.lit('"')) & (F.char_length(f) > 1)
        return F.when(f == "", F.lit(None)).when(quoted, inner).otherwise(f)

    return F.transform(cut, bare)


def _by_header(lines: DataFrame) -> DataFrame:
    """Records that are no header, with their fields and their file's header. Blank lines are none."""
    cut = records(lines).filter(F.trim("value") != "").withColumn("_fields", fields(F.regexp_replace("value", _MARK, "")))
    headers = cut.groupBy("_file").agg(F.min_by("_fields", SEQ).alias("_header"), F.min(SEQ).alias("_first"))
    return cut.join(headers, "_file").withColumn("_is_row", F.col(SEQ) != F.col("_first"))


def number_rows(lines: DataFrame, malformed: str = FAIL) -> DataFrame:
    """The rows of extract files by the column names of each file's header, with their position:
    file, block, row within the block.

    Columns may come in any order and any number. A file without a needed column, a value that is not of
    its type, and (unless they are skipped) records with more or fewer fields than the header fail the load.
    """
    known = _by_header(lines)
    fits = F.size("_fields") == F.size("_header")
    rows = known.filter(F.col("_is_row") & fits if malformed == SKIP else F.col("_is_row"))
    wrong = F.concat(
        F.lit("malformed record of "), F.size("_fields"), F.lit(" fields, the header has "), F.size("_header"),
        F.lit(", in "), F.col("_file"), F.lit(": "), F.col("value"),
    )

    def named(field: T.StructField) -> Column:
        at = F.array_position("_header", field.name)
        missing = F.raise_error(F.concat(F.lit(f"no column {field.name} in "), F.col("_file"))).cast("string")
        value = F.when(~fits, F.raise_error(wrong).cast("string")).when(at > 0, F.get("_fields", (at - 1).cast("int"))).otherwise(missing)
        # The header itself is never converted, wherever the filter on it ends up in the plan.
        return F.when(F.col("_is_row"), value).cast(field.dataType).alias(field.name)

    return clean_extract(rows.select(*[named(f) for f in CSV_SCHEMA], SEQ))


def rejects(lines: DataFrame) -> DataFrame:
    """The records that have more or fewer fields than their file's header."""
    known = _by_header(lines).filter(F.col("_is_row") & (F.size("_fields") != F.size("_header")))
    return known.select(
        F.col("_file").alias("file"),
        F.size("_fields").alias("n_fields"),
        F.size("_header").alias("n_columns"),
        F.col("value").alias("record"),
        SEQ,
    )


def read_extract(spark: SparkSession, path: str, malformed: str = FAIL) -> DataFrame:
    """Rows of extract files; files are split over tasks."""
    return number_rows(open_extract(spark.read, path), malformed)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """What ``read_extract`` fails on, or skips."""
    return rejects(open_extract(spark.read, path))


def with_sequence(df: DataFrame, *order: str) -> DataFrame:
    """Row order of an extract that did not come from a file."""
    return clean_extract(df).withColumn(SEQ, F.struct(*order))

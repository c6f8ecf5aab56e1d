"""WARC archives: written as text, read back by verified record boundaries.

Writing: a record for each page; of equal payloads the page with the smallest id is a
`response`, the others `revisit` it. Records end with an empty line, which is also how
the text writer separates rows, so the files are plain concatenated records.

Reading: files are read in splits. In each split every place that looks like a record
start is a candidate with a successor, the offset at which its block ends. What follows
each other within a split is collapsed there by pointer jumping; across splits the exits
are joined by pointer jumping as well. Only what can be reached from the file's start is
a record; look-alikes inside payloads are not. A second reading returns those records;
blocks that go on in later splits are put together from their pieces.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronostar.llm.common import arrow_schema
from chronostar.session import stage, stage_path

END = "\r\n\r\n"
_END = END.encode()
_MAGIC = b"WARC/1."
#: Rows of the reader end where a record ends and another may begin: no header has an empty line
#: inside, so none is cut, and the mark can't overlap itself, so all splits agree on its places.
_MARK = _END + _MAGIC
#: Rows up to which a table beside the pages or splits is sent to all tasks; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000
RECORDS_PER_FILE = 20_000
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: Column) -> Column:
    """Base32 of the SHA-1 of a binary column."""
    hexed = F.sha1(payload)
    chars = []
    for k in range(8):  # 20 bits are five hexadecimal or four base32 digits
        bits = F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            chars.append(F.lit(_BASE32).substr(F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*chars)


def write_archive(
    pages: DataFrame, path: str, least: int = 0, key: str = "page_id", url: str = "url", text: str = "html"
) -> None:
    """Write the rows of `pages` as WARC files under `path`.

    Null texts have an empty payload, null URLs no target line, line breaks in URLs are
    escaped. Payloads below `least` bytes are never revisits. Rows that repeat the id of a
    response are responses too; a null id counts as larger than any other. An empty table
    gives an empty archive. Other columns are not read.
    """
    payload = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("_id"), F.col(url).cast("string").alias("_url"), payload.alias("_payload"))
    rows = rows.withColumn("_size", F.octet_length("_payload")).withColumn("_digest", digest(F.col("_payload").cast("binary")))
    firsts = rows.filter(F.col("_size") >= least).groupBy("_digest").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    firsts = stage(firsts.filter("_n > 1").select("_digest", "_first"), "equal-payloads")
    if firsts.count() <= BROADCAST_ROWS:
        firsts = F.broadcast(firsts)
    joined = rows.join(firsts, "_digest", "left")
    again = (F.col("_size") >= least) & F.col("_first").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_first"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_size"), F.lit(END)
    )
    name = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    target = F.regexp_replace(F.regexp_replace(F.col("_url"), "\r", "%0D"), "\n", "%0A")
    block = F.octet_length(http) + F.when(again, 0).otherwise(F.col("_size"))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"),
        name,
        F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"),
        F.when(target.isNull(), "").otherwise(F.concat(F.lit("WARC-Target-URI: "), target, F.lit("\r\n"))),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("_digest"),
        F.when(
            again,
            F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("_first"), F.lit(">")),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        block,
        F.lit(END),
        http,
        F.when(again, "").otherwise(F.col("_payload")),
    )
    writer = joined.select(record.alias("value")).write.option("lineSep", END)
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


class Candidates:
    """Places in a split's bytes that look like record starts."""

    def __init__(self, data: bytes):
        self.data, self.start, self.body, self.stop = data, [], [], []
        at = data.find(_MAGIC)
        while at >= 0:
            end = data.find(_END, at)
            length = _content_length(data[at:end]) if end >= 0 else -1
            if length >= 0:
                self.start.append(at)
                self.body.append(end + 4)
                self.stop.append(end + 4 + length)
            at = data.find(_MAGIC, at + 1)

    def exits(self) -> np.ndarray:
        """Where the chain from each candidate leaves the split (-1: at no candidate)."""
        start, after = np.array(self.start, np.int64), np.array(self.stop, np.int64) + 4
        if not len(start):
            return start
        place = np.minimum(np.searchsorted(start, after), len(start) - 1)
        inside = after < len(self.data)
        known = inside & (start[place] == after)
        # Jump to the last candidate of the chain, doubling the way each round.
        jump = np.where(known, place, np.arange(len(start)))
        while True:
            further = jump[jump]
            if (further == jump).all():
                break
            jump = further
        return np.where(inside[jump], -1, after[jump])

    def chain(self, entry: int) -> list[int]:
        """Numbers of the candidates reached from an entry offset."""
        number = {s: i for i, s in enumerate(self.start)}
        out = []
        while entry in number:
            i = number[entry]
            out.append(i)
            entry = self.stop[i] + 4
        return out


def _content_length(header: bytes) -> int:
    for line in header.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value)
    return -1


def _splits(batches: Iterator[pa.RecordBatch], more: list[str]) -> Iterator[tuple[tuple, bytes]]:
    """The bytes of each split, with its key: file, start and further columns. They begin at a
    mark's magic (or the file's start) and end before the next split's."""
    own, held = None, []

    def together():
        return own, (_MAGIC if own[1] else b"") + _MARK.join(held) + _END

    for batch in batches:
        names = ["_file", "_split", *more]
        keys = list(zip(*[batch.column(n).to_pylist() for n in names]))
        values = batch.column("value").to_pylist()
        for key, value in zip(keys, values):
            if own is not None and key[:2] != own[:2]:
                yield together()
                held = []
            own = key
            held.append(value)
    if own is not None:
        yield together()


_RECORD = (
    "_file string, _offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "declared_digest string, declared_length long, payload binary, payload_digest string, payload_bytes long, "
    "_missing long, _order long, _piece binary"
)


def _fields(header: bytes) -> dict[str, str]:
    lines = (line.partition(b":") for line in header.split(b"\r\n")[1:])
    return {n.strip().lower().decode("utf-8", "replace"): v.strip().decode("utf-8", "replace") for n, _, v in lines}


def _described(header: bytes, block: bytes, with_payload: bool) -> dict:
    """The columns of a record from its header and whole block."""
    own = _fields(header)
    out = {
        "record_type": own.get("warc-type"),
        "record_id": own.get("warc-record-id"),
        "target_uri": own.get("warc-target-uri"),
        "refers_to": own.get("warc-refers-to"),
        "declared_digest": own.get("warc-payload-digest"),
    }
    payload = block
    if own.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(_END)
        length = _fields(head).get("content-length", "")
        out["declared_length"] = int(length) if length.isdigit() else None
    if own.get("warc-type") != "revisit":
        out["payload"] = payload if with_payload else None
        out["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out["payload_bytes"] = len(payload)
    return out


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of WARC files: file, offset, type, ids, target, declared digest and length, payload,
    its digest and size (all from the bytes; null for revisits, which have no payload).

    What is not on the chain of records from a file's start is not read; a chain ends at
    the first place where no record begins. A split is held in memory at a time.
    """
    meta = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split")]
    lines = spark.read.option("lineSep", _MARK.decode()).text(path).select(F.col("value").cast("binary").alias("value"), *meta)

    def outline(batches):
        for (file, split), data in _splits(batches, []):
            found = Candidates(data)
            start, exits = np.array(found.start, np.int64), found.exits()
            n = len(start)
            yield pa.RecordBatch.from_pydict(
                {
                    "_file": [file] * (n + 1),
                    "_split": [split] * (n + 1),
                    "_start": np.r_[-1, start],
                    "_exit": np.r_[len(data), exits],  # of the first row: the split's bytes
                },
                schema=outline_types,
            )

    outline_schema = "_file string, _split long, _start long, _exit long"
    outline_types = arrow_schema(spark, outline_schema)
    seen = stage(lines.mapInArrow(outline, outline_schema), "warc-outline")
    by = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    # A row a split; a file has as many as its size gives.
    splits = stage(
        seen.filter("_start = -1").select(
            "_file", "_split", F.coalesce(F.sum("_exit").over(by), F.lit(0)).alias("_base"), F.col("_exit").alias("_bytes")
        ),
        "warc-splits",
    )
    few = splits.count() <= BROADCAST_ROWS
    near = F.broadcast(splits) if few else splits
    jumps = seen.filter("_start >= 0 and _exit >= 0").join(near, ["_file", "_split"])
    jumps = stage(
        jumps.select("_file", (F.col("_base") + F.col("_start")).alias("_from"), (F.col("_base") + F.col("_exit")).alias("_to")),
        "warc-jumps",
    )
    reached = splits.select("_file").distinct().withColumn("_at", F.lit(0).cast("long"))
    while jumps.take(1):  # each round doubles the number of splits that a jump crosses
        step = reached.join(jumps, (reached["_file"] == jumps["_file"]) & (reached["_at"] == jumps["_from"]))
        reached = stage(reached.union(step.select(reached["_file"], F.col("_to").alias("_at"))).distinct(), "warc-reached")
        a, b = jumps.alias("a"), jumps.alias("b")
        jumps = a.join(b, (F.col("a._file") == F.col("b._file")) & (F.col("a._to") == F.col("b._from")))
        jumps = stage(jumps.select("a._file", "a._from", "b._to"), "warc-jumps")

    # What each split's reader must know: where it is entered.
    inside = (F.col("_at") >= F.col("_base")) & (F.col("_at") < F.col("_base") + F.col("_bytes"))
    entries = splits.join(reached, "_file").filter(inside)  # entries of a file are as few as its splits
    plan = splits.join(
        entries.groupBy("_file", "_split").agg(F.min("_at").alias("_entry")), ["_file", "_split"], "left"
    ).select("_file", "_split", "_base", "_entry")
    plan = stage(plan, "warc-plan")

    numbered = lines.withColumns({"_n": F.monotonically_increasing_id(), "_size": F.col("_metadata.file_size")})
    if few:
        planned = numbered.join(F.broadcast(plan), ["_file", "_split"])
    else:
        planned = numbered.join(plan, ["_file", "_split"]).repartition("_file", "_split")
        planned = planned.sortWithinPartitions("_file", "_split", "_n")

    def records(batches):
        for (file, _, base, size, entry), data in _splits(batches, ["_base", "_size", "_entry"]):
            rows = []
            # All before the entry belongs to a block that began in an earlier split.
            lead = data if entry is None else data[: entry - base]
            if base and lead:
                rows.append({"_file": file, "_order": base, "_piece": lead})
            found = Candidates(data)
            for i in found.chain(entry - base) if entry is not None else []:
                start, body, stop = found.start[i], found.body[i], found.stop[i]
                row = {"_file": file, "_offset": base + start}
                if base + stop > size:  # the file ends within the block
                    continue
                if stop <= len(data):
                    row |= _described(data[start : body - 4], data[body:stop], with_payload)
                else:
                    row |= {"_missing": base + stop, "_order": base + start, "_piece": data[start:]}
                rows.append(row)
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=record_types)

    record_types = arrow_schema(spark, _RECORD)
    read = planned.mapInArrow(records, _RECORD)
    public = [c for c in record_types.names if not c.startswith("_")]
    whole = read.filter("_piece is null").select("_file", "_offset", *public)

    # Of each split boundary at most one record goes across it; its pieces follow each other.
    pieces = stage(read.filter("_piece is not null").select("_file", "_order", "_offset", "_missing", "_piece"), "warc-pieces")
    heads = pieces.filter("_offset is not null").select("_file", "_offset", "_missing", F.col("_order").alias("_from"))
    reach = (F.col("p._order") >= F.col("h._from")) & (F.col("p._order") < F.col("h._missing"))
    owned = heads.alias("h").join(pieces.alias("p"), (F.col("h._file") == F.col("p._file")) & reach)
    owned = owned.filter("p._offset is null or p._offset = h._offset").select(
        "h._file", "h._offset", "h._missing", "p._order", "p._piece"
    )
    joined = owned.groupBy("_file", "_offset", "_missing").agg(F.sort_array(F.collect_list(F.struct("_order", "_piece"))).alias("_all"))

    def assemble(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                data = b"".join(x["_piece"] for x in r["_all"])
                body = data.find(_END) + 4
                stop = r["_missing"] - r["_offset"]
                own = {"_file": r["_file"], "_offset": r["_offset"]}
                rows.append(own | _described(data[: body - 4], data[body:stop], with_payload))
            yield pa.RecordBatch.from_pylist(rows, schema=record_types)

    across = joined.mapInArrow(assemble, _RECORD).select("_file", "_offset", *public)
    return whole.union(across).withColumnsRenamed({"_file": "file", "_offset": "offset"})


def round_trip(pages: DataFrame, least: int = 0, key: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """Write the pages as an archive in the shared folder and read its records back: one row a page.

    Sizes and digests of responses come from the payloads read, those of revisits from their records.
    """
    path = stage_path(pages.sparkSession, "warc")
    write_archive(pages, path, least, key, url, text)
    records = read_archive(pages.sparkSession, path, with_payload=False)

    def page(name: str) -> Column:
        return F.regexp_extract(name, "^<urn:page:(.*)>$", 1).try_cast("long")

    return records.select(
        page("record_id").alias(key),
        F.coalesce("payload_bytes", "declared_length").alias("payload_bytes"),
        F.coalesce("payload_digest", F.regexp_replace("declared_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
        F.col("target_uri").alias(url),
    )

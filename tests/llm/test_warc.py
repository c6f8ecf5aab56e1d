import base64
import hashlib

import pytest

from chronostar.llm import queries, warc

from .brute import table
from .conftest import SF

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def expected(rows, least=0):
    rows = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in rows:
        first[b] = min(first.get(b, i), i)
    out = []
    for i, b in rows:
        new = first[b] == i or len(b) < least
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), digest, "response" if new else "revisit", None if new else first[b]))
    return sorted(out)


def shown(df):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def test_query(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in table(SF, "pages")]
    assert shown(queries.op6_warc(spark, SF)) == expected(rows)


@pytest.mark.parametrize("split", ["600", "1m"])
def test_look_alikes_and_records_across_splits(spark, split):
    rows = [
        (1, "u", "a"), (2, "u", "a"), (3, None, None), (4, "u", ""), (5, "u\r\nx", FAKE * 3), (6, "u", "x\r\n\r\n" + FAKE + "y"),
        (7, "u", "\r\n\r\n\r\n"), (8, "u", "WARC/1.0\r\nContent-Length: 100000\r\n\r\n"), (9, "u", "z" * 1500 + "\r\n\r\n" + FAKE * 9 + "end\r\n"),
        (10, "u", "é\n" * 100), (11, "u", FAKE[:-4]), (12, "u", "\r\n"), (13, "u", "WARC/1.1\r\nContent-Length: 0"), (14, "u", "q\r\n\r\n" * 300),
        (15, "u", "q\r\n\r\n" * 300),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS file", "2 AS `_digest`")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert shown(warc.round_trip(df.coalesce(1))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_payloads_and_least_size(spark, tmp_path):
    rows = [(1, "http://a", "same"), (2, None, "same"), (3, "c", "longer text"), (4, "d", "longer text")]
    path = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path, least=5)
    got = {r.record_id: r for r in warc.read_archive(spark, path).collect()}
    assert [bytes(got[f"<urn:page:{i}>"].payload) for i in (1, 2, 3)] == [b"same", b"same", b"longer text"]
    assert got["<urn:page:4>"].payload is None and got["<urn:page:4>"].refers_to == "<urn:page:3>"
    assert got["<urn:page:1>"].target_uri == "http://a" and got["<urn:page:2>"].target_uri is None


def test_truncated_file_and_empty_table(spark, tmp_path):
    folder = tmp_path / "cut"
    folder.mkdir()
    (folder / "a.warc").write_bytes(FAKE.encode() * 2 + FAKE.encode()[:-7])
    assert warc.read_archive(spark, str(folder)).count() == 2  # the last block isn't whole
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_repeated_and_null_ids(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, "u", None)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in got) == [
        (0, 0, "response", 0), (0, 1, "revisit", 1), (1, 1, "response", 0), (1, 1, "response", 0),
    ]

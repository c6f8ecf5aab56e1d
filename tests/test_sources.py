"""Extract files, arriving files, source options, command line."""

import duckdb
import pytest
from support import MemorySource, at, frame, referral, rows, user
from test_history import T1, load

from chronostar.__main__ import main, parse
from chronostar.operators.traffic import SEQ
from chronostar.sources.extracts import SKIP, number_rows, open_extract, read_extract, read_rejects
from chronostar.sources.tables import JdbcSource, ParquetSource
from chronostar.sources.warehouse import Warehouse
from chronostar.streaming.arrivals import fold_arrivals

HEADER = "user_id,source_id,referred_at,campaign_code\n"


def test_extract_fields(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        HEADER
        + "1,2,2024-01-01 10:20:30,C1\n"
        + "1,2,2024-01-01T10:20:30.123456,\n"
        + '2,1,2024-01-02,"a,b"\n'
    )
    assert rows(read_extract(spark, str(path)), "user_id", "source_id", "referred_at", "campaign_code") == [
        (1, 2, at("2024-01-01 10:20:30"), "C1"),
        (1, 2, at("2024-01-01 10:20:30.123456"), ""),
        (2, 1, at("2024-01-02"), "a,b"),
    ]


def test_header_only_extract(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(HEADER)
    assert read_extract(spark, str(path)).count() == 0


def test_malformed_extract_fails(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(HEADER + "one,2,2024-01-01,C\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_extract(spark, str(path)).collect()


def test_extract_position_is_the_file_order(spark, tmp_path):
    for name, start in (("b.csv", 1000), ("a.csv", 0)):
        lines = "".join(f"{start + i},1,2024-01-01 00:00:00,C\n" for i in range(1000))
        (tmp_path / name).write_text(HEADER + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        df = read_extract(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 4
        assert [r.user_id for r in df.orderBy(SEQ).collect()] == list(range(2000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_batch_and_stream_read_alike(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,1,2024-01-01 00:00:00,C\n")
    batch = number_rows(open_extract(spark.read, str(tmp_path)))
    assert open_extract(spark.readStream, str(tmp_path)).columns == open_extract(spark.read, str(tmp_path)).columns
    assert batch.columns == ["user_id", "source_id", "referred_at", "campaign_code", SEQ]


def test_extract_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('source_id,note,user_id,campaign_code,referred_at\n7,x,1,"a ""b"", c\nd",2024-01-01 00:00:00\n')
    (tmp_path / "b.csv").write_text(HEADER + '2,8,2024-01-02 00:00:00,""\n')
    got = rows(read_extract(spark, str(tmp_path)), "user_id", "source_id", "campaign_code")
    assert got == [(1, 7, 'a "b", c\nd'), (2, 8, "")]
    (tmp_path / "c.csv").write_text("user_id,source_id,referred_at\n1,1,2024-01-01 00:00:00\n")
    with pytest.raises(Exception, match="no column campaign_code"):
        read_extract(spark, str(tmp_path)).collect()


def test_wide_extract(spark, tmp_path):
    names = [f"n{i}" for i in range(90)] + ["campaign_code", "user_id", "referred_at", "source_id"]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(["x"] * 90) + ",C,3,2024-01-01,4\n")
    (tmp_path / "b.csv").write_text("\ufeff" + HEADER + "5,6,2024-01-01,\n\n")
    got = rows(read_extract(spark, str(tmp_path)), "user_id", "source_id", "campaign_code")
    assert got == [(3, 4, "C"), (5, 6, "")]


def test_records_of_another_width(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + '1,1,2024-01-01,A\n3\n4,2\n5,2,2024-01-01,"B, b",extra\n6,2,2024-01-01,C\n')
    with pytest.raises(Exception, match="malformed record of . fields, the header has 4"):
        read_extract(spark, str(tmp_path)).collect()
    assert rows(read_extract(spark, str(tmp_path), SKIP), "user_id", "campaign_code") == [(1, "A"), (6, "C")]
    wrong = read_rejects(spark, str(tmp_path))
    assert rows(wrong, "n_fields", "record") == [(1, "3"), (2, "4,2"), (5, '5,2,2024-01-01,"B, b",extra')]
    (tmp_path / "b.csv").write_text(HEADER + '1,1,2024-01-01,"A\n3,3,2024-01-01,B\n')
    with pytest.raises(ValueError, match="malformed extract: a quoted field has no end"):
        read_extract(spark, str(tmp_path))


def test_line_breaks_in_fields_over_many_blocks(spark, tmp_path):
    """One file read by many tasks gives the rows that one task gives, in order, also in the stream's form."""
    want = []
    with open(tmp_path / "a.csv", "w") as f:
        f.write(HEADER)
        for i in range(400):
            code = {0: "plain", 1: "a\nb", 2: '"', 3: 'x ""\n\n, y\n' * (i % 17), 4: ","}[i % 5]
            want.append((i, code))
            f.write(f'{i},1,2024-01-01 00:00:00,"' + code.replace('"', '""') + '"\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = read_extract(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        assert [(r.user_id, r.campaign_code) for r in df.orderBy(SEQ).collect()] == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    df = read_extract(spark, str(tmp_path))
    assert [(r.user_id, r.campaign_code) for r in df.orderBy(SEQ).collect()] == want


def test_arriving_files_count_once(spark, store, tmp_path):
    load(store, MemorySource(spark, user_traffic=[]))
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    folder.mkdir()

    def run():
        fold_arrivals(store, str(folder), checkpoint, 2, clock=lambda: T1).awaitTermination()

    (folder / "1.csv").write_text(HEADER + "1,1,2024-01-01 00:00:00,A\n")
    run()
    assert rows(store.history("user_traffic"), "user_sk", "campaign_code") == [(1, "A")]
    version = store.manifest()["version"]
    run()
    assert store.manifest()["version"] == version
    (folder / "2.csv").write_text(HEADER + '"1",1,2024-01-01 00:00:00,"B"\n2,2,1990-01-01 00:00:00,\n')
    run()
    assert rows(store.history("user_traffic"), "user_sk", "campaign_code", "update_id") == [
        (1, "A", 2),
        (1, "B", None),
        (2, "", None),
    ]
    assert rows(store.star("fact_sales"), "sale_id", "traffic_source_key") == [(1, 1), (2, 2)]


def test_repeated_micro_batch_is_ignored(spark, store, tmp_path):
    load(store, MemorySource(spark, user_traffic=[]))
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text(HEADER + "1,1,2024-01-01 00:00:00,A\n")
    for checkpoint in ("first", "lost"):  # a lost checkpoint replays batch 0
        fold_arrivals(store, str(folder), str(tmp_path / checkpoint), 2, clock=lambda: T1).awaitTermination()
    assert store.history("user_traffic").count() == 1


def test_jdbc_reads_in_key_ranges(spark):
    source = JdbcSource(spark, "jdbc:postgresql://db/x", partitions=8)
    assert source.range_options("sales", 1, 1000) == {
        "partitionColumn": "sale_id",
        "lowerBound": "1",
        "upperBound": "1000",
        "numPartitions": "8",
    }


def test_jdbc_spreads_one_users_referrals(spark):
    """The conditions cover every row once, also before 1970, and split a single user."""
    source = JdbcSource(spark, "jdbc:postgresql://db/x", partitions=4)
    data = (
        "SELECT 7 AS user_id, 1 AS source_id, TIMESTAMP '1970-01-01' + to_seconds((i - 500) * 61) AS referred_at "
        "FROM range(1000) t(i)"
    )
    sizes = [
        duckdb.sql(f"SELECT count(*) FROM ({data}) x WHERE {c}").fetchall()[0][0] for c in source.spread("user_traffic")
    ]
    assert sum(sizes) == 1000 and max(sizes) < 300


def test_empty_operational_tables(spark, tmp_path):
    source = ParquetSource(spark, str(tmp_path))
    MemorySource(spark).table("users").write.parquet(str(tmp_path / "users"))
    source.create_missing()
    assert source.table("users").count() == 2 and source.table("sales").count() == 0
    source.clear()
    assert source.table("users").count() == 0


def stored_users(spark, tmp_path, n=40):
    """Users in files of ten keys each."""
    source = ParquetSource(spark, str(tmp_path / "source"))
    for start in range(1, n, 10):
        part = MemorySource(spark, users=[user(i) for i in range(start, start + 10)]).table("users")
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "source" / "users"))
    return source, lambda: {p.name for p in (tmp_path / "source" / "users").glob("*.parquet")}


def test_changes_write_only_the_files_they_hit(spark, tmp_path):
    source, files = stored_users(spark, tmp_path)
    before = files()
    schema = source.table("users").schema
    assert source.delete("users", frame(spark, [(3,), (99,)], schema[:1])) == 1
    assert len(files() & before) == 3
    assert sorted(r.user_id for r in source.table("users").collect()) == [1, 2, *range(4, 41)]
    middle = files()
    assert source.upsert("users", frame(spark, [user(15, "Z"), user(50)], schema)) == 2
    assert len(files() & middle) == 3
    changes = source.table("users").filter("user_id = 25").selectExpr("user_id", "cast(null as string) AS phone", "'Q' AS country")
    assert source.update("users", changes) == 1
    got = {r.user_id: r.country for r in source.table("users").collect()}
    assert sorted(got) == [1, 2, *range(4, 41), 50] and {k for k, c in got.items() if c != "X"} == {15, 25}
    last = files()
    assert source.delete("users", frame(spark, [(99,)], schema[:1])) == 0 and files() == last


def test_noted_change_of_a_lost_writer_is_finished(spark, tmp_path, monkeypatch):
    source, files = stored_users(spark, tmp_path, 20)
    schema = source.table("users").schema
    finish = ParquetSource._finish
    monkeypatch.setattr(ParquetSource, "_finish", lambda self, name: None)
    assert source.upsert("users", frame(spark, [user(5, "Z")], schema)) == 1
    assert {r.country for r in source.table("users").collect()} == {"X"}  # noted, not yet made
    monkeypatch.setattr(ParquetSource, "_finish", finish)
    got = {r.user_id: r.country for r in source.table("users").collect()}
    assert len(got) == 20 and got[5] == "Z"
    assert not list((tmp_path / "source" / "users").glob("_*-*"))


def test_change_then_increment(spark, tmp_path, monkeypatch):
    memory = MemorySource(spark)
    for name in memory.rows:
        memory.table(name).write.parquet(str(tmp_path / "source" / name))
    monkeypatch.setattr("chronostar.__main__.build_session", lambda: spark)
    common = ["--source", str(tmp_path / "source")]
    stored = ["--warehouse", str(tmp_path / "w")]
    main(["full", *common, *stored, "--batch-ts", T1])
    frame(spark, [user(1, "Y"), user(7)], memory.table("users").schema).write.parquet(str(tmp_path / "new"))
    main(["change", "users", *common, "--upsert", str(tmp_path / "new")])
    spark.sql("SELECT 2 AS user_id").write.parquet(str(tmp_path / "gone"))
    main(["change", "users", *common, "--delete", str(tmp_path / "gone")])
    day = "add_months(trunc(current_date(), 'month'), -1)"
    spark.sql(f"SELECT 1L AS sale_id, cast({day} AS timestamp_ntz) AS sale_date").write.parquet(str(tmp_path / "dates"))
    main(["change", "sales", *common, "--update", str(tmp_path / "dates")])
    main(["change", "sales", *common, "--double-last-month", "cost_in_rubbles", "sale_date"])
    main(["inc", "20240202", *common, *stored])
    store = Warehouse(spark, str(tmp_path / "w"))
    assert rows(store.current("users"), "user_id", "country") == [(1, "Y"), (7, "X")]
    assert rows(store.current("sales"), "sale_id", "cost_in_rubbles") == [(1, 200), (2, 100)]
    assert store.closed("users").count() == 2 and store.closed("sales").count() == 1


def test_command_line_runs_both_loads(spark, tmp_path, monkeypatch):
    memory = MemorySource(spark, user_traffic=[referral(1)])
    for name in memory.rows:
        memory.table(name).write.parquet(str(tmp_path / "source" / name))
    csv = tmp_path / "t.csv"
    csv.write_text(HEADER + "2,2,2024-01-01 00:00:00,X\n")
    monkeypatch.setattr("chronostar.__main__.build_session", lambda: spark)
    common = ["--source", str(tmp_path / "source"), "--extract", str(csv), "--warehouse", str(tmp_path / "w")]
    main(["full", *common, "--batch-ts", T1])
    main(["inc", "20240202", *common])
    store = Warehouse(spark, str(tmp_path / "w"))
    assert rows(store.star("fact_sales"), "sale_id", "traffic_source_key") == [(1, 1), (2, 2)]
    assert store.sample("star_schema", "dim_user", 1).count() == 1
    main(["clear", "star_schema", "--warehouse", str(tmp_path / "w")])
    assert store.star("fact_sales").count() == 0 and store.history("users").count() == 2


def test_command_line_arguments():
    assert parse(["inc", "--source", "s", "--warehouse", "w"]).batch_id is None
    assert parse(["clear", "source", "--source", "s"]).layer == "source"
    for wrong in (["clear", "source", "--warehouse", "w"], ["clear", "warehouse", "--source", "s"], ["inc"]):
        with pytest.raises(SystemExit):
            parse(wrong)


def test_two_runs_cannot_publish_the_same_version(spark, store):
    first, second = store.manifest(), store.manifest()
    store.commit(first)
    with pytest.raises(RuntimeError, match="another run was faster"):
        store.commit(second)


def test_order_lines_are_numbered_once_for_both_snapshots(spark, tmp_path, monkeypatch):
    from datetime import datetime

    import pyarrow as pa
    import pyarrow.parquet as pq

    from chronostar.sources.fixtures import FixtureSource

    day = datetime(1996, 1, 2)
    lines = [(1, 1, 7), (1, 1, 5), (1, 2, 5), (49, 1, 5), (9, 1, 5), (None, 1, 5)]  # order 9 is unknown, 1 comes twice
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]
    columns = [*zip(*[(*line, 3, day, 10.5, 2.0) for line in lines])]
    pq.write_table(pa.table([pa.array(c) for c in columns], names=names), f"{tmp_path}/lineitem.parquet")
    orders = {"o_orderkey": [1, 1, 49], "o_custkey": [4, 6, 4], "o_orderdate": [day] * 3, "o_orderstatus": ["F", "O", "P"]}
    pq.write_table(pa.table(orders), f"{tmp_path}/orders.parquet")
    made = []
    numbered = FixtureSource._numbered_lines
    monkeypatch.setattr(FixtureSource, "_numbered_lines", lambda self: made.append(1) or numbered(self))

    def found(snapshot, table, *columns):
        return sorted(map(tuple, FixtureSource(spark, str(tmp_path), snapshot).table(table).select(*columns).collect()), key=str)

    first = [(i, u, c) for i, c in ((1100000, 5), (1100001, 7), (1200000, 5)) for u in (4, 6)]
    assert found(1, "enrollments", "enrollment_id", "user_id", "course_id") == first
    assert found(2, "enrollments", "enrollment_id", "user_id", "course_id") == sorted([*first, (49100000, 4, 5)], key=str)
    ids = [1100000, 1100001, 1200000, 9100000]
    assert found(1, "sales", "sale_id") == [(i,) for i in ids]
    assert found(2, "sales", "sale_id") == [(i,) for i in sorted([*ids, 49100000], key=lambda i: str((i,)))] + [(None,)]
    assert made == [1]

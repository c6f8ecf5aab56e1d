"""Run registered queries against their SQL on the same tables.

    python tests/compare.py [sf0.01 | /folder] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in (t for t in TABLES if os.path.exists(f"{sf_dir}/{t}.parquet")):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


# DuckDB type -> Spark type, to see that both sides agree on the schema.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def difference(df, con, sql: str) -> str | None:
    """None if the frame equals the SQL's result in columns, types and rows."""
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, (TYPES.get(str(t), str(t)) for t in rel.types)))
    got_types = dict(df.dtypes)
    if want_types != got_types:
        return f"schema: spark {got_types} sql {want_types}"
    want = multiset(rel.columns, rel.fetchall())
    got = multiset(df.columns, df.collect())
    if want != got:
        extra, lost = got - want, want - got
        return f"rows: {sum(got.values())} vs {sum(want.values())}; extra {list(extra)[:2]} missing {list(lost)[:2]}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from chronostar.session import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith(("sf", "/")) else "sf0.01"
    sf_dir = sf if sf.startswith("/") else f"/root/testdata/{sf}"
    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            problem = difference(df, con, oracles[name]) if name in oracles else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:36} {time.time() - start:6.2f}s  {'ok' if problem is None else problem}", flush=True)
    missing = set(oracles) - set(entry.queries())
    print(f"{bad} differ; SQL without query: {sorted(missing)}")


if __name__ == "__main__":
    main()

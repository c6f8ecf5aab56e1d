"""Command surface.

    python -m chronostar full --source DIR --extract CSV --warehouse DIR
    python -m chronostar inc 20240202 --source DIR --extract CSV --warehouse DIR
    python -m chronostar change users --source DIR --upsert ROWS
    python -m chronostar clear warehouse --warehouse DIR
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import functions as F

from chronostar.plans.jobs import AS_LOADED, CURRENT, full_load, incremental_load
from chronostar.schemas import SOURCE
from chronostar.session import build_session
from chronostar.sources.extracts import FAIL, SKIP, read_extract, read_rejects
from chronostar.sources.tables import JdbcSource, ParquetSource
from chronostar.sources.warehouse import Warehouse


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="chronostar")
    commands = parser.add_subparsers(dest="command", required=True)
    full = commands.add_parser("full", help="rebuild everything")
    inc = commands.add_parser("inc", help="merge one batch")
    inc.add_argument("batch_id", type=int, nargs="?", help="number of the batch; default the day's, as YYYYMMDD")
    for sub in (full, inc):
        sub.add_argument("--source", required=True, help="folder of Parquet tables, or a JDBC URL")
        sub.add_argument("--extract", help="CSV file or folder with referrals")
        sub.add_argument("--malformed", choices=(FAIL, SKIP), default=FAIL, help="what a record of another width does")
        sub.add_argument("--warehouse", required=True, help="folder shared by all executors")
        sub.add_argument("--batch-ts", help="timestamp of the batch, UTC; default now")
        sub.add_argument("--run-id", help="unique name of the run; repeating it is a no-op")
        sub.add_argument("--key-mode", choices=(AS_LOADED, CURRENT), default=CURRENT)
        sub.add_argument("--unknown-members", action=argparse.BooleanOptionalAction, default=True)
    wrong = commands.add_parser("rejects", help="show the records of an extract that have another width than its header")
    wrong.add_argument("--extract", required=True)
    wrong.add_argument("--limit", type=int, default=20)
    change = commands.add_parser("change", help="change an operational table; the next inc finds it")
    change.add_argument("table", choices=tuple(SOURCE))
    change.add_argument("--source", required=True, help="folder of Parquet tables")
    what = change.add_mutually_exclusive_group(required=True)
    what.add_argument("--upsert", metavar="PARQUET", help="whole rows to insert or replace")
    what.add_argument("--update", metavar="PARQUET", help="keys and the columns to overwrite")
    what.add_argument("--delete", metavar="PARQUET", help="keys, one column")
    what.add_argument("--double-last-month", nargs=2, metavar=("AMOUNT", "DATED"), help="names of two columns")
    clear = commands.add_parser("clear", help="empty a layer")
    clear.add_argument("layer", choices=("source", "warehouse", "star_schema"))
    clear.add_argument("--warehouse")
    clear.add_argument("--source", help="folder of Parquet tables")
    sample = commands.add_parser("sample", help="show some rows of a table")
    sample.add_argument("layer", choices=("warehouse", "star_schema"))
    sample.add_argument("table")
    sample.add_argument("--warehouse", required=True)
    sample.add_argument("--limit", type=int, default=5)
    args = parser.parse_args(argv)
    if args.command == "clear" and not (args.source if args.layer == "source" else args.warehouse):
        parser.error(f"clear {args.layer} needs --{'source' if args.layer == 'source' else 'warehouse'}")
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session()
    if args.command == "sample":
        Warehouse(spark, args.warehouse).sample(args.layer, args.table, args.limit).show(args.limit, truncate=False)
        return
    if args.command == "change":
        source, today = ParquetSource(spark, args.source), F.current_date()
        if args.double_last_month:
            rows = source.double_last_month(args.table, *args.double_last_month, today)
        else:
            kind = next(k for k in ("upsert", "update", "delete") if getattr(args, k))
            rows = getattr(source, kind)(args.table, spark.read.parquet(getattr(args, kind)))
        print(f"{args.table}: {rows} rows affected")
        return
    if args.command == "rejects":
        read_rejects(spark, args.extract).drop("_seq").show(args.limit, truncate=False)
        return
    if args.command == "clear" and args.layer == "source":
        ParquetSource(spark, args.source).clear()
        return
    if args.command == "clear":
        Warehouse(spark, args.warehouse).reset_layer(args.layer)
        return
    now = datetime.now(timezone.utc)
    source = JdbcSource(spark, args.source) if args.source.startswith("jdbc:") else ParquetSource(spark, args.source)
    options = {
        "store": Warehouse(spark, args.warehouse),
        "source": source,
        "extract": read_extract(spark, args.extract, args.malformed) if args.extract else None,
        "batch_ts": args.batch_ts or now.strftime("%Y-%m-%d %H:%M:%S.%f"),
        "run_id": args.run_id or f"{args.command}-{now:%Y%m%dT%H%M%S%f}",
        "key_mode": args.key_mode,
        "unknown_members": args.unknown_members,
    }
    if args.command == "full":
        counts = full_load(**options)
    else:
        counts = incremental_load(batch_id=args.batch_id or int(f"{now:%Y%m%d}"), **options)
    for table, rows in counts.items():
        print(table, ", ".join(f"{kind} {n}" for kind, n in rows.items()))


if __name__ == "__main__":
    main()

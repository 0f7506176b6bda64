"""Run lakehouse stages on the session at hand.

    python -m campuslake --root /data/lake --csv-dir /data/sources
    python -m campuslake --root /data/lake --csv-dir /data/sources --stage silver gold
    python -m campuslake --root /data/lake --csv-dir /data/sources --dated
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .plans import lakehouse
from .schemas import TABLES
from .sinks import run_folder
from .sources import land_inferred, read_csv, read_jdbc, read_jdbc_balanced
from .sources.jdbc import Database, Split

STAGES = ("bronze", "quality", "silver", "gold", "register")


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="campuslake", description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="folder that holds bronze, silver and gold")
    parser.add_argument("--stage", nargs="+", choices=STAGES, default=STAGES, help="stages to run, in order")
    parser.add_argument("--dated", action="store_true",
                        help="write the run to a dated folder under root and move registered tables to it at the end")
    parser.add_argument("--format", default="parquet", help="format of silver and gold: parquet or delta")
    parser.add_argument("--prefix", default="gold_", help="what names of registered tables begin with, such as a database")
    parser.add_argument("--on-issue", choices=("report", "fail"), default="report")
    parser.add_argument("--csv-dir", help="folder with one <table>.csv per file source")
    parser.add_argument("--infer", action="store_true", help="infer CSV types instead of the declared ones")
    parser.add_argument("--jdbc-url", help="database with the registrations; else registrations.csv is read")
    parser.add_argument("--jdbc-driver")
    parser.add_argument("--jdbc-user")
    parser.add_argument("--jdbc-password-env", default="JDBC_PASSWORD", help="variable that holds the password")
    parser.add_argument("--jdbc-split", type=int, nargs=3, metavar=("LOWER", "UPPER", "PARTITIONS"),
                        help="read registrations in these equal ranges of their id")
    parser.add_argument("--jdbc-queries", type=int, default=8,
                        help="else in so many ranges of about equal numbers of rows")
    args = parser.parse_args(argv)
    if args.dated and len(set(args.stage)) < len(STAGES):
        parser.error("a dated run has all stages")
    if "bronze" in args.stage and not args.csv_dir:
        parser.error("the bronze stage needs --csv-dir")
    return args


def _sources(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    tables = {}
    for name, table in TABLES.items():
        if table.source == "jdbc" and args.jdbc_url:
            database = Database(
                args.jdbc_url, args.jdbc_driver, args.jdbc_user, os.environ.get(args.jdbc_password_env)
            )
            if args.jdbc_split:
                tables[name] = read_jdbc(spark, database, name, Split(table.key[0], *args.jdbc_split))
            else:
                tables[name] = read_jdbc_balanced(spark, database, name, table.key[0], args.jdbc_queries)
        elif args.infer:
            tables[name] = land_inferred(spark, f"{args.csv_dir}/{name}.csv", f"{args.root}/landing/{name}")
        else:
            tables[name] = read_csv(spark, f"{args.csv_dir}/{name}.csv", name, keep_malformed=True)
    return tables


def main(argv: Sequence[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("campuslake").getOrCreate()
    if args.dated:
        args.root = run_folder(args.root, datetime.now(timezone.utc))
    for stage in (s for s in STAGES if s in args.stage):
        if stage == "quality":
            for row in lakehouse.check(spark, args.root, args.on_issue):
                print(f"quality {row['status']:6s} {row['table']:12s} {row['metric']}={row['value']}")
            continue
        if stage == "register":
            names = lakehouse.repoint_run if args.dated else lakehouse.register
            for table in names(spark, args.root, args.format, args.prefix):
                print(f"register {table}")
            continue
        if stage == "bronze":
            counts = lakehouse.ingest(_sources(spark, args), args.root)
        elif stage == "silver":
            counts = lakehouse.to_silver(spark, args.root, args.format)
        else:
            counts = lakehouse.to_gold(spark, args.root, args.format)
        for table, rows in counts.items():
            print(f"{stage:7s} {table:24s} {rows} rows")


if __name__ == "__main__":
    main()

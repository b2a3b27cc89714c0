"""Command line: one call exports (and optionally imports) a chosen set of tables.

    python -m ferry --source /data/src --landing /landing [--target /target] \\
        --schemas "Sales, HR" --tables "Order*, Employee*" \\
        --schemas-except "*" --tables-except "*History" \\
        --columns-except "LargePhoto" --types-except "binary" \\
        --field-delim "^|^" --row-delim "~~~" --header --what-if

The knobs follow the original procedure's parameters: name lists with a list
separator and a wildcard character (``--wildcard ''`` turns wildcards off),
all tables, computed / identity columns, headers, NOT NULL override, target
kind (typed append or inferred replace) and a what-if mode that writes
nothing. Each step prints its per-table report (sorted by table).
"""

from __future__ import annotations

import argparse
import sys

from ferry.plans.catalog import catalog_from_dir
from ferry.plans.run import (TransferOptions, columns_report, format_layout, plan_transfer, run_export, run_import,
                             what_if)
from ferry.plans.transfer import report_frame
from ferry.session import local_session
from ferry.sources.delimited import FileFormat


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ferry", description="bulk table transfer through delimited text on Spark")
    p.add_argument("--source", required=True, help="folder of <table>.parquet or <schema>/<table>.parquet")
    p.add_argument("--landing", required=True, help="folder for the landed part files")
    p.add_argument("--target", help="folder for the loaded tables (omit to export only)")
    p.add_argument("--schemas")
    p.add_argument("--tables")
    p.add_argument("--schemas-except")
    p.add_argument("--tables-except")
    p.add_argument("--columns-except")
    p.add_argument("--types-except")
    p.add_argument("--all-tables", action="store_true")
    p.add_argument("--list-sep", default=",")
    p.add_argument("--wildcard", default="*", help="wildcard character; empty string disables wildcards")
    p.add_argument("--field-delim", default="^|^")
    p.add_argument("--row-delim", default="~~~")
    p.add_argument("--no-crlf", action="store_true", help="do not append CRLF to the row delimiter")
    p.add_argument("--header", action="store_true")
    p.add_argument("--gzip", action="store_true")
    p.add_argument("--export-computed", action="store_true")
    p.add_argument("--no-identity", action="store_true", help="do not export identity columns")
    p.add_argument("--allow-not-null-exceptions", action="store_true")
    p.add_argument("--strict", action="store_true", help="fail on excluded columns that no chosen table has")
    p.add_argument("--no-delimiter-check", action="store_true")
    p.add_argument("--target-kind", choices=["typed", "inferred"], default="typed")
    p.add_argument("--parallel", type=int, default=4)
    p.add_argument("--what-if", action="store_true", help="report rows and bytes per table, write nothing")
    p.add_argument("--master", default=None, help="local[N] for a local run; omit inside spark-submit")
    return p


def options_from(args: argparse.Namespace) -> TransferOptions:
    fmt = FileFormat(field_delim=args.field_delim, row_delim=args.row_delim, crlf=not args.no_crlf,
                     header=args.header or args.target_kind == "inferred",
                     compression="gzip" if args.gzip else None)
    return TransferOptions(fmt=fmt, columns_except=args.columns_except, types_except=args.types_except,
                           export_identity=not args.no_identity, export_computed=args.export_computed,
                           allow_not_null_exceptions=args.allow_not_null_exceptions,
                           check_delimiters=not args.no_delimiter_check, strict=args.strict, parallel=args.parallel,
                           target=args.target_kind, list_sep=args.list_sep, wildcard=args.wildcard or None)


def show_all(df) -> None:
    """Print every row of a report (one row per table or column of the run)."""
    df.show(max(1, df.count()), truncate=False)


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    if args.master:
        spark = local_session(cores=args.master.removeprefix("local[").removesuffix("]") or "*")
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.getOrCreate()
    opts = options_from(args)
    plans = plan_transfer(spark, catalog_from_dir(args.source, spark=spark), opts, args.schemas, args.tables,
                          args.schemas_except, args.tables_except, args.all_tables)
    show_all(columns_report(spark, plans))
    if args.what_if:
        show_all(format_layout(spark, plans, opts.fmt))
        show_all(what_if(plans, opts).orderBy("table_name"))
        return 0
    exported = run_export(spark, plans, args.landing, opts)
    show_all(report_frame(exported))
    broken = {r.table_name for r in exported.filter("error <> 'None'").select("table_name").collect()}
    failed = len(broken)
    if args.target:
        loaded = run_import(spark, [p for p in plans if p.name not in broken], args.landing, args.target, opts)
        show_all(report_frame(loaded))
        failed += loaded.filter("error <> 'None'").count()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

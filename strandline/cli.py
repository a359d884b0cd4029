"""Command line: backfill, update, latest, verify, smoke, repair, mirror. Exit 0; 1 or 2 (repair) on errors; 130 on interruption."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
import os
import sys
import zoneinfo
from pathlib import Path

from pyspark.sql import SparkSession

from .functions.dates import DateError, parse_day
from .plans import repair, storage
from .plans.contracts import ArchiveError, ConfigurationError, select_datasets
from .plans.pipeline import Archive
from .sources import mirror
from .sources.http import Client


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandline")
    commands = top.add_subparsers(dest="command", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--log-level", default="INFO")
    common.add_argument("--output-dir", type=Path, default=Path("archive"))
    common.add_argument("--docs-dir", type=Path, default=Path("docs"))
    common.add_argument("--apis", default="all")
    network = argparse.ArgumentParser(add_help=False)
    network.add_argument("--workers", type=int, default=1)
    network.add_argument("--api-url", default="")
    network.add_argument("--timeout", type=float, default=120)
    network.add_argument("--max-retries", type=int, default=5)
    network.add_argument("--request-interval", type=float, default=0.1)
    update = argparse.ArgumentParser(add_help=False)
    update.add_argument("--as-of")
    for name, value in (("financial-lookback-quarters", 8), ("announcement-lookback-days", 7), ("event-lookback-days", 7), ("history-quarters-per-run", 1), ("daily-lookback-days", 7)):
        update.add_argument(f"--{name}", type=int, default=value)
    update.add_argument("--allow-shrink", action="store_true")
    back = commands.add_parser("backfill", parents=[common, network])
    back.add_argument("--start-date", required=True)
    back.add_argument("--end-date", required=True)
    back.add_argument("--force", action="store_true")
    back.add_argument("--allow-shrink", action="store_true")
    commands.add_parser("update", parents=[common, network, update])
    commands.add_parser("latest", parents=[common, network, update]).add_argument("--start-date", default="20160720")
    commands.add_parser("verify", parents=[common])
    smoke = commands.add_parser("smoke", parents=[common, network])
    for name in ("period", "event-start", "event-end", "trade-date"):
        smoke.add_argument(f"--{name}", required=True)
    fix = commands.add_parser("repair")
    fix.add_argument("--data-dir", type=Path, required=True)
    fix.add_argument("--backup-dir", type=Path)
    fix.add_argument("--report", type=Path)
    what = fix.add_mutually_exclusive_group()
    for name in ("dry-run", "apply", "restore"):
        what.add_argument(f"--{name}", action="store_true")
    copy = commands.add_parser("mirror")
    copy.add_argument("source", type=Path)
    copy.add_argument("target", type=Path)
    copy.add_argument("--order-by", default="")
    copy.add_argument("--archive", type=Path)
    return top


def check(args: argparse.Namespace) -> None:
    for name, value in vars(args).items():
        if "lookback" in name and value < 1:
            raise ConfigurationError(f"{name} must be at least 1")
    if getattr(args, "history_quarters_per_run", 0) < 0 or getattr(args, "request_interval", 0) < 0 or getattr(args, "workers", 1) < 1:
        raise ConfigurationError("history, interval and workers must not be below 0, 0 and 1")


def run_repair(spark: SparkSession, args: argparse.Namespace) -> dict:
    if args.report and (args.report.exists() or args.report.resolve().is_relative_to(args.data_dir.resolve())):
        raise repair.PatchError("the report must be a new file outside the data")
    if (args.apply or args.restore) and not args.backup_dir:
        raise repair.PatchError("a backup directory is needed")
    if args.restore:
        repair.restore(spark, args.data_dir, args.backup_dir)
        return {"restored": True}
    if args.apply:
        return {"cases": repair.apply(spark, args.data_dir, args.backup_dir, "repair")}
    manifest = storage.read_json(args.data_dir / repair.DATASET / "_manifest.json")
    query = manifest["partitions"]["all"]["query"]
    rows = storage.read_partition(spark, args.data_dir / repair.DATASET / "scope=all")
    _, cases, blockers = repair.patch(rows, query["start_date"], query["end_date"])
    return {"cases": cases, "blockers": blockers, "audit": repair.audit(rows, query["start_date"], query["end_date"])}


def run(args: argparse.Namespace, spark: SparkSession, client: Client | None = None) -> int:
    check(args)
    if args.command == "repair":
        report = run_repair(spark, args)
        if args.report:
            storage.write_json(args.report, report)
        print(json.dumps(report, ensure_ascii=False, default=str))
        return 0
    if args.command == "mirror":
        print(json.dumps(mirror.sync(spark, args.source, args.target, tuple(c for c in args.order_by.split(",") if c), args.archive)))
        return 0
    selected = select_datasets(args.apis)
    today = dt.datetime.now(zoneinfo.ZoneInfo("Asia/Shanghai")).date()
    if client is None:
        client = Client(getattr(args, "api_url", ""), os.environ.get("ARCHIVE_TOKEN", ""), getattr(args, "timeout", 120), getattr(args, "max_retries", 5), getattr(args, "request_interval", 0.1))
    archive = Archive(spark, args.output_dir, args.docs_dir, client, today, getattr(args, "workers", 1))
    if args.command == "verify":
        totals, errors = archive.verify(selected)
        print(json.dumps({"totals": totals, "errors": errors}, ensure_ascii=False))
        return 1 if errors else 0
    if args.command == "smoke":
        queries = {"period": {"period": args.period}, "statement": {"period": args.period, "report_type": "1"}, "event": {"start_date": args.event_start, "end_date": args.event_end}, "daily": {"trade_date": args.trade_date}, "industry": {"is_new": "Y"}}
        print(json.dumps(archive.smoke(selected, queries)))
        return 0
    with storage.archive_lock(args.output_dir):
        storage.recover(spark, args.output_dir)
        if args.command == "backfill":
            start, end = parse_day(args.start_date), parse_day(args.end_date)
            if start > end:
                raise ConfigurationError("the range ends before it starts")
            archive.backfill(selected, start, end, args.force, args.allow_shrink)
            return 0
        as_of = parse_day(args.as_of) if args.as_of else today
        options = {"quarters": args.financial_lookback_quarters, "announcement_days": args.announcement_lookback_days, "event_days": args.event_lookback_days, "daily_days": args.daily_lookback_days, "history": args.history_quarters_per_run, "allow_shrink": args.allow_shrink}
        if args.command == "update":
            archive.update(selected, as_of, **options)
        else:
            archive.latest(selected, parse_day(args.start_date), as_of, **options)
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None, client: Client | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=getattr(args, "log_level", "INFO"))
    try:
        return run(args, spark or SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.sources.partitionColumnTypeInference.enabled", "false").getOrCreate(), client)
    except repair.PatchError as e:
        logging.error("%s", e)
        return 2
    except (ArchiveError, DateError, OSError) as e:
        logging.error("%s", e)
        return 1
    except KeyboardInterrupt:
        return 130


if __name__ == "__main__":
    sys.exit(main())

"""Command line: ``python -m gaugeline <job> --input-dir ... --output-dir ...``."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from gaugeline.plans import gold, ingest, ledger, silver
from gaugeline.session import get_session


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def _days(start: dt.date | None, end: dt.date | None) -> list[dt.date] | None:
    """The raw folders to read: all, or those of a range. One bound alone names no folders."""
    if (start is None) != (end is None):
        raise SystemExit("bronze takes both --start-date and --end-date, or neither")
    if start is None:
        return None
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gaugeline")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("bronze", "staging", "silver", "gold"):
        job = jobs.add_parser(name)
        job.add_argument("--input-dir", required=True)
        job.add_argument("--output-dir", required=True)
        job.add_argument("--format", default="parquet")
        job.add_argument("--start-date", type=_date)
        job.add_argument("--end-date", type=_date)
        if name != "gold":
            job.add_argument("--ids-fix-date", action="store_true",
                             help="an event id implies its date: merge within the dates at hand")
        if name == "gold":
            job.add_argument("--config-dir", required=True)
    check = jobs.add_parser("ledger-check")
    check.add_argument("--ledger-dir", required=True)
    check.add_argument("--raw-dir")
    check.add_argument("--input-date", type=_date)
    check.add_argument("--days", type=int, default=1)
    update = jobs.add_parser("ledger-update")
    update.add_argument("--ledger-dir", required=True)
    update.add_argument("--start-date", type=_date, required=True)
    update.add_argument("--days", type=int, default=1)
    take = jobs.add_parser("ledger-import")
    take.add_argument("--ledger-dir", required=True)
    take.add_argument("--document", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = get_session(f"gaugeline-{args.job}")
    if args.job == "bronze":
        result = ingest.raw_to_bronze(spark, args.input_dir, args.output_dir,
                                      _days(args.start_date, args.end_date), fmt=args.format,
                                      ids_fix_date=args.ids_fix_date)
    elif args.job == "staging":
        result = ingest.bronze_to_staging(spark, args.input_dir, args.output_dir, args.start_date,
                                          args.end_date, args.format, args.ids_fix_date)
    elif args.job == "silver":
        result = silver.staging_to_silver(spark, args.input_dir, args.output_dir, args.start_date,
                                          args.end_date, fmt=args.format,
                                          ids_fix_date=args.ids_fix_date)
    elif args.job == "gold":
        result = gold.silver_to_gold(spark, args.input_dir, args.output_dir, args.config_dir,
                                     args.start_date, args.end_date, args.format)
    elif args.job == "ledger-check":
        window = ledger.plan_window(spark, args.ledger_dir, args.raw_dir, args.days,
                                    args.input_date)
        result = {**window.__dict__}
    elif args.job == "ledger-import":
        ledger.import_document(spark, args.ledger_dir, args.document)
        result = "imported"
    else:
        ledger.record_run(spark, args.ledger_dir, args.start_date, args.days)
        result = "recorded"
    print(json.dumps(result, default=str))


if __name__ == "__main__":
    main()

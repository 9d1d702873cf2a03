"""Ledger of processed dates on storage: two small tables, ``dates`` and ``runs``."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.operators import ledger as ops
from gaugeline.sources.raw import raw_paths
from gaugeline.sources.reference_data import read_ledger_document
from gaugeline.sources.storage import join_path
from gaugeline.sources.tables import append, merge_insert, read_table

_RUN = ("start date, end date, days int, recorded_at timestamp, note string")


@dataclass(frozen=True)
class Window:
    """What to process next: ``decision`` is skip, partial or proceed."""

    decision: str
    start: dt.date
    end: dt.date
    days: int


def sync_ledger(spark: SparkSession, ledger_dir: str, raw_dir: str | None) -> DataFrame:
    """Bring the ledger in line with the raw folders and return its dates.

    A missing ledger is rebuilt with a history note; otherwise untracked dates are added. Dates that the
    history lists are kept even if the table of dates has lost them.
    """
    dates_path, runs_path = join_path(ledger_dir, "dates"), join_path(ledger_dir, "runs")
    known = read_table(spark, dates_path)
    paths = raw_paths(spark, raw_dir) if raw_dir else None
    if paths is not None:
        found = ops.discover_dates(paths)
        if known is None:
            note = ops.reconstruction_note(found)
            if not note.isEmpty():
                append(note.select("start", "end", F.col("days").cast("int").alias("days"),
                                   "recorded_at", "note", "dates_added").coalesce(1), runs_path)
        runs = read_table(spark, runs_path)
        merge_insert(ops.reconcile(None, found, runs if runs and "dates_added" in runs.columns else None)
                     .coalesce(1), dates_path, ["date"])
        known = read_table(spark, dates_path)
    return spark.createDataFrame([], "date date") if known is None else known


def plan_window(spark: SparkSession, ledger_dir: str, raw_dir: str | None, days: int = 1,
                start: dt.date | None = None, today: dt.date | None = None) -> Window:
    """Window for the next run.

    With a start date the request is compared with the ledger; without one the window begins the
    day after the latest date, or today.
    """
    dates = sync_ledger(spark, ledger_dir, raw_dir)
    if start is None:
        today = today or dt.datetime.now(dt.timezone.utc).date()
        row = ops.next_window(dates, today, days).first()
        return Window("proceed", row["start"], row["end"], days)
    decision = ops.overlap(ops.run_dates(spark, start, days), dates).first()["decision"]
    return Window(decision, start, start + dt.timedelta(days=days - 1), days)


def record_run(spark: SparkSession, ledger_dir: str, start: dt.date, days: int,
               recorded_at: dt.datetime | None = None, note: str | None = None) -> None:
    """Add the dates of a finished run and its history row."""
    recorded_at = recorded_at or dt.datetime.now(dt.timezone.utc)
    run = spark.createDataFrame(
        [(start, start + dt.timedelta(days=days - 1), days, recorded_at, note)], _RUN)
    _store(ledger_dir, *ops.record_run(None, None, run))


def import_document(spark: SparkSession, ledger_dir: str, path: str) -> None:
    """Take over a ledger kept as one JSON document: its dates and its history."""
    dates, runs = read_ledger_document(spark, path, dates_added=True)
    _store(ledger_dir, ops.reconcile(dates, ops.history_dates(runs)), runs)


def _store(ledger_dir: str, dates: DataFrame, runs: DataFrame) -> None:
    merge_insert(dates.coalesce(1), join_path(ledger_dir, "dates"), ["date"])
    append(runs.coalesce(1), join_path(ledger_dir, "runs"))

"""Ledger of processed dates: which days have data, and which to process next."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layout of raw paths and month folder names.
RAW_PATH = r"location_[^/]*/([0-9]{4}/[A-Za-z]+/day[0-9]{1,2})(?:/|$)"
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december")
# End of fixed values.


def discover_dates(paths: DataFrame, column: str = "path") -> DataFrame:
    """Distinct dates named by raw paths; other folders and impossible dates are skipped.

    A path is only cut to its folder of a day; the few distinct folders are read as dates.
    """
    folders = (paths.select(F.regexp_extract(column, RAW_PATH, 1).alias("folder"))
               .groupBy("folder").agg(F.max("folder").alias("named")))
    part = F.split("named", "/")
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.get(part, F.lit(1))))
    date = F.concat_ws("-", F.get(part, F.lit(0)), month.cast("string"),
                       F.substring(F.get(part, F.lit(2)), 4, 2)).try_cast("date")
    return folders.select(date.alias("date")).filter("date IS NOT NULL").distinct()


def history_dates(runs: DataFrame) -> DataFrame:
    """Distinct dates that recorded runs added."""
    return runs.select(F.explode("dates_added").alias("date")).distinct()


def reconcile(ledger: DataFrame | None, discovered: DataFrame, runs: DataFrame | None = None
              ) -> DataFrame:
    """Ledger dates plus the discovered ones it lacks, and those its runs added; without a ledger,
    just the discovered."""
    found = discovered.select("date")
    if ledger is not None:
        found = ledger.select("date").union(found)
    if runs is not None:
        found = found.union(history_dates(runs))
    return found.distinct()


def ledger_state(dates: DataFrame) -> DataFrame:
    """One row: latest date (NULL when empty) and number of dates."""
    return dates.agg(F.max("date").alias("latest_date"),
                     F.count_distinct("date").alias("total_dates"))


def reconstruction_note(discovered: DataFrame) -> DataFrame:
    """History row for a ledger rebuilt from raw paths; none when nothing was found."""
    return (discovered.agg(F.min("date").alias("start"), F.max("date").alias("end"),
                           F.count_distinct("date").alias("days"),
                           F.array_sort(F.collect_set("date")).alias("dates_added"))
            .filter("days > 0")
            .withColumns({"recorded_at": F.lit(None).cast("timestamp"),
                          "note": F.lit("reconstructed from raw paths")}))


def expand(requests: DataFrame) -> DataFrame:
    """(start, days) rows to one row per requested date."""
    last = F.date_add("start", (F.col("days") - 1).cast("int"))
    return (requests.filter("days > 0")
            .select(F.explode(F.sequence("start", last)).alias("date")).distinct())


def overlap(requested: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: requested and present counts, and the decision skip / partial / proceed."""
    have = ledger.select("date").distinct().withColumn("_have", F.lit(1))
    counted = requested.select("date").distinct().join(have, "date", "left").agg(
        F.count(F.lit(1)).alias("requested_dates"), F.count("_have").alias("present_dates"))
    return counted.withColumn(
        "decision", F.when(F.col("present_dates") == F.col("requested_dates"), "skip")
        .when(F.col("present_dates") > 0, "partial").otherwise("proceed"))


def next_window(ledger: DataFrame, today: dt.date, days: int = 1) -> DataFrame:
    """One row (start, end): the day after the latest date, or today when there is none."""
    start = F.coalesce(F.date_add(F.max("date"), 1), F.lit(today))
    return (ledger.agg(start.alias("start"))
            .withColumn("end", F.date_add("start", days - 1)))


def run_dates(spark: SparkSession, start: dt.date, days: int) -> DataFrame:
    """Dates of one run as a frame."""
    request = spark.createDataFrame([(start, days)], "start date, days int")
    return expand(request)


def with_dates_added(runs: DataFrame) -> DataFrame:
    """Runs (start, days, ...) with the array of their dates."""
    last = F.date_add("start", (F.col("days") - 1).cast("int"))
    none = F.array().cast("array<date>")
    return runs.withColumn("dates_added", F.when(F.col("days") > 0, F.sequence("start", last))
                           .otherwise(none))


def record_run(ledger: DataFrame | None, runs: DataFrame | None, run: DataFrame
               ) -> tuple[DataFrame, DataFrame]:
    """Ledger and history after runs given as (start, end, days, recorded_at, note) rows; the history
    also lists the dates of each."""
    run = with_dates_added(run)
    dates = history_dates(run)
    dates = dates if ledger is None else ledger.select("date").union(dates).distinct()
    history = run if runs is None else runs.unionByName(run, allowMissingColumns=True)
    return dates, history
